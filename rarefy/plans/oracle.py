"""DuckDB SQL equal to each SQL-checkable registered query.

Only the driver's raw tables exist as views, so every statement starts
with the same view definitions as ``sources.tables``. Doubles are rounded
exactly where the Spark query rounds them.
"""

from __future__ import annotations

import math

from ..sources.tables import VECTOR_SIZE
from .common import ENSEMBLE_WEIGHTS, SPLIT_SEED, TEST_SIZE, VAL_SIZE

VCOLS = [f"V{i}" for i in range(1, VECTOR_SIZE + 1)]
LINE_COLS = ["V1", "V2", "V3", "V4", "Amount", "Class"]


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def q(c: str) -> str:
    return f'"{c}"'


TX_EVENTS = f"""tx_events AS (
  SELECT event_id AS row_id,
         CAST(epoch_us(ts) - min(epoch_us(ts)) OVER () AS DOUBLE) / {D(1000000)} AS "Time",
         value AS "Amount",
         CAST(event_type = 'error' AS INTEGER) AS "Class"
  FROM events)"""

TX_VECTORS = "tx_vectors AS (SELECT vec_id AS row_id, " + ", ".join(
    f'CAST(embedding[{i + 1}] AS DOUBLE) AS "V{i + 1}"' for i in range(VECTOR_SIZE)) + \
    ', CAST(label = 0 AS INTEGER) AS "Class" FROM embeddings)'

TX_LINES = """tx_lines AS (SELECT l_quantity AS "V1", l_discount AS "V2", l_tax AS "V3",
  CAST(l_linenumber AS DOUBLE) AS "V4", l_extendedprice AS "Amount",
  CAST(l_returnflag = 'R' AS INTEGER) AS "Class" FROM lineitem)"""


def fixed_score(a='"Amount"') -> str:
    return f"floor({D(100)} * {a} / ({a} + {D(50)})) / {D(100)}"


SCORED = f"""scored AS (SELECT row_id, "Class" AS label, {fixed_score()} AS score FROM tx_events)"""


def pmod(x: str, n: float) -> str:
    m = f"fmod({x}, {D(n)})"
    return f"(CASE WHEN {m} < 0 THEN fmod({m} + {D(n)}, {D(n)}) ELSE {m} END)"


def hours(t='"Time"') -> str:
    return pmod(f"{t} / {D(3600)}", 24.0)


def period(h='"Time_Hours"') -> str:
    e = [0, 6, 12, 18, 24]
    labs = ["Night", "Morning", "Afternoon", "Evening"]
    parts = " ".join(f"WHEN {h} > {D(e[i])} AND {h} <= {D(e[i + 1])} THEN '{lab}'" for i, lab in enumerate(labs))
    return f"CASE {parts} END"


def flags(h='"Time_Hours"') -> list[str]:
    e = [0, 6, 12, 18, 24]
    labs = ["Night", "Morning", "Afternoon", "Evening"]
    return [f'CAST({h} >= {D(e[i])} AND {h} < {D(e[i + 1])} AS INTEGER) AS "Is_{lab}"' for i, lab in enumerate(labs)]


TWO_PI = repr(2.0 * math.pi)


def cyclic(h='"Time_Hours"') -> list[str]:
    ang = f"{D(TWO_PI)} * {h} / {D(24)}"
    return [f"sin({ang}) AS \"Time_Hours_Sin\"", f"cos({ang}) AS \"Time_Hours_Cos\""]


def rnd(x: str, digits: int = 6) -> str:
    return f"round({x}, {digits})"


def with_(*views: str, body: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + body


DECILES = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"

AMT_STATS = f"""amt AS (
  SELECT list_sort(list_distinct(quantile_cont("Amount", {DECILES}))) AS e,
         quantile_cont("Amount", {D(0.25)}) AS q_low,
         quantile_cont("Amount", {D(0.95)}) AS q_high,
         quantile_cont("Amount", {D(0.99)}) AS q_vhigh,
         avg("Amount") AS m, stddev_samp("Amount") AS s
  FROM tx_events)"""

AMOUNT_BIN = """CAST(CASE WHEN len(e) = 0 THEN NULL
     WHEN len(e) = 1 THEN (CASE WHEN "Amount" IS NOT NULL THEN 0 END)
     WHEN "Amount" < e[1] OR "Amount" > e[len(e)] THEN NULL
     ELSE len(list_filter(list_slice(e, 2, len(e) - 1), lambda v: v < "Amount")) END AS INTEGER)"""

ENG = f"""eng AS (
  SELECT t.row_id, t."Time", t."Amount", t."Class", t."Time_Hours",
         {period('t."Time_Hours"')} AS "Time_Period",
         {", ".join(flags('t."Time_Hours"'))},
         {", ".join(cyclic('t."Time_Hours"'))},
         ln(1 + t."Amount") AS "Amount_Log",
         {AMOUNT_BIN} AS "Amount_Bin",
         coalesce(CAST(t."Amount" > q_high AS INTEGER), 0) AS "Is_High_Amount",
         coalesce(CAST(t."Amount" > q_vhigh AS INTEGER), 0) AS "Is_Very_High_Amount",
         coalesce(CAST(t."Amount" < q_low AS INTEGER), 0) AS "Is_Low_Amount",
         CASE WHEN s > 0 THEN (t."Amount" - m) / s END AS "Amount_ZScore"
  FROM (SELECT *, {hours()} AS "Time_Hours" FROM tx_events) t, amt)"""

ENG_COLS_ROUNDED = ["Time_Hours_Sin", "Time_Hours_Cos", "Amount_Log", "Amount_ZScore"]
ENG_COLS = ["row_id", "Time", "Amount", "Class", "Time_Hours", "Time_Period", "Is_Night",
            "Is_Morning", "Is_Afternoon", "Is_Evening", "Time_Hours_Sin", "Time_Hours_Cos",
            "Amount_Log", "Amount_Bin", "Is_High_Amount", "Is_Very_High_Amount",
            "Is_Low_Amount", "Amount_ZScore"]


def eng_select(cols, rounded=ENG_COLS_ROUNDED) -> str:
    return ", ".join(rnd(q(c)) + f" AS {q(c)}" if c in rounded else q(c) for c in cols)


def md5_hash(id_col: str, seed, salt: str = "") -> str:
    return f"('0x' || substr(md5(CAST({id_col} AS VARCHAR) || ':{seed}{salt}'), 1, 15))::BIGINT"


def unpivot(view: str, cols, ids, name="feature", value="x") -> str:
    return " UNION ALL ".join(
        f"SELECT {', '.join(q(i) for i in ids)}{', ' if ids else ''}'{c}' AS {name}, "
        f"CAST({q(c)} AS DOUBLE) AS {value} FROM {view}" for c in cols)


def _split_sql(val_size: float, stratify: bool = True) -> str:
    part = 'PARTITION BY "Class"' if stratify else ""
    val_adj = val_size / (1 - TEST_SIZE) if val_size > 0 else 0.0
    kv = f"CAST(ceil({D(repr(val_adj))} * (n - kt)) AS BIGINT)" if val_size > 0 else "0"
    return f"""h AS (SELECT *, {md5_hash('row_id', SPLIT_SEED)} AS h FROM tx_events),
r AS (SELECT *, row_number() OVER ({part} ORDER BY h, row_id) - 1 AS rk,
             count(*) OVER ({part}) AS n FROM h),
k AS (SELECT *, CAST(ceil({D(repr(TEST_SIZE))} * n) AS BIGINT) AS kt FROM r),
sp AS (SELECT *, CASE WHEN rk < kt THEN 'test' WHEN rk < kt + {kv} THEN 'val' ELSE 'train' END AS split FROM k)"""


SCORERS = {
    "s_amount": fixed_score(),
    "s_hour": f"floor({D(100)} * {hours()} / {D(24)}) / {D(100)}",
    "s_mod": f"floor({D(100)} * {pmod(q('Amount'), 7.0)} / {D(7)}) / {D(100)}",
}
MEMBERS = f"""members AS (SELECT row_id, "Class" AS label, {", ".join(f"{v} AS {k}" for k, v in SCORERS.items())} FROM tx_events)"""


def _weighted_sql() -> str:
    tot = sum(ENSEMBLE_WEIGHTS.values())
    terms = [f"{D(repr(v / tot))} * {k}" for k, v in ENSEMBLE_WEIGHTS.items() if v / tot > 0]
    s = " + ".join(terms)
    return f"""wv AS (SELECT row_id, label, {s} AS score FROM members),
wd AS (SELECT *, CAST(score >= {D(0.5)} AS INTEGER) AS prediction FROM wv)"""


def _auc_sql(src: str) -> str:
    return f"""st AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM {src} GROUP BY score),
ca AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM st),
auc AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
          sum(pos * (cum_neg - neg) + {D(0.5)} * pos * neg) / ({D('sum(pos)')} * {D('sum(neg)')}) END AS roc_auc FROM ca),
cd AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
                 sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg2 FROM st),
ap AS (SELECT CASE WHEN sum(pos) > 0 THEN sum({D('pos')} * cum_pos / (cum_pos + cum_neg2)) / {D('sum(pos)')} END AS average_precision FROM cd)"""


def _thr_sql(src: str) -> str:
    return f"""cm AS (SELECT {D("count(*) FILTER (WHERE label = 1 AND prediction = 1)")} AS tp,
                   {D("count(*) FILTER (WHERE label = 0 AND prediction = 1)")} AS fp,
                   {D("count(*) FILTER (WHERE label = 1 AND prediction = 0)")} AS fn,
                   {D("count(*) FILTER (WHERE label = 0 AND prediction = 0)")} AS tn FROM {src}),
thr AS (SELECT coalesce(CASE WHEN tp + fp + fn + tn <> 0 THEN (tp + tn) / (tp + fp + fn + tn) END, 0.0) AS accuracy,
               coalesce(CASE WHEN tp + fp <> 0 THEN tp / (tp + fp) END, 0.0) AS precision,
               coalesce(CASE WHEN tp + fn <> 0 THEN tp / (tp + fn) END, 0.0) AS recall,
               coalesce(CASE WHEN {D(2)} * tp + fp + fn <> 0 THEN {D(2)} * tp / ({D(2)} * tp + fp + fn) END, 0.0) AS f1,
               CASE WHEN sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) > 0
                    THEN (tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)) ELSE 0.0 END AS mcc
        FROM cm)"""


def _topk_sql(score_sql_view: str, k: int, keep_order=True) -> str:
    return f"""SELECT feature, {rnd('score')} AS score FROM (SELECT *, row_number() OVER (ORDER BY score IS NULL, score DESC, position) AS r
FROM {score_sql_view}) WHERE r <= {k}"""


def _vec_tall() -> str:
    return f"tall AS ({unpivot('tx_vectors', VCOLS, ['Class'])})"


def _positions() -> str:
    return "pos AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(VCOLS)) + \
        ") t(position, feature))"


def density_views(src: str, feats, bins: int = 50, prefix: str = "") -> list:
    """Views ending in ``{prefix}dens(feature, Class, bin, x, n, density)``."""
    p = prefix
    tall = " UNION ALL ".join(f"SELECT \"Class\", '{c}' AS feature, CAST({q(c)} AS DOUBLE) AS x FROM {src}" for c in feats)
    return [
        f"{p}tall AS ({tall})",
        f"{p}rng AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM {p}tall WHERE x IS NOT NULL GROUP BY feature)",
        f"{p}tb AS (SELECT t.\"Class\", t.feature, t.x, r.lo, r.hi, CASE WHEN r.hi > r.lo THEN "
        f"least(CAST(floor((t.x - r.lo) / ((r.hi - r.lo) / {D(bins)})) AS INTEGER), {bins - 1}) ELSE 0 END AS bin "
        f"FROM {p}tall t JOIN {p}rng r USING (feature) WHERE t.x IS NOT NULL)",
        f"{p}stc AS (SELECT feature, \"Class\", count(x) AS n_class, stddev_samp(x) AS sd FROM {p}tb GROUP BY feature, \"Class\")",
        f"{p}hist AS (SELECT feature, \"Class\", bin, count(*) AS n FROM {p}tb GROUP BY feature, \"Class\", bin)",
        f"{p}grid AS (SELECT s.feature, s.\"Class\", r.lo, r.hi, g.bin, s.n_class, "
        f"s.sd * pow(CAST(s.n_class AS DOUBLE), {D(-0.2)}) AS bw, "
        f"r.lo + (CAST(g.bin AS DOUBLE) + {D(0.5)}) * (r.hi - r.lo) / {D(bins)} AS x "
        f"FROM {p}stc s JOIN {p}rng r USING (feature) CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) g)",
        f"{p}kd AS (SELECT g.feature, g.\"Class\", g.bin, sum(CAST(h.n AS DOUBLE) * exp({D(-0.5)} * pow((g.x - "
        f"(g.lo + (CAST(h.bin AS DOUBLE) + {D(0.5)}) * (g.hi - g.lo) / {D(bins)})) / g.bw, {D(2)}))) AS k "
        f"FROM {p}grid g JOIN {p}hist h ON h.feature = g.feature AND h.\"Class\" = g.\"Class\" GROUP BY g.feature, g.\"Class\", g.bin)",
        f"{p}dens AS (SELECT g.feature, g.\"Class\", g.bin, g.x, coalesce(h.n, 0) AS n, "
        f"CASE WHEN g.bw > 0 THEN kd.k / (CAST(g.n_class AS DOUBLE) * g.bw * {D(repr(math.sqrt(2 * math.pi)))}) END AS density "
        f"FROM {p}grid g LEFT JOIN {p}hist h ON h.feature = g.feature AND h.\"Class\" = g.\"Class\" AND h.bin = g.bin "
        f"LEFT JOIN {p}kd kd ON kd.feature = g.feature AND kd.\"Class\" = g.\"Class\" AND kd.bin = g.bin)",
    ]


def box_views(src: str, feats, prefix: str = "") -> list:
    """Views ending in ``{prefix}box(Class, feature, n, q1, median, q3, iqr, whisker_lo, whisker_hi, n_outliers)``."""
    p = prefix
    tall = " UNION ALL ".join(f"SELECT \"Class\", '{c}' AS feature, CAST({q(c)} AS DOUBLE) AS x FROM {src}" for c in feats)
    return [
        f"{p}btall AS (SELECT * FROM ({tall}) WHERE x IS NOT NULL)",
        f"{p}qq AS (SELECT \"Class\", feature, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, "
        f"quantile_cont(x, 0.75) AS q3 FROM {p}btall GROUP BY \"Class\", feature)",
        f"{p}ff AS (SELECT *, q3 - q1 AS iqr, q1 - {D(1.5)} * (q3 - q1) AS lo_fence, q3 + {D(1.5)} * (q3 - q1) AS hi_fence FROM {p}qq)",
        f"{p}box AS (SELECT f.\"Class\", f.feature, count(*) AS n, any_value(f.q1) AS q1, any_value(f.median) AS median, "
        f"any_value(f.q3) AS q3, any_value(f.iqr) AS iqr, min(t.x) FILTER (WHERE t.x >= f.lo_fence) AS whisker_lo, "
        f"max(t.x) FILTER (WHERE t.x <= f.hi_fence) AS whisker_hi, "
        f"count(*) FILTER (WHERE t.x < f.lo_fence OR t.x > f.hi_fence) AS n_outliers "
        f"FROM {p}btall t JOIN {p}ff f ON t.\"Class\" = f.\"Class\" AND t.feature = f.feature GROUP BY f.\"Class\", f.feature)",
    ]


def eda_sql() -> str:
    feats = ["Time", "Amount", "Time_Hours"]
    base = f'ebase AS (SELECT row_id, "Time", "Amount", "Class", {hours()} AS "Time_Hours" FROM tx_events)'
    cd = 'cd AS (SELECT "Class", count(*) AS n FROM ebase GROUP BY "Class")'
    cr = "cr AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS f, corr({D(q(c))}, CAST(\"Class\" AS DOUBLE)) AS c FROM ebase" for c in feats) + ")"
    box_rows = " UNION ALL ".join(
        f"SELECT 'box', feature, \"Class\", '{st}', CAST({st} AS DOUBLE) FROM box"
        for st in ["q1", "median", "q3", "whisker_lo", "whisker_hi", "n_outliers"])
    body = ("SELECT section, feature, \"Class\", stat, round(value, 6) AS value FROM ("
            "SELECT 'class_distribution' AS section, CAST(NULL AS VARCHAR) AS feature, \"Class\", 'n' AS stat, CAST(n AS DOUBLE) AS value FROM cd "
            f"UNION ALL SELECT 'class_distribution', NULL, \"Class\", 'pct', n * {D(100)} / sum(n) OVER () FROM cd "
            "UNION ALL SELECT * FROM (SELECT 'corr_topk', f, CAST(NULL AS INTEGER), 'abs_corr', abs(c) FROM cr WHERE c IS NOT NULL "
            "ORDER BY abs(c) DESC, f LIMIT 10) "
            f"UNION ALL {box_rows} "
            "UNION ALL SELECT 'density', feature, \"Class\", 'peak_x', x FROM (SELECT *, row_number() OVER "
            "(PARTITION BY feature, \"Class\" ORDER BY round(density, 9) DESC NULLS LAST, bin) AS r FROM dens) WHERE r = 1)")
    return with_(TX_EVENTS, base, cd, cr, *box_views("ebase", feats), *density_views("ebase", feats), body=body)


def build() -> dict:
    s = {}
    s["scan_transactions"] = with_(TX_EVENTS, body="SELECT * FROM tx_events")
    s["align_schema"] = with_(TX_EVENTS, body="SELECT row_id, \"Class\", \"Time\", " + ", ".join(
        f"{D(0.0)} AS \"V{i}\"" for i in range(1, 29)) + ", \"Amount\" FROM tx_events")
    s["time_hours"] = with_(TX_EVENTS, body=f'SELECT row_id, {hours()} AS "Time_Hours" FROM tx_events')
    th = f'th AS (SELECT row_id, {hours()} AS "Time_Hours" FROM tx_events)'
    s["time_period"] = with_(TX_EVENTS, th, body=f'SELECT row_id, "Time_Hours", {period()} AS "Time_Period" FROM th')
    s["time_flags"] = with_(TX_EVENTS, th, body=f'SELECT row_id, {", ".join(flags())} FROM th')
    ang = f'{D(TWO_PI)} * "Time_Hours" / {D(24)}'
    s["time_cyclic"] = with_(TX_EVENTS, th, body=f'SELECT row_id, {rnd(f"sin({ang})")} AS "Time_Hours_Sin", '
                                               f'{rnd(f"cos({ang})")} AS "Time_Hours_Cos" FROM th')
    s["amount_log"] = with_(TX_EVENTS, body=f'SELECT row_id, {rnd("ln(1 + \"Amount\")")} AS "Amount_Log" FROM tx_events')
    pairs = []
    for i in range(1, 6):
        for j in range(i + 1, 6):
            pairs.append(f'"V{i}" * "V{j}" AS "V{i}_x_V{j}"')
    s["interactions"] = with_(TX_VECTORS, body=f"SELECT row_id, {', '.join(pairs[:10])} FROM tx_vectors")
    s["project_selected"] = with_(TX_EVENTS, AMT_STATS, ENG, body=
                                  f"SELECT {eng_select(['Amount_Log', 'Time_Hours', 'Class', 'Time', 'Amount'])} FROM eng")
    s["filter_class"] = with_(TX_EVENTS, body='SELECT * FROM tx_events WHERE "Class" = 1')
    s["decision"] = with_(TX_EVENTS, SCORED, body=f"SELECT row_id, label, score, CAST(score >= {D(0.5)} AS INTEGER) AS prediction FROM scored")
    dec = f"dec AS (SELECT *, CAST(score >= {D(0.5)} AS INTEGER) AS prediction FROM scored)"
    band = (f"CASE WHEN prediction = 1 THEN (CASE WHEN score > {D(0.9)} THEN 'Very High' "
            f"WHEN score > {D(0.7)} THEN 'High' WHEN score > {D(0.5)} THEN 'Medium' ELSE 'Low' END) "
            f"ELSE 'Legitimate' END")
    s["risk_band"] = with_(TX_EVENTS, SCORED, dec, body=
                           f"SELECT row_id, score, prediction, {band} AS risk_band, "
                           f"{rnd(f'CASE WHEN prediction = 1 THEN score ELSE {D(1.0)} - score END')} AS confidence FROM dec")
    s["class_weights"] = with_(TX_EVENTS, body=
                               'SELECT "Class", n, round(CAST(sum(n) OVER () AS DOUBLE) / CAST(count(*) OVER () * n AS DOUBLE), 6) AS weight '
                               'FROM (SELECT "Class", count(*) AS n FROM tx_events GROUP BY "Class")')
    s["scale_pos_weight"] = with_(TX_EVENTS, body=
                                  'SELECT neg, pos, round(CASE WHEN pos > 0 THEN CAST(neg AS DOUBLE) / pos END, 6) AS scale_pos_weight '
                                  'FROM (SELECT count(*) FILTER (WHERE "Class" = 0) AS neg, count(*) FILTER (WHERE "Class" = 1) AS pos FROM tx_events)')
    s["shape_head"] = with_(TX_EVENTS, body=
                            "SELECT *, (SELECT count(*) FROM tx_events) AS n_rows, 4 AS n_cols FROM tx_events ORDER BY row_id LIMIT 5")
    types = [("row_id", "bigint"), ("Time", "double"), ("Amount", "double"), ("Class", "int")]
    s["dtype_info"] = with_(TX_EVENTS, body=" UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, count({q(c)}) AS non_null FROM tx_events"
        for i, (c, t) in enumerate(types)))
    line_tall = f"tall AS ({unpivot('tx_lines', LINE_COLS, [])})"
    s["describe"] = with_(TX_LINES, line_tall, body=
                          "SELECT feature, count(x) AS count, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, "
                          "round(min(x), 6) AS min, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50, "
                          "round(quantile_cont(x, 0.75), 6) AS q75, round(max(x), 6) AS max FROM tall GROUP BY feature")
    s["null_counts"] = with_(TX_EVENTS, body=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({q(c)}) AS null_count FROM tx_events"
        for c in ["row_id", "Time", "Amount", "Class"]))
    s["class_distribution"] = with_(TX_EVENTS, body=
                                    f'SELECT "Class", n, round(n * {D(100)} / sum(n) OVER (), 6) AS pct '
                                    'FROM (SELECT "Class", count(*) AS n FROM tx_events GROUP BY "Class")')
    corr_rows = []
    for i in range(len(LINE_COLS)):
        for j in range(i):
            a, b = LINE_COLS[i], LINE_COLS[j]
            corr_rows.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
                             f"round(corr({D(q(a))}, {D(q(b))}), 6) AS corr FROM tx_lines")
    s["corr_matrix"] = with_(TX_LINES, body=" UNION ALL ".join(corr_rows))
    cw = "cw AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr({q(c)}, CAST(\"Class\" AS DOUBLE)) AS corr FROM tx_vectors" for c in VCOLS) + ")"
    s["corr_topk"] = with_(TX_VECTORS, cw, body=
                           "SELECT feature, round(corr, 6) AS corr, round(abs(corr), 6) AS abs_corr FROM cw "
                           "WHERE corr IS NOT NULL ORDER BY abs(corr) DESC, feature LIMIT 10")
    # density: histogram + kernel on bin centres
    dens_views = [TX_EVENTS, f'base AS (SELECT "Class", {hours()} AS "Time_Hours", "Amount" FROM tx_events)',
                  *density_views("base", ["Time_Hours", "Amount"])]
    s["density_by_class"] = with_(*dens_views, body=
                                  "SELECT feature, \"Class\", bin, round(x, 6) AS x, n, round(density, 9) AS density FROM dens")
    box_tall = f"tall AS ({unpivot('tx_lines', ['V1', 'V2', 'V3', 'V4', 'Amount'], ['Class'])})"
    s["box_stats"] = with_(TX_LINES, box_tall,
                           "qq AS (SELECT \"Class\", feature, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, "
                           "quantile_cont(x, 0.75) AS q3 FROM tall GROUP BY \"Class\", feature)",
                           f"ff AS (SELECT *, q3 - q1 AS iqr, q1 - {D(1.5)} * (q3 - q1) AS lo_fence, q3 + {D(1.5)} * (q3 - q1) AS hi_fence FROM qq)",
                           body="SELECT f.\"Class\", f.feature, count(*) AS n, round(any_value(f.q1), 6) AS q1, "
                                "round(any_value(f.median), 6) AS median, round(any_value(f.q3), 6) AS q3, round(any_value(f.iqr), 6) AS iqr, "
                                "round(min(t.x) FILTER (WHERE t.x >= f.lo_fence), 6) AS whisker_lo, "
                                "round(max(t.x) FILTER (WHERE t.x <= f.hi_fence), 6) AS whisker_hi, "
                                "count(*) FILTER (WHERE t.x < f.lo_fence OR t.x > f.hi_fence) AS n_outliers "
                                "FROM tall t JOIN ff f ON t.\"Class\" = f.\"Class\" AND t.feature = f.feature GROUP BY f.\"Class\", f.feature")
    s["amount_quantile_flags"] = with_(TX_EVENTS, AMT_STATS, ENG, body=
                                       'SELECT row_id, "Is_High_Amount", "Is_Very_High_Amount", "Is_Low_Amount" FROM eng')
    s["amount_decile"] = with_(TX_EVENTS, AMT_STATS, ENG, body='SELECT row_id, "Amount", "Amount_Bin" FROM eng')
    s["amount_zscore"] = with_(TX_EVENTS, AMT_STATS, ENG, body='SELECT row_id, round("Amount_ZScore", 6) AS "Amount_ZScore" FROM eng')
    s["engineer_features"] = with_(TX_EVENTS, AMT_STATS, ENG, body=f"SELECT {eng_select(ENG_COLS)} FROM eng")
    s["decile_fraud_rate"] = with_(TX_EVENTS, AMT_STATS, ENG, body=
                                   f'SELECT "Amount_Bin", n, n_fraud, round(n_fraud * {D(100)} / n, 6) AS fraud_pct FROM '
                                   '(SELECT "Amount_Bin", count(*) AS n, count(*) FILTER (WHERE "Class" = 1) AS n_fraud FROM eng GROUP BY "Amount_Bin")')
    s["stratified_split"] = with_(TX_EVENTS, _split_sql(VAL_SIZE), body='SELECT row_id, "Class", split FROM sp')
    s["random_split"] = with_(TX_EVENTS, _split_sql(0.0, stratify=False), body="SELECT row_id, split FROM sp")
    s["stratified_kfold"] = with_(TX_EVENTS, f"h AS (SELECT *, {md5_hash('row_id', SPLIT_SEED, 'fold')} AS h FROM tx_events)",
                                  "r AS (SELECT *, row_number() OVER (PARTITION BY \"Class\" ORDER BY h, row_id) - 1 AS rk, count(*) OVER (PARTITION BY \"Class\") AS n FROM h)",
                                  body='SELECT row_id, "Class", CAST(CASE WHEN rk < (n // 5 + 1) * (n % 5) THEN rk // (n // 5 + 1) '
                                       'ELSE n % 5 + (rk - (n // 5 + 1) * (n % 5)) // (n // 5) END AS INTEGER) AS fold FROM r')
    base_split = _split_sql(0.0)
    std_fit = ('fit AS (SELECT avg("Time") AS mt, stddev_pop("Time") AS st, avg("Amount") AS ma, stddev_pop("Amount") AS sa '
               "FROM sp WHERE split = 'train')")
    sc = lambda c, m, s_: f"round(({q(c)} - {m}) / (CASE WHEN {s_} IS NULL OR {s_} = 0 THEN {D(1)} ELSE {s_} END), 6) AS {q(c)}"
    s["standard_scale"] = with_(TX_EVENTS, base_split, std_fit, body=
                                f"SELECT row_id, split, {sc('Time', 'mt', 'st')}, {sc('Amount', 'ma', 'sa')} FROM sp, fit")
    rob_fit = ('fit AS (SELECT quantile_cont("Time", 0.5) AS mt, quantile_cont("Time", 0.75) - quantile_cont("Time", 0.25) AS st, '
               'quantile_cont("Amount", 0.5) AS ma, quantile_cont("Amount", 0.75) - quantile_cont("Amount", 0.25) AS sa '
               "FROM sp WHERE split = 'train')")
    s["robust_scale"] = with_(TX_EVENTS, base_split, rob_fit, body=
                              f"SELECT row_id, split, {sc('Time', 'mt', 'st')}, {sc('Amount', 'ma', 'sa')} FROM sp, fit")
    s["random_under"] = with_(TX_EVENTS,
                              f"h AS (SELECT *, {md5_hash('row_id', SPLIT_SEED, 'under')} AS h FROM tx_events)",
                              'r AS (SELECT *, row_number() OVER (PARTITION BY "Class" ORDER BY h, row_id) - 1 AS rk, '
                              'count(*) OVER (PARTITION BY "Class") AS n FROM h)',
                              'mn AS (SELECT "Class" AS cmin, n AS nmin FROM (SELECT "Class", count(*) AS n FROM tx_events GROUP BY "Class") '
                              'ORDER BY n, "Class" LIMIT 1)',
                              body='SELECT row_id, "Class" FROM r, mn WHERE rk < (CASE WHEN "Class" = cmin THEN n ELSE least(n, nmin) END)')
    s["confusion_matrix"] = with_(TX_EVENTS, SCORED, dec, body=
                                  "SELECT label AS actual, count(*) FILTER (WHERE prediction = 0) AS pred_0, "
                                  "count(*) FILTER (WHERE prediction = 1) AS pred_1 FROM dec GROUP BY label")
    s["threshold_metrics"] = with_(TX_EVENTS, SCORED, dec, _thr_sql("dec"), body=
                                   "SELECT round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                                   "round(f1, 6) AS f1, round(mcc, 6) AS mcc FROM thr")
    s["roc_auc"] = with_(TX_EVENTS, SCORED, _auc_sql("scored"), body="SELECT round(roc_auc, 6) AS roc_auc FROM auc")
    s["average_precision"] = with_(TX_EVENTS, SCORED, _auc_sql("scored"), body=
                                   "SELECT round(average_precision, 6) AS average_precision FROM ap")
    s["class_report"] = with_(TX_EVENTS, SCORED, dec,
                              "cells AS (SELECT label, prediction, count(*) AS n FROM dec GROUP BY label, prediction)",
                              "cls AS (SELECT label AS c FROM cells UNION SELECT prediction FROM cells)",
                              "per AS (SELECT c, coalesce((SELECT sum(n) FROM cells WHERE label = c AND prediction = c), 0) AS tp, "
                              "coalesce((SELECT sum(n) FROM cells WHERE label = c), 0) AS sup, "
                              "coalesce((SELECT sum(n) FROM cells WHERE prediction = c), 0) AS predc FROM cls)",
                              "pr AS (SELECT c, CASE WHEN predc > 0 THEN CAST(tp AS DOUBLE) / CAST(predc AS DOUBLE) ELSE 0.0 END AS p, "
                              "CASE WHEN sup > 0 THEN CAST(tp AS DOUBLE) / CAST(sup AS DOUBLE) ELSE 0.0 END AS r, sup, tp FROM per)",
                              "pf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END AS f FROM pr)",
                              "tot AS (SELECT sum(sup) AS t, sum(tp) AS tps, count(*) AS k FROM pf)",
                              body="SELECT CAST(c AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(sup AS BIGINT) AS support FROM pf "
                                   "UNION ALL SELECT 'accuracy', NULL, NULL, round(CAST(tps AS DOUBLE) / CAST(t AS DOUBLE), 6), CAST(t AS BIGINT) FROM tot "
                                   "UNION ALL SELECT 'macro avg', round(sum(p) / max(k), 6), round(sum(r) / max(k), 6), round(sum(f) / max(k), 6), CAST(max(t) AS BIGINT) FROM pf, tot "
                                   "UNION ALL SELECT 'weighted avg', round(sum(p * sup) / max(t), 6), round(sum(r * sup) / max(t), 6), round(sum(f * sup) / max(t), 6), CAST(max(t) AS BIGINT) FROM pf, tot")
    n = len(SCORERS)
    soft = " + ".join(SCORERS) if False else " + ".join(list(SCORERS))
    s["vote_soft"] = with_(TX_EVENTS, MEMBERS, body=
                           f"SELECT row_id, label, round(({soft}) / {D(n)}, 6) AS score, "
                           f"CAST(({soft}) / {D(n)} > {D(0.5)} AS INTEGER) AS prediction FROM members")
    votes = " + ".join(f"CAST({k} > {D(0.5)} AS INTEGER)" for k in SCORERS)
    s["vote_hard"] = with_(TX_EVENTS, MEMBERS, body=
                           f"SELECT row_id, label, round(CAST({votes} AS DOUBLE) / {D(n)}, 6) AS score, "
                           f"CAST(({votes}) * 2 > {n} AS INTEGER) AS prediction FROM members")
    s["weighted"] = with_(TX_EVENTS, MEMBERS, _weighted_sql(), body="SELECT row_id, label, round(score, 6) AS score, prediction FROM wd")
    s["evaluate_ensemble"] = with_(TX_EVENTS, MEMBERS, _weighted_sql(), _auc_sql("wd"), _thr_sql("wd"), body=
                                   "SELECT round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision, "
                                   "round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                                   "round(f1, 6) AS f1 FROM auc, ap, thr")
    # selection on tx_vectors
    fsc = ("pc AS (SELECT feature, \"Class\", count(*) AS n, sum(x) AS s, sum(x * x) AS qq FROM tall GROUP BY feature, \"Class\"), "
           "fa AS (SELECT feature, sum(n) AS n, sum(s) AS s_all, sum(qq) AS q_all, sum(s * s / n) AS sb, count(*) AS g FROM pc GROUP BY feature), "
           "fs AS (SELECT p.position, p.feature, CASE WHEN g - 1 > 0 AND n - g > 0 AND "
           "(q_all - s_all * s_all / n) - (sb - s_all * s_all / n) <> 0 THEN "
           "((sb - s_all * s_all / n) / (g - 1)) / (((q_all - s_all * s_all / n) - (sb - s_all * s_all / n)) / (n - g)) END AS score "
           "FROM fa JOIN pos p USING (feature))")
    s["select_f_test"] = with_(TX_VECTORS, _vec_tall(), _positions(), fsc, body=_topk_sql("fs", 10))
    mi_views = [
        TX_VECTORS, _vec_tall(), _positions(),
        f"ed AS (SELECT feature, list_sort(list_distinct(quantile_cont(x, {DECILES}))) AS e FROM tall GROUP BY feature)",
        "bn AS (SELECT t.feature, t.\"Class\", len(list_filter(list_slice(e, 2, len(e) - 1), lambda v: v < t.x)) AS bin "
        "FROM tall t JOIN ed USING (feature))",
        "cnt AS (SELECT feature, bin, \"Class\", count(*) AS k FROM bn GROUP BY feature, bin, \"Class\")",
        "mg AS (SELECT *, sum(k) OVER (PARTITION BY feature) AS n, sum(k) OVER (PARTITION BY feature, bin) AS pb, "
        "sum(k) OVER (PARTITION BY feature, \"Class\") AS pc FROM cnt)",
        "mi AS (SELECT p.position, p.feature, greatest(sum((CAST(k AS DOUBLE) / CAST(n AS DOUBLE)) * "
        "ln(CAST(k * n AS DOUBLE) / CAST(pb * pc AS DOUBLE))), 0.0) AS score FROM mg JOIN pos p USING (feature) GROUP BY p.position, p.feature)",
    ]
    s["select_mutual_info"] = with_(*mi_views, body=_topk_sql("mi", 10))
    s["select_corr"] = with_(TX_VECTORS, _positions(), cw.replace("AS corr", "AS c"),
                             "cs AS (SELECT p.position, p.feature, abs(c) AS score FROM cw JOIN pos p USING (feature))",
                             body=_topk_sql("cs", 10))
    s["eda_report"] = eda_sql()
    return s
