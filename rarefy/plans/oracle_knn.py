"""Brute-force DuckDB oracles of the kNN-based queries (small fixtures only)."""

from __future__ import annotations

from .common import SPLIT_SEED, TEST_SIZE
from .oracle import D, TX_EVENTS, _split_sql, hours, md5_hash, with_

TX = f'tx AS (SELECT row_id, {hours()} AS "Time_Hours", "Amount", "Class" FROM tx_events)'


def dist(a: str, b: str) -> str:
    return (f'sqrt(({a}."Time_Hours" - {b}."Time_Hours") * ({a}."Time_Hours" - {b}."Time_Hours") + '
            f'({a}."Amount" - {b}."Amount") * ({a}."Amount" - {b}."Amount"))')


def build() -> dict:
    s = {}
    s["knn_join"] = with_(TX_EVENTS, TX, body=
                          f"SELECT a.row_id AS q_id, b.row_id AS r_id, CAST(row_number() OVER (PARTITION BY a.row_id "
                          f"ORDER BY {dist('a', 'b')}, b.row_id) AS INTEGER) AS rank, round({dist('a', 'b')}, 6) AS dist "
                          f"FROM tx a JOIN tx b ON a.row_id <> b.row_id QUALIFY rank <= 5")
    s["knn_join_lsh"] = with_(TX_EVENTS, TX, body="SELECT count(*) AS queries, 5 * count(*) AS pairs, true AS recall_reached FROM tx")
    split = _split_sql(0.0).replace("FROM tx_events)", "FROM tx)", 1)
    s["knn_classify"] = with_(TX_EVENTS, TX, split,
                              "tr AS (SELECT * FROM sp WHERE split = 'train')",
                              "te AS (SELECT * FROM sp WHERE split = 'test')",
                              f"nn AS (SELECT a.row_id, a.\"Class\" AS label, b.\"Class\" AS nl, row_number() OVER "
                              f"(PARTITION BY a.row_id ORDER BY {dist('a', 'b')}, b.row_id) AS r FROM te a, tr b QUALIFY r <= 5)",
                              body=f"SELECT row_id, label, round(avg(CAST(nl AS DOUBLE)), 6) AS score, "
                                   f"CAST(avg(CAST(nl AS DOUBLE)) > {D(0.5)} AS INTEGER) AS prediction FROM nn GROUP BY row_id, label")
    s["nearmiss3"] = with_(TX_EVENTS, TX,
                           'mi AS (SELECT * FROM tx WHERE "Class" = 1)',
                           'ma AS (SELECT * FROM tx WHERE "Class" <> 1)',
                           f"near AS (SELECT a.row_id AS q, b.row_id AS r, row_number() OVER (PARTITION BY a.row_id "
                           f"ORDER BY {dist('a', 'b')}, b.row_id) AS k FROM mi a, ma b QUALIFY k <= 3)",
                           "cand AS (SELECT DISTINCT r AS row_id FROM near)",
                           f"far AS (SELECT c.row_id, {dist('c', 'b')} AS d, row_number() OVER (PARTITION BY c.row_id "
                           f"ORDER BY {dist('c', 'b')}, b.row_id) AS k FROM (SELECT ma.* FROM ma JOIN cand USING (row_id)) c, mi b QUALIFY k <= 3)",
                           "sc AS (SELECT row_id, avg(d) AS a FROM far GROUP BY row_id)",
                           "pick AS (SELECT row_id FROM sc ORDER BY a DESC, row_id LIMIT (SELECT count(*) FROM mi))",
                           body='SELECT row_id, "Class" FROM mi UNION ALL SELECT row_id, 0 FROM pick')
    s["tomek_links"] = with_(TX_EVENTS, TX,
                             f"nn AS (SELECT a.row_id AS q, a.\"Class\" AS ql, arg_min(b.row_id, {dist('a', 'b')}) AS r, "
                             f"arg_min(b.\"Class\", {dist('a', 'b')}) AS rl FROM tx a JOIN tx b ON a.row_id <> b.row_id GROUP BY a.row_id, a.\"Class\")",
                             body='SELECT x.q AS row_id, x.ql AS "Class" FROM nn x JOIN nn y ON x.r = y.q AND y.r = x.q WHERE x.ql <> x.rl')
    s["enn_filter"] = with_(TX_EVENTS, TX,
                            f"nn AS (SELECT a.row_id, a.\"Class\", min_by(b.\"Class\", {dist('a', 'b')}, 3) AS labs "
                            f"FROM tx a JOIN tx b ON a.row_id <> b.row_id GROUP BY a.row_id, a.\"Class\")",
                            "mn AS (SELECT \"Class\" AS cmin FROM tx GROUP BY \"Class\" ORDER BY count(*), \"Class\" LIMIT 1)",
                            body='SELECT row_id, "Class" FROM nn, mn WHERE "Class" = cmin OR '
                                 'len(list_filter(labs, lambda v: v <> "Class")) = 0')
    s.update(build_resample())
    s.update(build_combined())
    s.update(build_preprocess())
    s["resample"] = _counts_sql(s)
    return s


def _counts_sql(s: dict) -> str:
    """Rows per class before and after each method, over the methods' own statements."""
    under = with_(TX_EVENTS, TX, f"h AS (SELECT *, {md5_hash('row_id', SPLIT_SEED, 'under')} AS h FROM tx)",
                  'r AS (SELECT *, row_number() OVER (PARTITION BY "Class" ORDER BY h, row_id) AS rk FROM h)',
                  'mn AS (SELECT min(n) AS nmin FROM (SELECT count(*) AS n FROM tx GROUP BY "Class"))',
                  body='SELECT row_id, "Class" FROM r, mn WHERE rk <= nmin')
    after = {"none": with_(TX_EVENTS, TX, body='SELECT "Class" FROM tx'), "random_under": under, "smote": s["smote"], "adasyn": s["adasyn"],
             "nearmiss": s["nearmiss3"], "smote_tomek": s["smote_tomek"], "smote_enn": s["smote_enn"]}
    return " UNION ALL ".join(
        f"SELECT '{m}' AS method, b.\"Class\", b.n AS n_before, coalesce(a.n, 0) AS n_after FROM "
        f"(SELECT CAST(event_type = 'error' AS INTEGER) AS \"Class\", count(*) AS n FROM events GROUP BY 1) b "
        f"LEFT JOIN (SELECT \"Class\", count(*) AS n FROM ({sql}) GROUP BY 1) a ON a.\"Class\" = b.\"Class\"" for m, sql in after.items())


def _key_hash(salt: str, seed=SPLIT_SEED) -> str:
    return (f"('0x' || substr(md5(CAST(row_id AS VARCHAR) || ':' || CAST(j AS VARCHAR) || ':{seed}{salt}'), 1, 15))::BIGINT")


_PRM = """cc AS (SELECT "Class", count(*) AS n FROM tx GROUP BY "Class"),
mn AS (SELECT "Class" AS cmin, n AS nmin FROM cc ORDER BY n, "Class" LIMIT 1),
mx AS (SELECT max(n) AS nmax FROM cc),
prm AS (SELECT cmin, nmin, nmax - nmin AS n_new, least(5, nmin - 1) AS keff FROM mn, mx),
m AS (SELECT tx.* FROM tx, prm WHERE "Class" = cmin)"""


def _nn_minority() -> str:
    return (f"nn AS (SELECT a.row_id AS q, b.\"Time_Hours\" AS nh, b.\"Amount\" AS na, row_number() OVER "
            f"(PARTITION BY a.row_id ORDER BY {dist('a', 'b')}, b.row_id) AS rnk FROM m a JOIN m b "
            f"ON a.row_id <> b.row_id QUALIFY rnk <= (SELECT keff FROM prm))")


def _synth(mult: str) -> str:
    return f"""pk AS (SELECT dr.*, CAST(({_key_hash('nn')} % keff) + 1 AS BIGINT) AS pick,
  CAST({_key_hash('gap')} AS DOUBLE) / {D(2 ** 60)} AS gap FROM dr, prm),
syn AS (SELECT CAST(-(1 + r + {mult} * j) AS BIGINT) AS row_id,
  "Time_Hours" + gap * (nh - "Time_Hours") AS "Time_Hours", "Amount" + gap * (na - "Amount") AS "Amount",
  CAST(cmin AS INTEGER) AS "Class" FROM pk JOIN nn ON nn.q = pk.row_id AND nn.rnk = pk.pick, prm)"""


def build_resample() -> dict:
    s = {}
    rk = lambda salt: (f"rk AS (SELECT *, row_number() OVER (ORDER BY {md5_hash('row_id', SPLIT_SEED, salt)}, row_id) - 1 AS r FROM m)")
    s["smote"] = with_(TX_EVENTS, TX, _PRM, _nn_minority(), rk("smote"),
                       "dr AS (SELECT rk.*, unnest(range(CAST(n_new // nmin + CASE WHEN r < n_new % nmin THEN 1 ELSE 0 END AS BIGINT))) AS j FROM rk, prm)",
                       _synth("nmin"),
                       body='SELECT row_id, "Time_Hours", "Amount", "Class" FROM tx UNION ALL SELECT * FROM syn')
    s["adasyn"] = with_(TX_EVENTS, TX, _PRM, _nn_minority(), rk("adasyn"),
                        f"ar AS (SELECT a.row_id AS q, b.\"Class\" AS nl, row_number() OVER (PARTITION BY a.row_id "
                        f"ORDER BY {dist('a', 'b')}, b.row_id) AS k FROM m a JOIN tx b ON a.row_id <> b.row_id QUALIFY k <= 5)",
                        "cn AS (SELECT q, count(*) FILTER (WHERE nl <> cmin) AS c FROM ar, prm GROUP BY q)",
                        "tot AS (SELECT sum(c) AS t FROM cn)",
                        "gen AS (SELECT q AS row_id, CAST(round_even(CAST(c AS DOUBLE) * CAST(n_new AS DOUBLE) / CAST(t AS DOUBLE), 0) AS BIGINT) AS g FROM cn, tot, prm)",
                        "dr AS (SELECT rk.*, unnest(range(g)) AS j FROM rk JOIN gen USING (row_id) WHERE g > 0)",
                        _synth("nmin"),
                        body='SELECT row_id, "Time_Hours", "Amount", "Class" FROM tx UNION ALL SELECT * FROM syn')
    return s


def build_combined() -> dict:
    """SMOTE followed by Tomek-link removal or ENN, both classes cleaned ('all')."""
    s = {}
    smote_body = build_resample()["smote"]
    # reuse the SMOTE statement as a view
    head, _, tail = smote_body.partition("\nSELECT row_id, \"Time_Hours\", \"Amount\", \"Class\" FROM tx UNION ALL SELECT * FROM syn")
    rs = head + ",\nrs AS (SELECT row_id, \"Time_Hours\", \"Amount\", \"Class\" FROM tx UNION ALL SELECT * FROM syn)"
    s["smote_tomek"] = rs + f""",
nn1 AS (SELECT a.row_id AS q, a."Class" AS ql, arg_min(b.row_id, {dist('a', 'b')}) AS r,
        arg_min(b."Class", {dist('a', 'b')}) AS rl FROM rs a JOIN rs b ON a.row_id <> b.row_id GROUP BY a.row_id, a."Class"),
links AS (SELECT x.q FROM nn1 x JOIN nn1 y ON x.r = y.q AND y.r = x.q WHERE x.ql <> x.rl)
SELECT * FROM rs WHERE row_id NOT IN (SELECT q FROM links)"""
    s["smote_enn"] = rs + f""",
nn3 AS (SELECT a.row_id, a."Class" AS c, min_by(b."Class", {dist('a', 'b')}, 3) AS labs
        FROM rs a JOIN rs b ON a.row_id <> b.row_id GROUP BY a.row_id, a."Class")
SELECT rs.* FROM rs JOIN nn3 USING (row_id) WHERE len(list_filter(labs, lambda v: v <> c)) = 0"""
    return s


def build_preprocess() -> dict:
    """Split -> standard scaler fitted on train -> SMOTE on the scaled training rows."""
    split = _split_sql(0.0).replace("FROM tx_events)", "FROM tx)", 1)
    fit = ("fit AS (SELECT avg(\"Time_Hours\") AS mh, stddev_pop(\"Time_Hours\") AS sh, avg(\"Amount\") AS ma, "
           "stddev_pop(\"Amount\") AS sa FROM sp WHERE split = 'train')")
    sc = lambda c, m, s_: f"({q_(c)} - {m}) / (CASE WHEN {s_} IS NULL OR {s_} = 0 THEN {D(1)} ELSE {s_} END) AS {q_(c)}"
    scaled = (f"scl AS (SELECT row_id, {sc('Time_Hours', 'mh', 'sh')}, {sc('Amount', 'ma', 'sa')}, \"Class\", split "
              f"FROM sp, fit)")
    trn = "trn AS (SELECT row_id, \"Time_Hours\", \"Amount\", \"Class\" FROM scl WHERE split = 'train')"
    prm = _PRM.replace("FROM tx GROUP BY", "FROM trn GROUP BY").replace("SELECT tx.* FROM tx, prm", "SELECT trn.* FROM trn, prm")
    rk = f"rk AS (SELECT *, row_number() OVER (ORDER BY {md5_hash('row_id', SPLIT_SEED, 'smote')}, row_id) - 1 AS r FROM m)"
    dr = ("dr AS (SELECT rk.*, unnest(range(CAST(n_new // nmin + CASE WHEN r < n_new % nmin THEN 1 ELSE 0 END AS BIGINT))) AS j "
          "FROM rk, prm)")
    r6 = lambda c: f"round({q_(c)}, 6) AS {q_(c)}"
    body = (f"SELECT row_id, {r6('Time_Hours')}, {r6('Amount')}, \"Class\", 'train' AS split FROM trn "
            f"UNION ALL SELECT row_id, {r6('Time_Hours')}, {r6('Amount')}, \"Class\", 'train' FROM syn "
            f"UNION ALL SELECT row_id, {r6('Time_Hours')}, {r6('Amount')}, \"Class\", 'test' FROM scl WHERE split = 'test'")
    return {"preprocess": with_(TX_EVENTS, TX, split, fit, scaled, trn, prm, _nn_minority(), rk, dr,
                                _synth("nmin"), body=body)}


def q_(c: str) -> str:
    return f'"{c}"'
