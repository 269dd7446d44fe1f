"""Exact quantiles without collecting a group into one task.

``percentile`` in Spark keeps every distinct value of a group in one
aggregation buffer; at scale one class or feature holding a third of the
rows would land in a single task. Here the exact order statistic is found
by narrowing a value bracket with histograms:

1. one aggregate pass gives count, min and max per key (key = group
   columns + feature);
2. each pass counts the rows of every open bracket into ``n_buckets``
   buckets (with the bucket's own min and max), a partial aggregate that
   map-side combines; a running sum per bracket in Spark finds the bucket
   of each wanted rank, and one row per target comes back. A bracket that
   spans several magnitudes, zero or an infinity is cut by logarithm, a
   narrow one evenly, so a pass always parts its least from its largest
   value and a few passes narrow any doubles;
3. once a bracket holds at most ``max_bracket`` rows, the rows in it are
   ranked with a window partitioned by bracket (bounded per task). A
   bracket whose min equals its max is resolved without any ranking, so a
   value repeated a billion times costs nothing extra.

Interpolation is linear between the two order statistics around
``p * (n - 1)``: ``lo + frac * (hi - lo)`` (pandas / DuckDB
``quantile_cont`` semantics).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _tall(df: DataFrame, cols, by, kind: str = "double") -> DataFrame:
    casted = df.select(*by, *[F.col(c).cast(kind).alias(c) for c in cols])
    tall = casted.unpivot(list(by), list(cols), "feature", "x") if by else \
        casted.unpivot([], list(cols), "feature", "x")
    return tall.where(F.col("x").isNotNull() & ~F.isnan("x"))


def exact_quantiles(df: DataFrame, cols, probs, by=(), n_buckets: int = 4096,
                    max_bracket: int = 50_000,
                    approx: bool = False, accuracy: int = 10_000):
    """Return ``{(by values..., feature): [q(p) for p in probs]}``.

    Keys with no non-null value map to a list of ``None``. ``approx=True``
    switches to one ``percentile_approx`` pass (bounded memory sketch).
    """
    cols, by, probs = list(cols), list(by), [float(p) for p in probs]
    keys = by + ["feature"]
    tall = _tall(df, cols, by)
    if approx:
        rows = tall.groupBy(*keys).agg(
            F.percentile_approx("x", probs, accuracy).alias("q")).collect()
        out = {tuple(r[k] for k in keys): list(r["q"]) for r in rows}
        return out

    stats = tall.groupBy(*keys).agg(
        F.count("x").alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx")).collect()

    targets = {}  # tid -> dict
    plan = {}     # key -> list of (lo_tid, hi_tid, frac)
    tid = 0
    for r in stats:
        key = tuple(r[k] for k in keys)
        n = r["n"]
        plan[key] = []
        rank_tid = {}
        for p in probs:
            pos = p * (n - 1)
            lo = int(math.floor(pos))
            hi = min(lo + 1, n - 1)
            frac = pos - lo
            ids = []
            for rk in (lo, hi):
                if rk not in rank_tid:
                    rank_tid[rk] = tid
                    targets[tid] = dict(key=key, rank=rk, L=r["mn"], U=r["mx"],
                                        below=0, cnt=n, value=None)
                    tid += 1
                ids.append(rank_tid[rk])
            plan[key].append((ids[0], ids[1], frac))

    _select(df.sparkSession, tall, keys, targets, n_buckets, max_bracket)

    out = {}
    for key, lst in plan.items():
        vals = []
        for lo_t, hi_t, frac in lst:
            lo, hi = targets[lo_t]["value"], targets[hi_t]["value"]
            vals.append(lo if frac == 0 or lo == hi else lo + frac * (hi - lo))
        out[key] = vals
    # keys without rows
    for_keys = {k[:-1] for k in out}
    if not by:
        for c in cols:
            out.setdefault((c,), [None] * len(probs))
    else:
        for g in for_keys:
            for c in cols:
                out.setdefault((*g, c), [None] * len(probs))
    return out


def column_quantiles(df: DataFrame, col: str, probs, approx: bool = False) -> list:
    """Quantiles of one column over the whole table."""
    return exact_quantiles(df, [col], probs, approx=approx)[(col,)]


def _bracket_rows(spark, tall, keys, brackets):
    """Rows of ``tall`` inside each bracket, tagged with its id.

    ``brackets``: list of (bid, key tuple, L, U). An equi-join on the key
    with the broadcast bracket table (keys x targets rows) plus a range
    filter inside the join, all in generated code.
    """
    kind = tall.schema["x"].dataType.simpleString()
    number = int if kind == "bigint" else float
    bdf = spark.createDataFrame(
        [(b, *k, number(lo), number(hi), _wide(lo, hi)) for b, k, lo, hi in brackets],
        f"bid int, {', '.join(f'`{k}` {t}' for k, t in zip(keys, _key_types(tall, keys)))}, "
        f"L {kind}, U {kind}, wide boolean")
    return (tall.join(F.broadcast(bdf), on=keys)
            .where((F.col("x") >= F.col("L")) & (F.col("x") <= F.col("U")))
            .select("x", "bid", "L", "U", "wide"))


def _wide(lo, hi) -> bool:
    """Whether a bracket is to be cut by magnitude."""
    return isinstance(lo, float) and (math.isinf(lo) or math.isinf(hi) or lo * hi <= 0 or max(abs(lo), abs(hi)) > 4 * min(abs(lo), abs(hi)))


def _magnitude(c: str):
    """Ascending code of any double: 0 for 0, 55 to 1510 for positive ones, more for infinity (log doesn't descend)."""
    x = F.col(c)
    size = F.when(F.abs(x) == F.lit(math.inf), F.lit(2000.0)).otherwise(F.log(F.abs(x)) + F.lit(800.0))
    return F.when(x == 0, F.lit(0.0)).when(x > 0, size).otherwise(-size)


def _key_types(tall, keys):
    return [tall.schema[k].dataType.simpleString() for k in keys]


def _select(spark, tall, keys, targets, n_buckets=4096, max_bracket=50_000):
    """Fill ``targets[tid]['value']`` with the exact order statistic of each target.

    A target is ``dict(key=tuple, rank=int, L=min, U=max, below=0, cnt=n, value=None)``.
    Targets sharing a bracket (same key and bounds) share one histogram.
    """
    def _resolve_equal():
        for t in targets.values():
            if t["value"] is None and t["L"] == t["U"]:
                t["value"] = t["L"]

    _resolve_equal()
    if tall.schema["x"].dataType.simpleString() == "bigint":  # differences of large ids stay exact
        apart = lambda a, b: (F.col(a).cast("decimal(20,0)") - F.col(b).cast("decimal(20,0)")).cast("double")
    else:
        apart = lambda a, b: F.when(F.col("wide"), _magnitude(a) - _magnitude(b)).otherwise(F.col(a) - F.col(b))
    while True:
        open_t = [(i, t) for i, t in targets.items()
                  if t["value"] is None and t["cnt"] > max_bracket]
        if not open_t:
            break
        bids = {}
        for i, t in open_t:
            bids.setdefault((t["key"], t["L"], t["U"]), len(bids))
        rows = _bracket_rows(spark, tall, keys, [(b, k, lo, hi) for (k, lo, hi), b in bids.items()])
        b = F.least(F.floor(apart("x", "L") / apart("U", "L")
                            * F.lit(float(n_buckets))).cast("int"), F.lit(n_buckets - 1))
        hist = rows.groupBy("bid", b.alias("b")).agg(F.count("*").alias("c"), F.min("x").alias("mn"), F.max("x").alias("mx"))
        upto = F.sum("c").over(Window.partitionBy("bid").orderBy("b"))  # at most n_buckets rows
        wants = spark.createDataFrame([(i, bids[(t["key"], t["L"], t["U"])], int(t["rank"] - t["below"])) for i, t in open_t], "tid int, bid int, want long")
        found = (hist.withColumn("upto", upto).join(F.broadcast(wants), "bid")
                 .where((F.col("want") < F.col("upto")) & (F.col("want") >= F.col("upto") - F.col("c"))).collect())
        for r in found:
            t = targets[r["tid"]]
            t.update(L=r["mn"], U=r["mx"], below=t["below"] + r["upto"] - r["c"], cnt=r["c"])
        _resolve_equal()

    rest = [(i, t) for i, t in targets.items() if t["value"] is None]
    if rest:
        bids, wants = {}, {}
        for i, t in rest:
            b_ = bids.setdefault((t["key"], t["L"], t["U"]), len(bids))
            wants.setdefault(b_, []).append((i, int(t["rank"] - t["below"])))
        rows = _bracket_rows(spark, tall, keys, [(b, k, lo, hi) for (k, lo, hi), b in bids.items()])
        w = Window.partitionBy("bid").orderBy("x")
        want_rows = [(b_, r) for b_, lst in wants.items() for _, r in lst]
        wdf = spark.createDataFrame(want_rows, "w_bid int, want long").distinct()
        picked = (rows.withColumn("rn", F.row_number().over(w) - 1)
                  .join(F.broadcast(wdf), (F.col("bid") == F.col("w_bid")) & (F.col("rn") == F.col("want")))
                  .select("bid", "rn", "x").collect())
        got = {(r["bid"], r["rn"]): r["x"] for r in picked}
        for b_, lst in wants.items():
            for i, r in lst:
                targets[i]["value"] = got.get((b_, r))


def values_at(df: DataFrame, col: str, wants: dict, by=(), **kw) -> dict:
    """Exact values at 0-based ascending ranks, given for each group: ``{by values: [value at each rank]}``;
    None beyond a group's rows. Integers stay integers, so ids above 2**53 keep their order."""
    by = list(by)
    keys = by + ["feature"]
    whole = df.schema[col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    tall = _tall(df, [col], by, "bigint" if whole else "double")
    stats = tall.groupBy(*keys).agg(F.count("x").alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx")).collect()
    targets, plan = {}, {key: [None] * len(ranks) for key, ranks in wants.items()}
    for r in stats:
        group = tuple(r[k] for k in by)
        for at, rank in enumerate(wants.get(group, ())):
            if 0 <= rank < r["n"]:
                plan[group][at] = len(targets)
                targets[len(targets)] = dict(key=(*group, col), rank=int(rank), L=r["mn"], U=r["mx"], below=0, cnt=r["n"], value=None)
    _select(df.sparkSession, tall, keys, targets, **kw)
    return {g: [None if t is None else targets[t]["value"] for t in found] for g, found in plan.items()}


def order_statistics(df: DataFrame, col: str, ranks, **kw) -> dict:
    """Exact values at 0-based ascending ranks of a column: ``{(col,): [v(rank)...]}``."""
    return {(col,): values_at(df, col, {(): list(ranks)}, **kw)[()]}
