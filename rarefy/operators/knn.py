"""k-nearest-neighbour joins: exact over a median tree, or approximate by LSH.

``knn_join`` returns for every query row the k reference rows with the smallest
Euclidean distance (ties by reference id), optionally skipping the row itself.
Nothing compares every query with every reference:

1. Tree. The reference vectors are cut at medians, level by level, until a leaf has
   about ``leaf_rows`` different vectors; the depth follows their number. Cuts come
   from a sample of ``fit_rows`` different vectors a cell, several levels a job.
   The tree and the leaves' boxes are broadcast; ``tree_bytes`` bounds them, and
   with them the depth (half a million leaves at 8 features).
2. Leaves. Each task drops copies (of one vector, no more than the ``k`` (+ 1)
   smallest ids can be among any query's nearest), so a vector that is
   repeated a billion times costs a few rows; a leaf then is one packed row.
3. Own leaf. Each query meets its own leaf; its kth distance there bounds
   what it still needs. The boxes it reaches within that bound are found from the
   root down, and only these leaves are visited. A query that reaches none is done.
4. Visits meet the packed leaves; queries of a crowded leaf are dealt out to
   groups of ``group_rows``, so no task holds more than a leaf and one group.

Defined results: a vector with a null, NaN or infinite component is no reference
and gets no neighbours; no references give an empty result; fewer than k
references are all returned; query ids are keys, repeated reference ids are rows of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage, ship_package


def _fcols(d):
    return [f"_f{i}" for i in range(d)]


def _sqdist(Q: np.ndarray, R: np.ndarray) -> np.ndarray:
    """Squared distances, summed dimension by dimension in column order."""
    D = np.zeros((Q.shape[0], R.shape[0]))
    diff = np.empty_like(D)
    for j in range(Q.shape[1]):
        np.subtract(Q[:, j, None], R[None, :, j], out=diff)
        np.multiply(diff, diff, out=diff)
        D += diff
    return D


class MedianTree:
    """Complete binary tree over vectors. Node 1 is the root; node i has the children
    2i (up to the cut) and 2i + 1. Leaves are numbered from 0 on."""

    def __init__(self):
        self.dim, self.cut = np.zeros(1, dtype=np.int64), np.zeros(1)
        self.low = self.high = self.count = None

    @property
    def depth(self) -> int:
        return len(self.dim).bit_length() - 1

    def leaf(self, X: np.ndarray) -> np.ndarray:
        node = np.ones(len(X), dtype=np.int64)
        rows = np.arange(len(X))
        for _ in range(self.depth):
            node = 2 * node + (X[rows, self.dim[node]] > self.cut[node])
        return node - (1 << self.depth)

    def grow(self, fitted: dict[int, list], levels: int) -> None:
        """Adds levels; ``fitted`` has (dims, cuts) of the new nodes of each cell, level by level.
        A cell without a fit sends all rows to the left."""
        cells = 1 << self.depth
        for level in range(levels):
            dim, cut = np.zeros(cells << level, dtype=np.int64), np.full(cells << level, np.inf)
            for cell, by_level in fitted.items():
                dim[cell << level:(cell + 1) << level], cut[cell << level:(cell + 1) << level] = by_level[level]
            self.dim, self.cut = np.concatenate([self.dim, dim]), np.concatenate([self.cut, cut])

    def bound(self, leaves: np.ndarray, low: np.ndarray, high: np.ndarray, count: np.ndarray, d: int) -> None:
        """Sets the boxes: those of the leaves as given, of other nodes around their children."""
        n = 1 << self.depth
        self.low, self.high = np.full((2 * n, d), np.inf), np.full((2 * n, d), -np.inf)
        self.count = np.zeros(2 * n, dtype=np.int64)
        self.low[n + leaves], self.high[n + leaves], self.count[n + leaves] = low, high, count
        for i in range(self.depth - 1, -1, -1):
            a, b = slice(1 << i, 2 << i), slice(2 << i, 4 << i)
            self.low[a] = self.low[b].reshape(-1, 2, d).min(axis=1)
            self.high[a] = self.high[b].reshape(-1, 2, d).max(axis=1)
            self.count[a] = self.count[b].reshape(-1, 2).sum(axis=1)

    def reach(self, X: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Least distance of each row to each node's box."""
        total = np.zeros((len(X), len(nodes)))
        for j in range(X.shape[1]):
            gap = np.maximum(self.low[nodes, j] - X[:, j, None], X[:, j, None] - self.high[nodes, j])
            np.maximum(gap, 0.0, out=gap)
            total += gap * gap
        return np.sqrt(total)

    def within(self, X: np.ndarray, bound: np.ndarray, cells: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves with references whose box is within a row's bound."""
        step, rows, leaves = max(1, cells // max(1, 1 << min(self.depth, 12))), [], []
        for lo in range(0, len(X), step):
            part, limit = X[lo:lo + step], bound[lo:lo + step, None]
            nodes = np.ones(1, dtype=np.int64)
            for _ in range(self.depth):
                nodes = nodes[(self.reach(part, nodes) <= limit).any(axis=0)]
                nodes = np.concatenate([2 * nodes, 2 * nodes + 1])
                nodes = nodes[self.count[nodes] > 0]
            row, at = np.nonzero(self.reach(part, nodes) <= limit)
            rows.append(row + lo)
            leaves.append(nodes[at] - (1 << self.depth))
        return np.concatenate(rows), np.concatenate(leaves)

    def enough(self, x: np.ndarray, need: int) -> float:
        """A distance within which the row x has ``need`` references, by whole boxes (inf where there are fewer)."""
        if self.count[1] < need:
            return math.inf
        node = 1
        while 2 * node < len(self.count):  # the smaller child that still has enough, nearest first
            pair = np.array([2 * node, 2 * node + 1])
            pair = pair[self.count[pair] >= need]
            if not len(pair):
                break
            node = int(pair[self.reach(x[None], pair)[0].argmin()])
        far = np.maximum(np.abs(x - self.low[node]), np.abs(x - self.high[node]))
        return float(np.sqrt((far * far).sum()))


def fit_cuts(X: np.ndarray, levels: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(dims, cuts) of each level over the rows of a cell: the widest dimension at its median."""
    cells, out = [np.arange(len(X))], []
    for _ in range(levels):
        dims, cuts, split = np.zeros(len(cells), dtype=np.int64), np.full(len(cells), np.inf), []
        for i, rows in enumerate(cells):
            if len(rows) > 1:
                part = X[rows]
                q = np.quantile(part, [0.05, 0.95], axis=0)
                wide = q[1] - q[0]
                spread = part.max(axis=0) - part.min(axis=0)
                dims[i] = int(np.argmax(wide)) if wide.max() > 0 else int(np.argmax(spread))
                values = np.sort(part[:, dims[i]])
                cut = values[(len(values) - 1) // 2]
                if cut == values[-1]:  # ties up to the top: cut below them
                    below = values[values < cut]
                    cut = below[-1] if len(below) else np.inf
                cuts[i] = cut
            right = X[rows, dims[i]] > cuts[i]
            split += [rows[~right], rows[right]]
        out.append((dims, cuts))
        cells = split
    return out


def _fitting(given, fc, levels: int):
    """What runs in the tasks of a fit: rows to their cells (each vector once a batch), and a cell's cuts."""
    def sampled(batches):
        for pdf in batches:
            pdf = pdf[np.isfinite(pdf.to_numpy(dtype=float)).all(axis=1)].drop_duplicates()
            pdf.insert(0, "cell", given.value.leaf(pdf.to_numpy(dtype=float)))
            yield pdf

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        cuts = fit_cuts(np.unique(pdf[list(fc)].to_numpy(dtype=float), axis=0), levels)
        return pd.DataFrame({"cell": pdf["cell"].iloc[:1], "dims": [np.concatenate([c[0] for c in cuts]).tobytes()],
                             "cuts": [np.concatenate([c[1] for c in cuts]).tobytes()]})

    return sampled, fitted


def fit_tree(vectors: DataFrame, fc, n: int, leaf_rows: int, fit_rows: int, fit_levels: int, tree_bytes: int, seed: int) -> MedianTree:
    """The tree over the vectors' columns ``fc``, of which ``n`` (about) are different."""
    most = max(0, int(math.log2(tree_bytes / (32 * len(fc) + 32))))
    depth = min(most, max(0, math.ceil(math.log2(max(1, n / leaf_rows)))))
    tree, spark = MedianTree(), vectors.sparkSession
    own = F.pmod(F.xxhash64(F.lit(seed), *fc), F.lit(1 << 30))
    for start in range(0, depth, fit_levels):
        more = min(fit_levels, depth - start)
        given = spark.sparkContext.broadcast(tree)
        # copies have one hash: the sample is of different vectors
        share = min(1.0, fit_rows * (1 << start) / max(1, n))
        sampled, fitted = _fitting(given, fc, more)
        rows = (vectors.where(own < F.lit(int(share * (1 << 30)))).select(*fc).mapInPandas(sampled, "cell long, " + ", ".join(f"{c} double" for c in fc))
                .groupBy("cell").applyInPandas(fitted, "cell long, dims binary, cuts binary"))
        found = {}
        for r in rows.toLocalIterator():  # 16 bytes a node
            dims, cuts = np.frombuffer(r["dims"], np.int64), np.frombuffer(r["cuts"])
            found[r["cell"]] = [(dims[(1 << i) - 1:(2 << i) - 1], cuts[(1 << i) - 1:(2 << i) - 1]) for i in range(more)]
        tree.grow(found, more)
        given.destroy()
    return tree


def smallest_ids(X: np.ndarray, ids: np.ndarray, need: int) -> np.ndarray:
    """Places of the rows to keep: of equal vectors those with the ``need`` smallest ids."""
    order = np.lexsort((ids, *X.T[::-1]))
    same = np.concatenate([[False], (X[order][1:] == X[order][:-1]).all(axis=1)]) if len(X) else np.zeros(0, dtype=bool)
    at = np.arange(len(order))
    first = np.maximum.accumulate(np.where(same, 0, at)) if len(order) else at
    return order[at - first < need]


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def nearest(Q: np.ndarray, qid: np.ndarray, R: np.ndarray, rid: np.ndarray, k: int, exclude_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, reference, distance) of each query's k nearest by (distance, reference id)."""
    found = []
    step = max(1, (1 << 21) // max(1, len(R)))
    for lo in range(0, len(Q), step):
        # distance = sqrt of the dimension-by-dimension sum of squares, the same order as the SQL oracle
        D = np.sqrt(_sqdist(Q[lo:lo + step], R))
        if exclude_self:
            D[qid[lo:lo + step, None] == rid[None, :]] = np.inf
        kk = min(k, D.shape[1])
        part = np.argpartition(D, kk - 1, axis=1)[:, :kk] if kk < D.shape[1] else np.tile(np.arange(D.shape[1]), (len(D), 1))
        kth = np.take_along_axis(D, part, axis=1).max(axis=1)
        # rows whose kth distance is tied with one left out take all within it
        tied = ((D <= kth[:, None]).sum(axis=1) > kk) & np.isfinite(kth)
        row, at = np.repeat(np.arange(len(D)), kk), part.reshape(-1)
        keep = ~tied[row]
        more, ref = np.nonzero((D <= kth[:, None]) & tied[:, None])
        row, at = np.concatenate([row[keep], more]), np.concatenate([at[keep], ref])
        dist = D[row, at]
        order = np.lexsort((rid[at], dist, row))
        row, at, dist = row[order], at[order], dist[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        ok = np.isfinite(dist) & (place < kk)
        found.append((row[ok] + lo, at[ok], dist[ok]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def knn_join(query: DataFrame, reference: DataFrame, features, k: int = 5,
             id_col: str = "row_id", ref_cols=(), exclude_self: bool = False,
             with_vectors: bool = False, leaf_rows: int = 512, fit_rows: int = 16_384, fit_levels: int = 8,
             group_rows: int = 4096, tree_bytes: int = 128 << 20, seed: int = 7, materialize: bool = True) -> DataFrame:
    """Return (q_id, r_id, dist, rank[, r_v], ref_cols...) with rank 1..k per query."""
    spark = query.sparkSession
    ship_package(spark)
    features, ref_cols = list(features), list(ref_cols)
    d = len(features)
    fc = _fcols(d)
    vector = [F.col(c).cast("double").alias(f) for c, f in zip(features, fc)]
    ref = reference.select(F.col(id_col).cast("long").alias("r_id"), *vector, *[F.col(c) for c in ref_cols])
    qry = query.select(F.col(id_col).cast("long").alias("q_id"), *vector)
    need = k + (1 if exclude_self else 0)
    n = ref.agg(F.approx_count_distinct(F.xxhash64(*fc)).alias("n")).first()["n"]
    if n == 0:
        return _empty(spark, reference, ref_cols, with_vectors)
    tree = fit_tree(ref, fc, n, leaf_rows, fit_rows, fit_levels, tree_bytes, seed)
    bare = spark.sparkContext.broadcast(tree)

    # references: copies go, then a leaf is one packed row (more only where it has over 8192 references)
    matrix = lambda t: np.column_stack([t.column(f).to_numpy(zero_copy_only=False) for f in fc])

    def whole(b: pa.RecordBatch, key: str) -> pa.RecordBatch:
        """Rows with an id and all features. A filter in the plan would repeat the features' expressions in it."""
        keep = np.isfinite(matrix(b)).all(axis=1) & b.column(key).is_valid().to_numpy(zero_copy_only=False)
        return b if keep.all() else b.filter(pa.array(keep))

    ref_fields = ref.schema.fields

    def capped(batches):
        for b in batches:
            b = whole(b, "r_id")
            b = b.take(pa.array(smallest_ids(matrix(b), b.column("r_id").to_numpy(), need)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bare.value.leaf(matrix(b)))], [*b.schema.names, "leaf"])

    def packed(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(smallest_ids(matrix(table), table.column("r_id").to_numpy(), need)))
        X, out = matrix(table), []
        for lo in range(0, len(X), 8192):
            part = X[lo:lo + 8192]
            out.append((table.column("leaf")[0].as_py(), len(part), part.min(axis=0).tobytes(), part.max(axis=0).tobytes(),
                        _ipc(table.slice(lo, 8192).select(["r_id", *fc, *ref_cols]))))
        return pa.table(dict(zip(["leaf", "n", "low", "high", "body"], zip(*out))))

    # intermediates are persisted (recomputable from lineage if an executor
    # is lost) and released once the result is checkpointed
    blocks = (ref.mapInArrow(capped, T.StructType([*ref_fields, T.StructField("leaf", T.LongType())]))
              .groupBy("leaf").applyInArrow(packed, "leaf long, n long, low binary, high binary, body binary").persist(StorageLevel.MEMORY_AND_DISK))
    boxes = blocks.groupBy("leaf").agg(F.sum("n").alias("n"), F.collect_list("low").alias("low"), F.collect_list("high").alias("high")).collect()
    if not boxes:
        return _empty(spark, reference, ref_cols, with_vectors)
    corner = lambda parts, f: f([np.frombuffer(p) for p in parts], axis=0)
    tree.bound(np.array([r["leaf"] for r in boxes]), np.array([corner(r["low"], np.min) for r in boxes]),
               np.array([corner(r["high"], np.max) for r in boxes]), np.array([r["n"] for r in boxes]), d)
    boxed = spark.sparkContext.broadcast(tree)

    # queries by their own leaf
    q_fields = [T.StructField("q_id", T.LongType()), *[T.StructField(f, T.DoubleType()) for f in fc]]

    def homes(batches):
        for b in batches:
            b = whole(b, "q_id")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bare.value.leaf(matrix(b)))], [*b.schema.names, "leaf"])

    own = qry.mapInArrow(homes, T.StructType([*q_fields, T.StructField("leaf", T.LongType())])).persist(StorageLevel.MEMORY_AND_DISK)
    found_fields = [T.StructField("q_id", T.LongType()), T.StructField("r_id", T.LongType()), T.StructField("dist", T.DoubleType()),
                    *[T.StructField("r_v", T.ArrayType(T.DoubleType()))] * with_vectors, *[ref.schema[c] for c in ref_cols]]
    names = [f.name for f in found_fields]
    # of the own leaf: neighbours (rank is set where no visit follows) and visits in one table
    both_fields = [*found_fields, T.StructField("rank", T.IntegerType()), T.StructField("visit", T.LongType()), *q_fields[1:]]
    found_schema, both_schema = to_arrow_schema(T.StructType(found_fields)), to_arrow_schema(T.StructType(both_fields))

    def filled(columns: dict, schema: pa.Schema, n: int) -> pa.Table:
        """A table of the schema; columns that aren't given are null."""
        return pa.table([pa.chunked_array([columns[f.name]]) if isinstance(columns.get(f.name), pa.Array) else columns.get(f.name, pa.nulls(n, f.type))
                         for f in schema], schema.names).cast(schema)

    def meet(left: pa.Table, right: pa.Table) -> tuple[dict, np.ndarray]:
        """The k nearest of a group's queries among a leaf's references, and the places of their queries."""
        if not (left.num_rows and right.num_rows):
            return {}, np.zeros(0, dtype=int)
        refs = pa.concat_tables([pa.ipc.open_stream(b.as_py()).read_all() for b in right.column("body")])
        R, qid = matrix(refs), left.column("q_id").to_numpy()
        row, at, dist = nearest(matrix(left), qid, R, refs.column("r_id").to_numpy(), k, exclude_self)
        out = {"q_id": pa.array(qid[row]), "r_id": refs.column("r_id").take(pa.array(at)), "dist": pa.array(dist), **{c: refs.column(c).take(pa.array(at)) for c in ref_cols}}
        if with_vectors:
            out["r_v"] = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * d), pa.array(R[at].reshape(-1)))
        return out, row

    def home(left: pa.Table, right: pa.Table) -> pa.Table:
        """Neighbours in the own leaf, and the visits that the queries still have to make."""
        near, row = meet(left, right)
        if not left.num_rows:
            return filled({}, both_schema, 0)
        X, bound, held = matrix(left), np.zeros(left.num_rows), np.bincount(row, minlength=left.num_rows)
        if len(row):
            np.maximum.at(bound, row, near["dist"].to_numpy())
        for i in np.flatnonzero(held < k):
            bound[i] = boxed.value.enough(X[i], need)
        at, leaf = boxed.value.within(X, bound * (1 + 1e-9) + 1e-12)
        away = leaf != left.column("leaf")[0].as_py()
        at, leaf = at[away], leaf[away]
        done = np.ones(len(X), dtype=bool)
        done[at] = False
        place = np.arange(len(row)) - np.searchsorted(row, row) + 1
        visits = left.take(pa.array(at)).drop_columns(["leaf"])
        return pa.concat_tables([
            filled({**near, "rank": pa.array(place.astype(np.int32), mask=~done[row])}, both_schema, len(row)) if len(row) else filled({}, both_schema, 0),
            filled({**{c: visits.column(c) for c in ("q_id", *fc)}, "visit": pa.array(leaf)}, both_schema, len(at))])

    def away(left: pa.Table, right: pa.Table) -> pa.Table:
        near, row = meet(left, right)
        return filled(near, found_schema, len(row))

    def grouped(queries: DataFrame, run, fields) -> DataFrame:
        """Cogroups queries and packed leaves by leaf; queries of a crowded leaf by groups."""
        groups = queries.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(group_rows)).alias("_groups")).where("_groups > 1")
        salt = lambda df, c: df.join(groups, "leaf", "left").withColumn("_salt", c).drop("_groups")
        of = F.coalesce("_groups", F.lit(1))
        q = salt(queries, F.pmod(F.xxhash64("q_id"), of))
        b = salt(blocks.select("leaf", "body"), F.explode(F.sequence(F.lit(0).cast("long"), of - 1)))
        # explicit partitioning on the keys: AQE does not merge small but costly groups into a few tasks
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        q, b = q.repartition(parts, "leaf", "_salt"), b.repartition(parts, "leaf", "_salt")
        return q.select("q_id", *fc, "leaf", "_salt").groupBy("leaf", "_salt").cogroup(b.groupBy("leaf", "_salt")).applyInArrow(
            lambda left, right: run(left.drop_columns(["_salt"]), right), T.StructType(fields))

    first = grouped(own, home, both_fields).persist(StorageLevel.MEMORY_AND_DISK)
    second = grouped(first.where("visit IS NOT NULL").select("q_id", *fc, F.col("visit").alias("leaf")), away, found_fields)
    near = first.where("visit IS NULL")
    w = Window.partitionBy("q_id").orderBy("dist", "r_id")
    out = (near.where("rank IS NULL").select(*names).unionByName(second).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
           .unionByName(near.where("rank IS NOT NULL").select(*names, "rank")))
    if materialize:
        out = cut_lineage(out)
        for df in (first, own, blocks):
            df.unpersist()
        bare.unpersist()
        boxed.unpersist()
    return out


def _empty(spark, reference, ref_cols, with_vectors):
    fields = [T.StructField("q_id", T.LongType()), T.StructField("r_id", T.LongType()), T.StructField("dist", T.DoubleType())]
    if with_vectors:
        fields.append(T.StructField("r_v", T.ArrayType(T.DoubleType())))
    fields += [reference.schema[c] for c in ref_cols]
    return spark.createDataFrame([], T.StructType([*fields, T.StructField("rank", T.IntegerType())]))
