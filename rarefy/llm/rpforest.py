"""Embedding near-dedup with a forest of random-projection trees.

1. Equal vectors are one node with a number of copies.
2. Forest. A tree splits its rows at the median of a random projection, one
   direction a level, with spill: a row whose projection lies within ``spill``
   of the median (as a share of the rows) goes to both sides. Medians come
   from a sample of ``fit_rows`` rows a cell (``fit_levels`` levels at a time,
   cells by what is fitted already); every row is indexed. The depth follows
   the number of rows, so leaves hold about ``leaf_rows`` rows at any size; it
   ends at ``max_levels`` (2 million leaves a tree), which bounds what is
   broadcast at 16 MB a tree.
3. Rows of a leaf are compared in double precision. A pair counts in the first
   leaf that both rows share in the order of trees (each row carries all its
   leaves), so what leaves a leaf is one row per vector: the
   number of its links and its smallest linked-up neighbour, never the pairs.
4. Dense groups. Around centres found in a sample of ``hub_rows`` rows, rows
   within half of the link angle form a ball: all its pairs link, which takes
   no comparison. A row links with all, none or, near the edge, some rows of a
   ball by the triangle inequality of angles; only for the last kind its
   vector visits the ball's rows, in blocks of ``block_rows``. So a group of
   near copies that holds a large share of all rows costs as many rows as it has
   members, and every one of its links is found. The forest takes the rows in no ball.
5. Connected components over the links; a ball is one star.

Links outside of the balls are found with a high chance, not surely: recall is
measured in the tests and in the README. None is found below the threshold.

Defined results: vectors that are null, empty or zero, hold null or non-finite
components, or have other numbers of components link with nothing or not with
each other; rows that repeat an id are rows of their own, equal vectors copies;
a null id takes part and gets the smallest id of its component (null where there
is none), and isn't kept; ties don't occur, all links at the threshold or above
count; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import checkpointed, frugal, frugal_group, prepared, written
from .graph import components

#: slack of angles, above the error of arccos in doubles
_SLACK = 1e-6


def directions(tree: int, levels: int, width: int, seed: int) -> np.ndarray:
    """width x levels: a random direction for each level of a tree."""
    return np.random.default_rng([seed, tree, width]).standard_normal((width, levels))


def padded(column: pa.Array, empty) -> tuple[np.ndarray, np.ndarray]:
    """The lists of a column as rows of one width, filled up with ``empty``, and their lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size, flat = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)
    out = np.full((len(size), int(size.max(initial=0))), empty)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out, size


def unit(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors in doubles, shorter ones padded with zeros, and their lengths."""
    out, size = padded(column, 0.0)
    out = np.pad(out, ((0, 0), (0, width - out.shape[1])))
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow of squares
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True)), size


class Tree:
    """Fitted levels of one tree. ``low[l]`` and ``high[l]`` hold the spill zone of each node of level l."""

    def __init__(self, number: int):
        self.number, self.low, self.high = number, [], []

    def home(self, projected: np.ndarray) -> np.ndarray:
        """Each row's cell without spill."""
        node = np.zeros(len(projected), dtype=np.int64)
        for level, (low, high) in enumerate(zip(self.low, self.high)):
            node = 2 * node + (projected[:, level] > (low[node] + high[node]) / 2)
        return node

    def leaves(self, projected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of all leaves that each row is in, by row."""
        row, node = np.arange(len(projected)), np.zeros(len(projected), dtype=np.int64)
        for level, (low, high) in enumerate(zip(self.low, self.high)):
            at = projected[row, level]
            left, right = at <= high[node], at >= low[node]
            row = np.concatenate([row[left], row[right]])
            node = np.concatenate([2 * node[left], 2 * node[right] + 1])
        order = np.lexsort((node, row))
        return row[order], node[order]

    def grow(self, cells: dict[int, list[np.ndarray]], levels: int) -> None:
        """Adds ``levels`` levels from the zones fitted for each cell; a cell without rows gets zones that send all left."""
        before = 1 << len(self.low)
        for level in range(levels):
            zones = np.full((before << level, 2), np.inf)
            for cell, fitted in cells.items():
                zones[cell << level:(cell + 1) << level] = fitted[level]
            self.low.append(zones[:, 0].astype(np.float64))
            self.high.append(zones[:, 1].astype(np.float64))


def fit_cell(projected: np.ndarray, levels: int, spill: float) -> list[np.ndarray]:
    """For each level, the zones (low, high) of a cell's nodes, from its sampled rows' projections."""
    nodes, out = [np.arange(len(projected))], []
    for level in range(levels):
        zones = np.full((len(nodes), 2), np.inf)
        split = []
        for i, rows in enumerate(nodes):
            at = projected[rows, level]
            if len(rows):
                zones[i] = np.quantile(at, [0.5 - spill, 0.5 + spill])
            middle = zones[i].mean() if len(rows) else np.inf
            split += [rows[at <= middle], rows[at > middle]]
        out.append(zones)
        nodes = split
    return out


def fit_forest(nodes: DataFrame, n: int, width: int, trees: int, leaf_rows: int, spill: float, fit_rows: int, fit_levels: int,
               max_levels: int, seed: int) -> list[Tree]:
    """The forest's zones, a few levels at a time."""
    depth = min(max_levels, max(0, math.ceil(math.log(max(1, n / leaf_rows)) / -math.log(0.5 + spill))))
    forest = [Tree(t) for t in range(trees)]
    for start in range(0, depth, fit_levels):
        more = min(fit_levels, depth - start)
        given = nodes.sparkSession.sparkContext.broadcast(forest)
        share = min(1.0, fit_rows * (1 << start) / max(1, n))

        def sampled(batches, given=given, start=start, more=more):
            for b in batches:
                if not b.num_rows:
                    continue
                vectors, _ = unit(b.column("v"), width)
                for tree in given.value:
                    projected = vectors @ directions(tree.number, max_levels, width, seed)[:, :start + more]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(vectors), tree.number, np.int32)), pa.array(tree.home(projected)),
                                                      pa.array([p.tobytes() for p in projected[:, start:].astype("<f8")], pa.binary())], ["tree", "cell", "at"])

        def fitted(table: pa.Table, more=more) -> pa.Table:
            at = np.frombuffer(b"".join(table.column("at").to_pylist()), "<f8").reshape(-1, more)
            zones = np.concatenate(fit_cell(at, more, spill))
            return pa.table({"tree": table.column("tree").slice(0, 1), "cell": table.column("cell").slice(0, 1), "zones": pa.array([zones.tobytes()], pa.binary())})

        rows = (nodes.where(F.pmod(F.xxhash64("node", F.lit(seed + start)), F.lit(1 << 20)) < F.lit(share * (1 << 20))).select("v")
                .mapInArrow(frugal(sampled), "tree int, cell long, at binary")
                .groupBy("tree", "cell").applyInArrow(frugal_group(fitted), "tree int, cell long, zones binary"))
        cells: list[dict] = [{} for _ in forest]
        for r in rows.toLocalIterator():  # 16 bytes a node
            zones = np.frombuffer(r["zones"], "<f8").reshape(-1, 2)
            cells[r["tree"]][r["cell"]] = [zones[(1 << i) - 1:(2 << i) - 1] for i in range(more)]
        for tree in forest:
            tree.grow(cells[tree.number], more)
        given.destroy()
    return forest


def find_hubs(vectors: np.ndarray, size: np.ndarray, radius: float, support: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres of dense groups in a sample: rows with ``support`` rows around them, moved to their mean."""
    free, near = np.ones(len(vectors), dtype=bool), np.cos(radius)
    count = np.zeros(len(vectors), dtype=np.int64)
    for lo in range(0, len(vectors), 1024):
        part = (vectors[lo:lo + 1024] @ vectors.T >= near) & (size[lo:lo + 1024, None] == size)
        count[lo:lo + 1024] = part.sum(axis=1)
    centres, sizes = [], []
    for i in np.argsort(-count, kind="stable").tolist():
        if count[i] < support or len(centres) == most:
            break
        if not free[i]:
            continue
        around = free & (size == size[i]) & (vectors @ vectors[i] >= near)
        if around.sum() < support:
            continue
        for _ in range(2):
            centre = vectors[around].mean(axis=0)
            centre /= np.sqrt(centre @ centre)
            around = free & (size == size[i]) & (vectors @ centre >= near)
            if not around.any():
                break
        if around.sum() >= support:
            centres.append(centre)
            sizes.append(size[i])
            free &= ~around
    return (np.array(centres) if centres else np.zeros((0, vectors.shape[1]))), np.array(sizes, dtype=np.int64)


def angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ centres.T, -1.0, 1.0))


def joined_up(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows, the first row of its component over the links (a, b)."""
    root = np.arange(n)
    while True:
        least = root.copy()
        np.minimum.at(least, a, root[b])
        np.minimum.at(least, b, root[a])
        least = least[least]
        if (least == root).all():
            return root
        root = least


def compare_leaf(vectors: np.ndarray, size: np.ndarray, seen: np.ndarray, copies: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links (with copies) that count in this leaf, and the first row of each row's component.
    ``seen`` has each row's leaves before this one, filled up with -1."""
    n, width = seen.shape
    links, from_, to = np.zeros(n, dtype=np.int64), [], []
    for lo in range(0, n, 512):
        a, b = np.nonzero((vectors[lo:lo + 512] @ vectors.T >= least) & (size[lo:lo + 512, None] == size))
        a += lo
        a, b = a[a < b], b[a < b]
        for x in range(0, len(a), 1 << 14):
            p, q = a[x:x + (1 << 14)], b[x:x + (1 << 14)]
            if width:
                met = ((seen[p][:, :, None] == seen[q][:, None, :]) & (seen[p][:, :, None] >= 0)).any(axis=(1, 2))
                p, q = p[~met], q[~met]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            from_.append(p)
            to.append(q)
    if not from_:
        return links, np.arange(n)
    return links, joined_up(n, np.concatenate(from_), np.concatenate(to))


def near_duplicates(table: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = 8,
                    leaf_rows: int = 512, spill: float = 0.025, fit_rows: int = 2048, fit_levels: int = 6, max_levels: int = 21,
                    hub_rows: int = 8192, hub_support: int = 8, block_rows: int = 2048, seed: int = 11) -> DataFrame:
    """One row per row: vec_id, n_links, component_id (smallest vec_id reachable by links), kept (vec_id = component_id)."""
    spark = prepared(table.sparkSession)
    vector = F.col(vector_col)
    usable = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"), usable.alias("usable"))
    rows = rows.withColumns({"k1": F.when(F.col("usable"), F.xxhash64(F.lit(1), "v")), "k2": F.when(F.col("usable"), F.xxhash64(F.lit(2), "v"))})
    # numbers are given once, in the table that is written
    nodes = written(rows.where("usable").groupBy("k1", "k2").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v"))
                    .withColumn("node", F.monotonically_increasing_id()))
    total = nodes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(1)).alias("width")).first()
    n, width = total["n"], total["width"]
    reach = math.acos(least)
    radius = reach / 2 - _SLACK

    # dense groups
    def hubs(table: pa.Table) -> pa.Table:
        centres, sizes = find_hubs(*unit(table.column("v"), width), radius, hub_support, hub_rows // hub_support)
        return pa.table({"centre": pa.array([c.tobytes() for c in centres], pa.binary()), "size": pa.array(sizes)})

    sample = nodes.where(F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(1 << 20)) < F.lit(min(1.0, hub_rows / max(1, n)) * (1 << 20)))
    found = sample.select("v", F.lit(0).alias("all")).groupBy("all").applyInArrow(frugal_group(hubs), "centre binary, size long").collect()
    centres = np.array([np.frombuffer(r["centre"], "<f8") for r in found]).reshape(len(found), width)
    given = spark.sparkContext.broadcast((centres, np.array([r["size"] for r in found], dtype=np.int64)))

    def placed(batches):
        centres, sizes = given.value
        for b in batches:
            vectors, size = unit(b.column("v"), width)
            if len(sizes) and len(size):
                angle = np.where(size[:, None] == sizes, angles(vectors, centres), np.inf)
                ball, at = angle.argmin(axis=1), angle.min(axis=1)
            else:
                ball, at = np.zeros(len(size), np.int64), np.full(len(size), np.inf)
            ball = np.where(at <= radius, ball, -1)
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("copies"), b.column("v"), pa.array(ball.astype(np.int32)), pa.array(at)],
                                             ["node", "copies", "v", "ball", "angle"])

    kind = nodes.schema["v"].dataType.simpleString()
    held = written(nodes.select("node", "copies", "v").mapInArrow(frugal(placed), f"node long, copies long, v {kind}, ball int, angle double"))
    balls = held.where("ball >= 0").groupBy("ball").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n"), F.sum("copies").alias("copies"), F.max("angle").alias("angle")).collect()
    stars = F.broadcast(spark.createDataFrame([(r["ball"], r["first"], r["copies"], -(-r["n"] // block_rows)) for r in balls], "ball int, first long, weight long, parts long"))
    outer = np.full(len(centres), -np.inf)  # a centre without rows is reached by none
    for r in balls:
        outer[r["ball"]] = r["angle"]
    edge = spark.sparkContext.broadcast(outer)

    def touches(batches):
        """(row, ball, whether the row links with all its rows) for the other balls that a row may link with."""
        centres, sizes = given.value
        for b in batches:
            vectors, size = unit(b.column("v"), width)
            if not len(size) or not len(sizes):
                continue
            own, angle = b.column("ball").to_numpy(), np.where(size[:, None] == sizes, angles(vectors, centres), np.inf)
            angle[np.arange(len(own))[own >= 0], own[own >= 0]] = np.inf
            row, ball = np.nonzero(angle - edge.value <= reach + _SLACK)
            whole = angle[row, ball] + edge.value[ball] <= reach - _SLACK
            yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(row)), b.column("copies").take(pa.array(row)),
                                              pa.array(own[row] < 0), pa.array(ball.astype(np.int32)), pa.array(whole)], ["node", "copies", "free", "ball", "whole"])

    near = written(held.mapInArrow(frugal(touches), "node long, copies long, free boolean, ball int, whole boolean"))
    star = lambda df: df.join(stars, "ball")  # noqa: E731  at most hub_rows / hub_support rows
    edge_to_first = lambda df: star(df).select(F.col("node").alias("a"), F.col("first").alias("b"))
    in_ball = held.where("ball >= 0")
    links = (star(in_ball).select("node", (F.col("weight") - F.col("copies")).alias("links"))
             .unionByName(star(near.where("whole")).select("node", F.col("weight").alias("links"))))
    edges = edge_to_first(in_ball).unionByName(edge_to_first(near.where("whole")))
    # rows of a ball that free rows link with as a whole
    guests = near.where("whole AND free").groupBy("ball").agg(F.sum("copies").alias("links"))
    links = links.unionByName(in_ball.select("node", "ball").join(F.broadcast(guests), "ball").select("node", "links"))  # one row for each ball

    # rows near the edge of a ball visit its rows
    ids = lambda c: F.pmod(F.xxhash64("node", F.lit(seed)), c)
    some = near.where("NOT whole").select("node", "ball", "free")
    groups = some.groupBy("ball").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("guest_parts"))
    visits = (star(some.join(held.select("node", "copies", "v"), "node")).join(F.broadcast(groups), "ball")
              .select("ball", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("i"), ids(F.col("guest_parts")).alias("j"), "node", "copies", "v", F.lit(True).alias("guest"), "free"))
    hosts = (star(in_ball).join(F.broadcast(groups), "ball")
             .select("ball", ids(F.col("parts")).alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("guest_parts") - 1)).alias("j"), "node", "copies", "v", F.lit(False).alias("guest"), F.lit(False).alias("free")))

    def visited(table: pa.Table) -> pa.Table:
        vectors, _ = unit(table.column("v"), width)
        node, copies, guest, free = (table.column(c).to_numpy() for c in ("node", "copies", "guest", "free"))
        hit = vectors[guest] @ vectors[~guest].T >= least
        links = np.zeros(len(node), dtype=np.int64)
        links[guest] = hit @ copies[~guest]
        links[~guest] = (copies[guest] * free[guest]) @ hit  # rows of balls count their own visits
        one = np.flatnonzero(links)
        return pa.table({"node": node[one], "links": links[one], "ball": table.column("ball").to_numpy()[one]})

    seen = written(visits.unionByName(hosts).groupBy("ball", "i", "j").applyInArrow(frugal_group(visited), "node long, links long, ball int"))
    links = links.unionByName(seen.select("node", "links"))
    edges = edges.unionByName(edge_to_first(seen))

    # the forest over the others
    free = held.where("ball < 0").select("node", "copies", "v")
    n_free = free.count()
    forest = spark.sparkContext.broadcast(fit_forest(free, n_free, width, trees, leaf_rows, spill, fit_rows, fit_levels, max_levels, seed))

    def indexed(batches):
        """Each row's leaves in all trees: tree << 32 | leaf, ascending."""
        for b in batches:
            if not b.num_rows:
                continue
            vectors, _ = unit(b.column("v"), width)
            found = [tree.leaves(vectors @ directions(tree.number, max_levels, width, seed)[:, :len(tree.low)]) for tree in forest.value]
            owner = np.concatenate([row for row, _ in found])
            code = np.concatenate([(np.int64(t) << 32) + leaf for t, (_, leaf) in enumerate(found)])
            order = np.argsort(owner, kind="stable")
            cut = np.searchsorted(owner[order], np.arange(len(vectors) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(cut), pa.array(code[order]))], [*b.schema.names, "leaves"])

    # written once, so that a row's leaves are the same wherever they are read
    index = written(free.mapInArrow(frugal(indexed), f"node long, copies long, v {kind}, leaves array<long>"))
    for number in range(trees if n_free > 1 else 0):
        def dealt(batches, number=number):
            for b in batches:
                codes, size = padded(b.column("leaves"), np.int64(-1))
                row, at = np.nonzero((codes >> 32 == number) & (codes >= 0))
                yield pa.RecordBatch.from_arrays([pa.array(codes[row, at]), *b.take(pa.array(row)).columns], ["leaf", *b.schema.names])

        def compared(table: pa.Table) -> pa.Table:
            table = table.sort_by("node")
            vectors, size = unit(table.column("v"), width)
            node = table.column("node").to_numpy()
            seen, _ = padded(table.column("leaves"), np.int64(-1))
            seen[seen >= table.column("leaf")[0].as_py()] = -1
            links, root = compare_leaf(vectors, size, seen, table.column("copies").to_numpy(), least)
            some = np.flatnonzero(links)
            return pa.table({"node": node[some], "links": links[some], "first": node[root[some]]})

        out = written(index.mapInArrow(frugal(dealt), f"leaf long, node long, copies long, v {kind}, leaves array<long>")
                      .groupBy("leaf").applyInArrow(frugal_group(compared), "node long, links long, first long"))
        links = links.unionByName(out.select("node", "links"))
        edges = edges.unionByName(out.select(F.col("node").alias("a"), F.col("first").alias("b")))

    roots = components(edges.where("a <> b"))
    n_links = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = (nodes.select("node", "k1", "k2", "first_id", "copies").join(roots, "node", "left").join(n_links, "node", "left")
             .select("k1", "k2", "first_id", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    named = checkpointed(named)
    classes = named.groupBy("root").agg(F.min("first_id").alias("component"))
    classes = named.join(classes, "root").select("k1", "k2", "component", "links")
    out = rows.select("vec_id", "k1", "k2").join(classes, ["k1", "k2"], "left")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


#: the exact result by DuckDB, for tables small enough to compare all vectors
ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) BETWEEN 0.95 AND 2),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS least FROM r GROUP BY x),
d AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM v LEFT JOIN c ON vec_id = c.x LEFT JOIN d ON vec_id = d.x
"""
