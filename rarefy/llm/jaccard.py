"""Jaccard join on word n-grams: a blocked sparse matrix product.

The rows of a sparse 0/1 matrix are the documents' sets of n-grams. The
product of the matrix with its transpose holds the overlaps; a pair links
when den * overlap >= num * union.

1. Equal sets are one row: copies are counted, not compared.
2. Blocking. If a and b link, a misses at most |a| - ceil(num * |a| / den) of
   its n-grams in b. N-grams have one order for all sets, and of the first
   p(|a|) n-grams of a, with p = |a| - ceil(num * |a| / den) + need(|a|), and
   those of b, at least need = min(need(|a|), need(|b|)) are the same, where
   need(s) is a twentieth of s. Any order is right; common n-grams come last,
   which a bounded sample of documents tells, and then hashes decide.
   A row whose prefix shares fewer n-grams with any others than a link takes
   has no link and is left out before pairs are formed: most pairs that texts
   share by chance, which grow with the square of the rows, never come up.
   Rows whose first three n-grams are the same (near copies, for the order is
   theirs too) are one block without counting, by an edge from each to its first
   row. All other pairs are counted over the prefixes, in buckets of n-grams:
   * an n-gram of at most ``cold`` rows gives its pairs, and a pair is a
     candidate where its count can still reach the need and the sizes allow a link;
   * an n-gram of more rows gives no pairs, only an edge from each row to its
     first row. A row with fewer such n-grams than the need must share
     another one with any partner, so it can do without these edges. Rows
     with more of them (crowded rows) are counted again among themselves with
     a higher limit, and those still crowded keep their edges. Nothing is
     lost, and a group of many alike rows costs as many edges as rows.
   Before the shuffle a task passes on at most ``cold`` + 1 rows of an n-gram.
   Blocks are the components of candidates and edges; no linked pair is
   separated.
3. Product. Each block is multiplied in one task: overlaps are accumulated
   n-gram by n-gram, pairs below their bound are discarded, and what leaves
   the task is one row per document (its smallest linked-up document in the
   block and its number of links), never the pairs. A block of more than
   ``block_rows`` rows is cut into parts, and each pair of parts is a task.
4. Components over those rows give the classes.

Defined results: documents without text or words have an empty set, link
with nothing and are their own component; with fewer words than n the whole
sequence is the one element; rows that repeat a doc_id with an equal text
are copies; a null doc_id takes part and is named by the smallest doc_id of
its component (null where there is none); texts are read whole; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import (byte_values, checkpointed, documents, frugal, frugal_group, joined,
                     slices, span_hashes, window_hashes, word_spans, written)
from .graph import components


def shingle_sets(texts, n: int) -> Iterator[np.ndarray]:
    """For each text, the sorted hashes of its distinct word n-grams (A-Z lower-cased)."""
    for lo, hi in slices(texts):
        buf, offsets = joined(texts[lo:hi], lower=True)
        starts, ends = word_spans(buf)
        words = span_hashes(byte_values(buf), starts, ends)
        grams = window_hashes(words, n)
        cut = np.searchsorted(starts, offsets)
        for i in range(hi - lo):
            a, b = int(cut[i]), int(cut[i + 1])
            if b - a >= n:
                yield np.unique(grams[a:b - n + 1])
            elif b > a:
                yield span_hashes(words, np.array([a]), np.array([b]))
            else:
                yield np.zeros(0, dtype=np.uint64)


def need(size: int) -> int:
    """N-grams that the prefixes of two linked sets share at least, by the size of one."""
    return size // 20 + 2 if size >= 10 else 1


def prefix(grams: np.ndarray, common: np.ndarray, num: int, den: int) -> np.ndarray:
    """The first n-grams of a set, as many as blocking takes. ``common`` is sorted."""
    size = len(grams)
    if not size:
        return grams
    late = np.zeros(size, dtype=bool)
    if len(common):
        late = common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] == grams
    return np.concatenate([grams[~late], grams[late]])[:size - -(-num * size // den) + need(size)]


def common_grams(docs: DataFrame, n: int, sample_rows: int) -> np.ndarray:
    """N-grams that two documents or more of a sample have, sorted. The sample takes about
    ``sample_rows`` documents by hash, which bounds the list; it only orders n-grams."""
    total = docs.count()
    share = F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(1 << 20)) < F.lit(min(1.0, sample_rows / max(1, total)) * (1 << 20))

    def run(batches):
        for b in batches:
            sets = list(shingle_sets(b.column("text").to_pylist(), n))
            if sets:
                grams, count = np.unique(np.concatenate(sets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(count.astype(np.int64))], ["gram", "n"])

    found = (docs.where(share).select("text").distinct().mapInArrow(frugal(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
             .where("n > 1").select("gram").toPandas())
    return np.sort(found["gram"].to_numpy(dtype=np.int64).view(np.uint64))


#: first n-grams of the order that make a row's label
_LABEL = 3
#: pairs that a task holds before it counts them
_PAIRS = 250_000


def counted(tokens: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, labels: np.ndarray, cold: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b, n) over the n-grams of 2 to ``cold`` rows whose sizes
    allow a link (a pair may come more than once) and whose labels differ, and edges (row, first row of the
    n-gram) over those of more, one for each n-gram."""
    order = np.lexsort((nodes, tokens))
    tokens, nodes, sizes, labels = tokens[order], nodes[order], sizes[order].astype(np.int64), labels[order]
    del order
    start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
    df = np.diff(np.append(start, len(tokens)))
    found, held, size = [], [], 0
    for d in np.unique(df[(df > 1) & (df <= cold)]).tolist():
        i, j = np.triu_indices(d, 1)
        at = start[df == d]
        step = max(1, _PAIRS // 2 // len(i))
        for lo in range(0, len(at), step):
            rows = at[lo:lo + step][:, None] + np.arange(d)
            a, b = rows[:, i].reshape(-1), rows[:, j].reshape(-1)
            ok = (den * np.minimum(sizes[a], sizes[b]) >= num * np.maximum(sizes[a], sizes[b])) & (labels[a] != labels[b])
            held.append(np.stack([nodes[a[ok]], nodes[b[ok]]], axis=1))
            size += len(held[-1])
            if size > _PAIRS:
                found.append(_tally(np.concatenate(held)))
                held, size = [], 0
    found.append(_tally(np.concatenate(held)) if held else np.zeros((0, 3), np.int64))
    hot = df > cold
    at = np.repeat(np.arange(len(df)), df)
    keep = hot[at]
    edges = np.stack([nodes[keep], nodes[start[at[keep]]]], axis=1) if keep.any() else np.zeros((0, 2), np.int64)
    return np.concatenate(found), edges


def _values(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    """The numbers of all rows of a binary column, one after the other; of one chunk without a copy."""
    parts = []
    for chunk in column.chunks:
        if len(chunk):
            _, offsets, data = chunk.buffers()
            ends = np.frombuffer(offsets, np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
            parts.append(np.frombuffer(data, kind, (ends[-1] - ends[0]) // np.dtype(kind).itemsize, ends[0]) if ends[-1] > ends[0] else np.zeros(0, kind))
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, kind)


def _tally(pairs: np.ndarray) -> np.ndarray:
    """Distinct pairs with their number."""
    if not len(pairs):
        return np.zeros((0, 3), dtype=np.int64)
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    pairs = pairs[order]
    edge = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]).any(axis=1)]))
    return np.column_stack([pairs[edge], np.diff(np.append(edge, len(pairs)))])


def trimmed(tokens: np.ndarray, nodes: np.ndarray, sizes: np.ndarray, labels: np.ndarray, cold: int) -> tuple[np.ndarray, ...]:
    """What a task passes on (n-grams, rows, sizes, labels): at most ``cold`` + 1 rows of each n-gram, and for the others
    edges (row, first row) to the first one passed on, one for each n-gram."""
    order = np.lexsort((nodes, tokens))
    tokens, nodes, sizes, labels = tokens[order], nodes[order], sizes[order], labels[order]
    start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    first = np.repeat(start, np.diff(np.append(start, len(tokens))))
    beyond = np.arange(len(tokens)) - first > cold
    return tokens[~beyond], nodes[~beyond], sizes[~beyond], labels[~beyond], np.stack([nodes[beyond], nodes[first[beyond]]], axis=1)


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Matrix of overlap sizes: the product of the incidence matrix with its transpose.
    Columns with many rows are multiplied as dense slabs, the others pair by pair."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.int32)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(column, kind="stable")
    rows, df_of = rows[order], df[column[order]]
    starts = np.concatenate([[0], np.cumsum(df)])[:-1]
    common = max(16, n // 16)
    for d in np.unique(df[(df > 1) & (df <= common)]).tolist():
        at = rows[(starts[df == d][:, None] + np.arange(d)).reshape(-1)].reshape(-1, d)
        for i in range(d):
            for j in range(i + 1, d) if d <= 4 else [slice(i + 1, d)]:
                pair = (at[:, i][:, None] * n + at[:, j].reshape(len(at), -1)).reshape(-1)
                if len(pair) * 8 > n * n:
                    out += np.bincount(pair, minlength=n * n).reshape(n, n).astype(np.int32)
                else:
                    np.add.at(out.reshape(-1), pair, 1)
    wide = np.flatnonzero(df > common)
    for lo in range(0, len(wide), 1024):
        slab = np.zeros((n, min(1024, len(wide) - lo)), dtype=np.float32)
        for k, c in enumerate(wide[lo:lo + 1024].tolist()):
            slab[rows[starts[c]:starts[c] + df[c]], k] = 1
        out += np.triu(slab @ slab.T, 1).astype(np.int32)
    return out


def linked(sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
    """Symmetric boolean matrix of the links between the rows of a block."""
    n = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        hit = both * (den + num) >= num * int(size.sum())
        return np.array([[False, hit], [hit, False]])
    hit = np.triu(overlaps(sets).astype(np.int64) * (den + num) >= num * (size[:, None] + size[None, :]), 1)
    return hit | hit.T


def smallest_reachable(link: np.ndarray) -> np.ndarray:
    """For each row, the first row of its component."""
    root = np.full(len(link), -1)
    for i in range(len(link)):
        if root[i] < 0:
            root[i] = i
            front = np.array([i])
            while len(front):
                front = np.flatnonzero(link[front].any(axis=0) & (root < 0))
                root[front] = i
    return root


def _tallies(nodes: DataFrame, num: int, den: int, cold: int, buckets: int, bucket_grams: int, named: bool) -> DataFrame:
    """Counts of pairs and edges (see counted) over the prefixes of all rows: hot, a, b, n.
    Unless ``named``, only the number of a row's edges is told, with b = a."""
    def edge_tally(edges):
        return _tally(edges if named else edges[:, [0, 0]])

    def packed(batches):
        """Rows of (bucket, n-grams, rows that have them, their sizes and labels); edges go under negative buckets."""
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def done():
            tokens, own, sizes, labels, edges = trimmed(*(np.concatenate(x) for x in zip(*held)), cold)
            edges = edge_tally(edges)
            # prefixes hold the smallest hashes, so buckets go by the low half, which is even
            to = (tokens & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(to, kind="stable")
            to, tokens, own, sizes, labels = to[order], tokens[order], own[order], sizes[order], labels[order]
            cut = np.searchsorted(to, np.arange(buckets + 1, dtype=np.uint64))
            out = [(i, tokens[x:y].tobytes(), own[x:y].tobytes(), sizes[x:y].astype("<i4").tobytes(), labels[x:y].tobytes()) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
            if len(edges):
                out.append((-1 - int(own[0] % buckets), b"", edges.tobytes(), b"", b""))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), *[pa.binary()] * 4))],
                                              ["bucket", "grams", "nodes", "sizes", "labels"])

        for b in batches:
            keys = [np.frombuffer(k, "<u8") for k in b.column("keys").to_pylist()]
            if keys:
                each = [len(k) for k in keys]
                held.append((np.concatenate(keys), *(np.repeat(b.column(c).to_numpy(), each) for c in ("node", "size", "label"))))
            if 4 * sum(len(x[0]) for x in held) > bucket_grams:
                yield done()
        if held:
            yield done()

    def tallied(table: pa.Table) -> pa.Table:
        own = _values(table.column("nodes"), "<i8")
        if table.column("bucket")[0].as_py() < 0:
            pairs, edges = np.zeros((0, 3), np.int64), own.reshape(-1, 3)
        else:
            pairs, edges = counted(_values(table.column("grams"), "<u8"), own, _values(table.column("sizes"), "<i4"),
                                   _values(table.column("labels"), "<i8"), cold, num, den)
            edges = edge_tally(edges)
        both = np.concatenate([pairs, edges])
        return pa.table({"hot": np.repeat([False, True], [len(pairs), len(edges)]), "a": both[:, 0], "b": both[:, 1], "n": both[:, 2]})

    return written(nodes.select("node", "size", "keys", "label").mapInArrow(frugal(packed), "bucket int, grams binary, nodes binary, sizes binary, labels binary")
                   .groupBy("bucket").applyInArrow(frugal_group(tallied), "hot boolean, a long, b long, n long"))


def _supported(nodes: DataFrame, buckets: int, bucket_grams: int) -> DataFrame:
    """node, n: the n-grams of a row's prefix that another prefix has, too (rows without any are left out).
    A task tells the n-grams that it has more than once itself, and passes them on without their rows."""
    def packed(batches):
        """Rows of (bucket, n-grams of one row, those rows, n-grams of more); counts of rows go under negative buckets."""
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def done():
            tokens, own = (np.concatenate(x) for x in zip(*held))
            held.clear()
            if not len(tokens):
                return []
            order = np.argsort(tokens, kind="stable")
            tokens, own = tokens[order], own[order]
            start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
            df = np.diff(np.append(start, len(tokens)))
            lone = np.repeat(df == 1, df)
            rows, n = np.unique(own[~lone], return_counts=True)
            own, more, tokens = own[lone], tokens[start[df > 1]], tokens[lone]
            # prefixes hold the smallest hashes, so buckets go by the low half, which is even
            cuts = []
            for x in (tokens, more):
                to = (x & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)
                order = np.argsort(to, kind="stable")
                cuts.append((order, np.searchsorted(to[order], np.arange(buckets + 1, dtype=np.uint64))))
            (a, at), (b, bt) = cuts
            tokens, own, more = tokens[a], own[a], more[b]
            out = [(i, tokens[at[i]:at[i + 1]].tobytes(), own[at[i]:at[i + 1]].tobytes(), more[bt[i]:bt[i + 1]].tobytes())
                   for i in range(buckets) if at[i + 1] > at[i] or bt[i + 1] > bt[i]]
            if len(rows):
                out.append((-1 - int(rows[0] % buckets), b"", rows.tobytes(), n.astype("<i8").tobytes()))
            return [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), *[pa.binary()] * 3))], ["bucket", "grams", "nodes", "more"])]

        for b in batches:
            keys = [np.frombuffer(k, "<u8") for k in b.column("keys").to_pylist()]
            if keys:
                held.append((np.concatenate(keys), np.repeat(b.column("node").to_numpy(), [len(k) for k in keys])))
            if 4 * sum(len(x[0]) for x in held) > bucket_grams:
                yield from done()
        if held:
            yield from done()

    def told(table: pa.Table) -> pa.Table:
        own = _values(table.column("nodes"), "<i8")
        if table.column("bucket")[0].as_py() < 0:
            return pa.table({"node": own, "n": _values(table.column("more"), "<i8")})
        tokens, more = _values(table.column("grams"), "<u8"), np.unique(_values(table.column("more"), "<u8"))
        order = np.argsort(tokens, kind="stable")
        tokens, own = tokens[order], own[order]
        same = tokens[1:] == tokens[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(tokens) else np.zeros(0, bool)
        if len(more):
            shared |= more[np.minimum(np.searchsorted(more, tokens), len(more) - 1)] == tokens
        rows, n = np.unique(own[shared], return_counts=True)
        return pa.table({"node": rows, "n": n.astype(np.int64)})

    return (nodes.select("node", "keys").mapInArrow(frugal(packed), "bucket int, grams binary, nodes binary, more binary")
            .groupBy("bucket").applyInArrow(frugal_group(told), "node long, n long").groupBy("node").agg(F.sum("n").alias("n")))


def _blocking(nodes: DataFrame, num: int, den: int, cold: int, bucket_grams: int) -> DataFrame:
    """Pairs (a, b) whose components hold every linked pair.

    Rows that are crowded (many n-grams of more than ``cold`` rows) are counted among
    themselves again with a limit sixteen times as high; only those that are crowded
    then, too, keep their edges. A task's own first row of an n-gram (see trimmed) stands
    between them and the first row of all, so the rows that kept edges lead to keep theirs."""
    least = lambda size: F.when(size >= 10, F.floor(size / 20) + 2).otherwise(F.lit(1))  # noqa: E731  as need()
    grams = F.least(F.col("size"), F.col("size") - F.ceil(F.col("size") * num / den) + least(F.col("size")))  # as prefix()
    # a linked row is at least num / den of the other one's size, and their prefixes share the need of the smaller one
    total = nodes.agg(F.sum(grams)).first()[0] or 0
    shared = _supported(nodes, max(1, -(-total // bucket_grams)), bucket_grams)
    nodes = written(nodes.join(shared, "node").where(F.col("n") >= least(F.ceil(F.col("size") * num / den))).drop("n"))
    # rows with the same first n-grams, most of all near copies, are joined by one edge each, and their pairs aren't counted
    nodes = nodes.withColumn("label", F.when(F.octet_length("keys") >= 8 * _LABEL, F.xxhash64(F.substring("keys", 1, 8 * _LABEL))).otherwise(F.col("node")))
    alike = nodes.groupBy("label").agg(F.min("node").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1").select("label", "b")
    alike = nodes.select("label", F.col("node").alias("a")).join(alike, "label").where("a <> b").select("a", "b")
    links, total = None, nodes.agg(F.sum(grams)).first()[0] or 0
    for limit in (cold, 16 * cold):
        # As few buckets as fit a task, for a pair is passed on once for each bucket that it shares
        # n-grams in. N-grams of up to ``limit`` rows give limit / 2 pairs for each of their entries.
        each = bucket_grams * cold // limit
        tally = _tallies(nodes, num, den, limit, max(1, -(-total // each)), bucket_grams, named=limit > cold)
        hot = tally.where("hot").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("hot_grams"))
        meta = written(nodes.select("node", "size").join(hot, "node", "left").select(
            "node", grams.alias("grams"), least(F.col("size")).alias("need"), F.coalesce("hot_grams", F.lit(0)).alias("hot_grams"),
            (F.coalesce("hot_grams", F.lit(0)) >= least(F.ceil(F.col("size") * num / den))).alias("crowded")))
        side = lambda x, meta=meta: meta.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("need", "hot_grams", "crowded")])
        pairs = (tally.where("NOT hot").groupBy("a", "b").agg(F.sum("n").alias("n")).join(side("a"), "a").join(side("b"), "b")
                 .where("n + least(hot_grams_a, hot_grams_b) >= least(need_a, need_b)"))
        if limit == cold:
            pairs = pairs.where("NOT (crowded_a AND crowded_b)")
        links = pairs.select("a", "b") if links is None else links.unionByName(pairs.select("a", "b"))
        crowded = meta.where("crowded").select("node")
        total = meta.where("crowded").agg(F.sum("grams")).first()[0] or 0
        nodes = nodes.join(crowded, "node")
    edges = tally.where("hot AND a <> b").select("a", "b")
    firsts = edges.join(crowded.withColumnRenamed("node", "a"), "a", "left_semi").select(F.col("b").alias("a"))
    return links.unionByName(alike).unionByName(edges.join(crowded.withColumnRenamed("node", "a").unionByName(firsts), "a", "left_semi"))


def row_hash(doc_id, text):
    """What tells rows of one doc_id and different texts apart."""
    return F.xxhash64(doc_id.cast("long"), text.cast("string"))


def jaccard_join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                 text_col: str = "text", block_rows: int = 1500, cold: int = 4,
                 bucket_grams: int = 2_500_000, sample_rows: int = 8000, keep_row: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by
    links, itself included), n_links (documents it links with, copies included), with
    ``keep_row`` also row (see row_hash)."""
    d = documents(docs, id_col, text_col).withColumn("row", row_hash(F.col("doc_id"), F.col("text")))

    shared = d.sparkSession.sparkContext.broadcast(common_grams(d, n, sample_rows))

    def described(batches):
        import xxhash
        for b in batches:
            sizes, nodes, keys = [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), n):
                sizes.append(len(s))
                nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                keys.append(prefix(s, shared.value, num, den).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                                              pa.array(keys, pa.binary())], ["doc_id", "row", "size", "node", "keys"])

    rows = written(d.mapInArrow(frugal(described), "doc_id long, row long, size long, node long, keys binary"))
    # equal sets are one row of the matrix; its text is read from one of its documents
    nodes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.any_value("size").alias("size"), F.any_value("keys").alias("keys"))

    links = _blocking(nodes.select("node", "size", "keys"), num, den, cold, bucket_grams)
    blocks = checkpointed(components(links))

    count = blocks.groupBy("root").agg(F.count(F.lit(1)).alias("n")).withColumn("parts", F.ceil(F.col("n") / block_rows))
    total = count.where("parts = 1").agg(F.sum("n")).first()[0] or 0
    packs = max(1, -(-total // block_rows))
    # blocks of one task are packed together; the parts of a large block meet in pairs
    own = F.pmod(F.xxhash64("node"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    placed = (blocks.join(count, "root").select("node", "root", "parts", own.alias("i"), other.alias("j"))
              .where("parts = 1 OR i <> j")
              .select("node", "root", F.when(F.col("parts") == 1, F.lit(-1)).otherwise(F.least("i", "j")).alias("i"),
                      F.when(F.col("parts") == 1, F.pmod(F.xxhash64("root"), F.lit(packs))).otherwise(F.greatest("i", "j")).alias("j"), "parts",
                      own.alias("part"))
              .withColumn("task", F.when(F.col("i") == -1, F.concat_ws(":", F.lit("p"), "j")).otherwise(F.concat_ws(":", "root", "i", "j"))))
    member = nodes.select("node", "row", "copies").join(blocks.select("node"), "node")

    def sets(batches):
        for b in batches:
            found = [s.tobytes() for s in shingle_sets(b.column("text").to_pylist(), n)]
            yield pa.RecordBatch.from_arrays([b.column("node"), b.column("copies"), pa.array(found, pa.binary())], ["node", "copies", "grams"])

    loaded = (d.join(member, "row").dropDuplicates(["node"]).select("node", "copies", "text")
              .mapInArrow(frugal(sets), "node long, copies long, grams binary"))

    def multiplied(table: pa.Table) -> pa.Table:
        table = table.sort_by([("root", "ascending"), ("node", "ascending")])
        root, node = table.column("root").to_numpy(), table.column("node").to_numpy()
        copies, part, parts = (table.column(c).to_numpy() for c in ("copies", "part", "parts"))
        low, high = table.column("i").to_numpy(), table.column("j").to_numpy()
        grams = table.column("grams")
        first, links = np.empty(len(node), dtype=np.int64), np.zeros(len(node), dtype=np.int64)
        edges = np.flatnonzero(np.concatenate([[True], root[1:] != root[:-1], [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            link = linked([np.frombuffer(grams[k].as_py(), "<u8") for k in range(a, b)], num, den)
            first[a:b] = node[a + smallest_reachable(link)]
            if parts[a] > 1:
                # pairs within one part meet in every task of the part: only the task with the
                # next part (in a ring) counts them
                p, i, j = part[a:b], int(low[a]), int(high[a])
                ring = i if j == i + 1 else j
                same = p[:, None] == p[None, :]
                if parts[a] == 2:
                    counted = np.ones_like(same)
                else:
                    counted = ~same | (same & (p[:, None] == ring) & (j == i + 1 or (i == 0 and j == parts[a] - 1)))
                link = link & counted
            links[a:b] = link @ copies[a:b]
        return pa.table({"node": node, "first": first, "links": links})

    products = written(placed.join(loaded, "node").groupBy("task").applyInArrow(frugal_group(multiplied), "node long, first long, links long"))
    joined_up = components(products.where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")))
    links = products.groupBy("node").agg(F.sum("links").alias("links"))
    classes = (nodes.select("node", "first_id", "copies").join(joined_up, "node", "left").join(links, "node", "left")
               .select("node", "first_id", F.coalesce("root", "node").alias("root"),
                       (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    named = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = classes.join(named, "root").select("node", "component_id", "n_links")
    return (rows.select("doc_id", "row", "size", "node").join(found, "node", "left")
            .select("doc_id", *["row"] * keep_row, F.col("size").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
