"""Ranked lexical search by a dual-tree traversal.

The items are a query set against all documents, taken in blocks of at most
``block_chars`` characters. For a block:

1. One scan gives every document's number of terms and its counts of the
   block's terms (numbers of a sorted vocabulary); from it N, L and df follow.
2. Each task packs its documents into a hierarchy: documents with the same heaviest
   term share a leaf, ``fan`` nodes share a parent. A node holds the coordinate maxima of what
   its documents score for each term. The items' hierarchy is made likewise:
   items with common terms share a node, whose coordinate maxima are 1 for the
   terms of any of its items. The product of a node pair's maxima bounds the
   score of all its item-document pairs. A pair goes down only if the bound
   reaches the weakest kth score among its items; else the whole batch is left.
   Scores are non-negative integers below 2**53, so bounds and sums are exact,
   and equal scores are never pruned.
3. A bounded sample of documents (``sample_rows``, by hash) is searched first. Its
   kth scores are lower bounds for all documents, with which every task starts.
   The sample changes cost only, never results.
4. A task passes on at most ``k`` documents per item; Spark ranks them.

Defined results: null and empty texts have no terms and score 0; terms and items
without a match give no rows; equal scores are ordered by doc_id, null doc_id
last; rows that repeat a doc_id or an item_id are rows of their own; texts are
read whole; further columns are ignored; an empty table gives an empty result.
Terms are compared by 64-bit hash and length; the terms of one block of items
are checked to have different hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import _LOWER, byte_values, documents, frugal, slices, span_hashes, written

_TERM = np.ones(256, dtype=bool)
_TERM[:0x80] = False
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_NONE = np.iinfo(np.int64).max


def terms(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts together: lower-cased bytes, start, end and hash of each term, and each text's first term (one more at the end)."""
    raw = [t.encode("utf-8") if t else b"" for t in texts]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    buf = _LOWER[np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], _TERM[buf], [False]]).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    hashes = span_hashes(byte_values(buf), starts, ends) ^ (ends - starts).astype(np.uint64)
    return buf, starts, ends, hashes, np.searchsorted(starts, offsets)


class Block:
    """A block of items: sorted vocabulary and each item's term numbers."""

    def __init__(self, rows: list[tuple]):
        buf, starts, ends, hashes, cut = terms([r[1] for r in rows])
        self.vocabulary, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        raw = buf.tobytes()
        if len({raw[starts[i]:ends[i]] for i in range(len(starts))}) != len(first):
            raise ValueError("two terms of the items have one hash")
        self.ids = [r[0] for r in rows]
        self.items = [np.unique(at[a:b]) for a, b in zip(cut[:-1], cut[1:])]


def blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[Block]:
    """The items in blocks of at most ``block_chars`` characters (or one longer item)."""
    held: list[tuple] = []
    size = 0
    for r in items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        n = len(r[1] or "")
        if held and size + n > block_chars:
            yield Block(held)
            held, size = [], 0
        held.append((r[0], r[1]))
        size += n
    if held:
        yield Block(held)


def profiles(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n (number of terms), and of the vocabulary's terms their numbers and counts (int32)."""
    def counted(batches):
        known = vocabulary.value
        for b in batches:
            texts = b.column("text").to_pylist()
            ids = b.column("doc_id")
            for lo, hi in slices(texts):
                _, _, _, hashes, cut = terms(texts[lo:hi])
                doc = np.repeat(np.arange(hi - lo), np.diff(cut))
                at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
                hit = known[at] == hashes if len(known) else np.zeros(0, dtype=bool)
                pairs, tf = np.unique(doc[hit] * np.int64(len(known) or 1) + at[hit], return_counts=True)
                term, of = (pairs % (len(known) or 1)).astype("<i4"), pairs // (len(known) or 1)
                edge = np.searchsorted(of, np.arange(hi - lo + 1))
                tf = tf.astype("<i4")
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(np.diff(cut).astype(np.int64)),
                     pa.array([term[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:])], pa.binary()),
                     pa.array([tf[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:])], pa.binary())], ["doc_id", "n", "terms", "tf"])

    return written(docs.mapInArrow(frugal(counted), "doc_id long, n long, terms binary, tf binary"))


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """df of each term of the vocabulary."""
    def counted(batches):
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    out = np.zeros(size, dtype=np.int64)
    rows = found.select("terms").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toPandas()
    out[rows["term"].to_numpy(dtype=np.int64)] = rows["df"].to_numpy(dtype=np.int64)
    return out


def item_order(items: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """Items in an order that puts those with common heavy terms side by side."""
    heavy = [tuple(t[np.argsort(-weights[t], kind="stable")[:3]].tolist()) for t in items]
    return np.array(sorted(range(len(items)), key=lambda i: heavy[i]), dtype=np.int64)


class Search:
    """One task's search: items' hierarchy, kth scores so far, and the best documents."""

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, floors: np.ndarray, k: int, n_docs: int, n_terms: int,
                 leaf: int = 16, fan: int = 8):
        self.weights, self.k, self.leaf, self.fan = weights, k, leaf, fan
        self.n_docs, self.n_terms, self.items = n_docs, n_terms, items
        self.kth = floors.astype(np.int64).copy()  # a score of 0 never counts, so floors are 1 at least
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        self.levels = [[np.array([i]) for i in item_order(items, weights)]]  # levels of nodes: lists of items
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append([np.concatenate(low[i:i + fan]) for i in range(0, len(low), fan)])
        self.maxima = [[np.unique(np.concatenate([items[i] for i in node])) for node in level] for level in self.levels]

    def scores(self, n: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Score of each (document, term) entry. ``n`` by document, ``row`` its number."""
        m = 50 + 50 * n * self.n_docs // max(1, self.n_terms)
        return self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[row]))

    def add(self, ids: np.ndarray, n: np.ndarray, row: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Searches a batch of documents: their ids and lengths, and entries (row, term, tf)."""
        if not len(term) or not self.items:
            return
        value = self.scores(n, row, term, tf)
        # documents with the same heaviest term stand side by side, of these the ones of like length
        heaviest = np.full(len(ids), -1, dtype=np.int64)
        rise = np.argsort(value, kind="stable")
        heaviest[row[rise]] = term[rise]
        order = np.lexsort((n, heaviest))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        ids, row = ids[order], place[row]
        used, term = np.unique(term, return_inverse=True)
        pads = -(-len(ids) // self.leaf)
        dense = np.zeros((pads * self.leaf, len(used)), dtype=np.float64)
        dense[row, term] = value
        tree = [dense.reshape(pads, self.leaf, -1).max(axis=1)]  # coordinate maxima, from the leaves up
        while len(tree[-1]) > 1:
            low = tree[-1]
            up = -(-len(low) // self.fan)
            tree.append(np.concatenate([low, np.zeros((up * self.fan - len(low), len(used)))]).reshape(up, self.fan, -1).max(axis=1))
        column = np.full(len(self.weights), -1)
        column[used] = np.arange(len(used))
        at = [[c[c >= 0] for c in (column[t] for t in level)] for level in self.maxima]
        top = len(self.levels) - 1
        for q in range(len(self.levels[top])):
            self._down(top, q, len(tree) - 1, np.arange(len(tree[-1])), tree, at, dense, ids)

    def _down(self, level: int, node: int, depth: int, docs: np.ndarray, tree, at, dense, ids) -> None:
        """An item node against document nodes of one depth: drops those whose bound stays below the weakest kth score."""
        if not len(at[level][node]):
            return
        weakest = self.kth[self.levels[level][node]].min()
        docs = docs[tree[depth][np.ix_(docs, at[level][node])].sum(axis=1) >= weakest]
        if not len(docs):
            return
        if level == 0 and depth == 0:
            self._score(int(self.levels[0][node][0]), docs, at[0][node], dense, ids)
            return
        if depth:
            docs = (docs[:, None] * self.fan + np.arange(self.fan)).reshape(-1)
            docs, depth = docs[docs < len(tree[depth - 1])], depth - 1
        if level == 0:
            self._down(0, node, depth, docs, tree, at, dense, ids)
            return
        for child in range(node * self.fan, min((node + 1) * self.fan, len(self.levels[level - 1]))):
            self._down(level - 1, child, depth, docs, tree, at, dense, ids)

    def _score(self, item: int, leaves: np.ndarray, columns: np.ndarray, dense, ids) -> None:
        rows = (leaves[:, None] * self.leaf + np.arange(self.leaf)).reshape(-1)
        rows = rows[rows < len(ids)]
        score = dense[np.ix_(rows, columns)].sum(axis=1).astype(np.int64)
        keep = score >= self.kth[item]
        if not keep.any():
            return
        held, by = self.best[item]
        held, by = np.concatenate([held, ids[rows[keep]]]), np.concatenate([by, score[keep]])
        first = np.lexsort((held, -by))[:self.k]
        self.best[item] = (held[first], by[first])
        if len(first) == self.k:
            self.kth[item] = max(self.kth[item], by[first[-1]])


def _search(found: DataFrame, block, weights: np.ndarray, floors: np.ndarray, n_docs: int, n_terms: int, k: int, batch_rows: int) -> DataFrame:
    """item (number in the block), doc_id, score: the best ``k`` of each task at or above the floors."""
    given = found.sparkSession.sparkContext.broadcast((weights, floors))

    def run(batches):
        search = Search(block.value.items, *given.value, k, n_docs, n_terms)
        held: list = []

        def flush():
            ids = np.concatenate([h[0] for h in held])
            n = np.concatenate([h[1] for h in held])
            each = np.concatenate([h[2] for h in held])
            term, tf = (np.frombuffer(b"".join(x for h in held for x in h[i]), "<i4").astype(np.int64) for i in (3, 4))
            search.add(ids, n, np.repeat(np.arange(len(ids)), each), term, tf)
            held.clear()

        for b in batches:
            packed = b.column("terms").to_pylist()
            if packed:
                ids = b.column("doc_id").fill_null(_NONE).to_numpy(zero_copy_only=False)
                held.append((ids, b.column("n").to_numpy(), np.array([len(x) // 4 for x in packed]), packed, b.column("tf").to_pylist()))
            if sum(len(h[0]) for h in held) >= batch_rows:
                flush()
        if held:
            flush()
        for i, (ids, score) in enumerate(search.best):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i)), pa.array(ids, mask=ids == _NONE), pa.array(score)], ["item", "doc_id", "score"])

    return found.mapInArrow(frugal(run), "item long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_chars: int = 1 << 17,
                  sample_rows: int = 20_000, batch_cells: int = 1 << 22) -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``k`` best documents. ``block_chars`` bounds what a block
    broadcasts, ``batch_cells`` the matrix of a batch of documents (8 bytes a cell)."""
    d = documents(docs, id_col, text_col)
    spark, out = d.sparkSession, None
    for number, items_of in enumerate(blocks(items, item_col, item_text_col, block_chars)):
        size = len(items_of.vocabulary)
        batch_rows = max(16, batch_cells // max(1, size))
        block = spark.sparkContext.broadcast(items_of)
        found = profiles(d, spark.sparkContext.broadcast(items_of.vocabulary))
        total = found.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        n_docs, n_terms = total["docs"], total["terms"]
        df = document_frequencies(found, size)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)
        full = found.where("octet_length(terms) > 0")
        floors = np.ones(len(items_of.items), dtype=np.int64)
        share = F.pmod(F.xxhash64("doc_id", "n", "terms"), F.lit(1 << 20)) < F.lit(min(1.0, sample_rows / max(1, n_docs)) * (1 << 20))
        kth = (_search(full.where(share), block, weights, floors, n_docs, n_terms, k, batch_rows)
               .withColumn("place", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"))))
               .where(F.col("place") <= k).where(F.col("place") == k).select("item", "score"))
        for r in kth.toLocalIterator():
            floors[r["item"]] = max(1, r["score"])
        best = _search(full, block, weights, floors, n_docs, n_terms, k, batch_rows)
        names = spark.createDataFrame(list(enumerate(items_of.ids)), "item long, item_id long")
        ranked = (best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())))
                  .where(F.col("rank") <= k).join(F.broadcast(names), "item")  # one row for each item of the block
                  .select("item_id", "rank", "doc_id", "score"))
        out = ranked if out is None else out.unionByName(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")


_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
#: the same by DuckDB
ORACLE = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM d),
i AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS term FROM benchmark),
e AS (SELECT doc_id, unnest(ts) AS term, len(ts) AS n FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM e WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
g AS (SELECT doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))) AS g FROM tf JOIN w ON tf.term = w.term, s),
t AS (SELECT item_id, doc_id, CAST(sum(g) AS BIGINT) AS score FROM i JOIN g ON i.term = g.term GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM t WHERE score > 0)
SELECT * FROM r WHERE rank <= 50
"""
