"""Blocking for repeated windows: contexts around content-defined anchors.

Both substring operators look for windows of ``width`` symbols (bytes or
words) that occur elsewhere. Of the runs of ``k`` symbols in a window, the
one with the least hash (the first of equals) is its anchor. Equal windows
have equal anchors at the same place in the window, and neighbouring
windows mostly share theirs, so a document falls into contexts: all the
windows of one anchor, and the symbols they cover (under 2 * width).

Equal windows lie in contexts with an equal anchor hash. So contexts are
grouped by that hash, equal contexts of a group become one (with a count
and the smallest document), and only groups with a second occurrence go on
to an index, which is built for a shard of whole groups in one task. A
group of more than ``max_group`` different contexts is cut further, to
single windows whose digests are counted; so no task ever holds a group of
unbounded size, and nothing is left out.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import byte_values, frugal, joined, slices, span_hashes, window_hashes, word_spans, written

LAST_ID = (1 << 63) - 1
_KEYS = (("anchor", pa.int64()), ("c0", pa.int64()), ("c1", pa.int64()))
_RUNS = "anchor long, c0 long, c1 long, lo int, windows int, n long, first_id long"


@dataclass(frozen=True)
class Symbols:
    """What a window counts: bytes of the text, or its words."""

    words: bool
    width: int
    k: int

    def read(self, buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(values, starts, ends) of the symbols of a buffer."""
        if not self.words:
            at = np.arange(len(buf) + 1)
            return byte_values(buf), at[:-1], at[1:]
        starts, ends = word_spans(buf)
        return span_hashes(byte_values(buf), starts, ends), starts, ends

    def texts(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(buffer, values, starts, ends, first symbol of each text, number of symbols of each)."""
        buf, offsets = joined(texts)
        values, starts, ends = self.read(buf)
        if not self.words:
            return buf, values, starts, ends, offsets[:-1], np.diff(offsets) - 1
        cut = np.searchsorted(starts, offsets)
        return buf, values, starts, ends, cut[:-1], np.diff(cut)


def contexts(values: np.ndarray, first: np.ndarray, lengths: np.ndarray, width: int, k: int):
    """(text, anchor hash, first window, last window) of each context; windows by their first
    symbol, counted from the start of all texts together."""
    none = np.zeros(0, dtype=np.int64)
    grams, w = window_hashes(values, k), width - k + 1
    long = lengths >= width
    if len(grams) < w or not long.any():
        return none, none.astype(np.uint64), none, none
    # least (hash, place) of each w neighbours, by doubling
    low = np.uint64((1 << max(28, len(grams).bit_length())) - 1)
    least, reach = (grams & ~low) | np.arange(len(grams), dtype=np.uint64), 1
    while reach < w:
        step = min(reach, w - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    # windows that lie within one text
    count = (lengths - width + 1)[long]
    ends = np.cumsum(count)
    at = np.arange(int(ends[-1])) + np.repeat(first[long] - (ends - count), count)
    text = np.repeat(np.flatnonzero(long), count)
    own = (least[at] & low).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (text[1:] != text[:-1])]))
    last = np.append(new[1:], len(at)) - 1
    return text[new], grams[own[new]], at[new], at[last]


def anchored(docs: DataFrame, symbols: Symbols) -> DataFrame:
    """Contexts of all texts: doc_id, row, anchor, c0 and c1 (digest of the context), start
    (first window, counted in its text) and windows (how many)."""
    def run(batches):
        import xxhash
        for b in batches:
            ids, rows, texts = b.column("doc_id"), b.column("row"), b.column("text").to_pylist()
            for lo, hi in slices(texts, 1 << 15):  # arrays that stay in the processor's cache
                buf, values, _, _, first, lengths = symbols.texts(texts[lo:hi])
                text, anchor, a, z = contexts(values, first, lengths, symbols.width, symbols.k)
                if not len(text):
                    continue
                content, unit = memoryview((values if symbols.words else buf).tobytes()), (8 if symbols.words else 1)
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(content[x:y])
                                                 for x, y in zip((a * unit).tolist(), ((z + symbols.width) * unit).tolist())), "<i8").reshape(-1, 2)
                take = pa.array(text + lo)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), rows.take(take), pa.array(anchor.view(np.int64)), pa.array(digests[:, 0].copy()),
                     pa.array(digests[:, 1].copy()), pa.array((a - first[text]).astype(np.int32)), pa.array((z - a + 1).astype(np.int32))],
                    ["doc_id", "row", "anchor", "c0", "c1", "start", "windows"])

    return docs.mapInArrow(frugal(run), "doc_id long, row long, anchor long, c0 long, c1 long, start int, windows int")


def _contents(docs: DataFrame, chosen: DataFrame, symbols: Symbols) -> DataFrame:
    """The symbols of each chosen context, read from the text of the document that stands for it.
    Of rows that repeat it in a task, one is read."""
    parts = chosen.groupBy("row").agg(F.collect_list(F.struct("anchor", "c0", "c1", "n", "first_id", "start", "windows")).alias("parts"))

    def cut(batches):
        seen: set[int] = set()
        for b in batches:
            texts = b.column("text").to_pylist()
            for row, text, wanted in zip(b.column("row").to_pylist(), texts, b.column("parts")):
                if row in seen:
                    continue
                seen.add(row)
                p = wanted.values
                start = p.field("start").to_numpy()
                end = start + p.field("windows").to_numpy() + symbols.width - 1
                raw = text.encode("utf-8")
                if symbols.words:
                    starts, ends = word_spans(np.frombuffer(raw, np.uint8))
                    start, end = starts[start], ends[end - 1]
                out = [raw[x:y] for x, y in zip(start.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays([*(p.field(c) for c in ("anchor", "c0", "c1", "n", "first_id")), pa.array(out, pa.binary())],
                                                 ["anchor", "c0", "c1", "n", "first_id", "content"])

    return docs.join(parts, "row").mapInArrow(frugal(cut), "anchor long, c0 long, c1 long, n long, first_id long, content binary")


def _runs(keys: list[np.ndarray], n: np.ndarray, first: np.ndarray, base: np.ndarray, windows: np.ndarray) -> pa.Table:
    """Runs of neighbouring windows with equal values, of those that occur more than once.
    ``base`` and ``windows``: where each context's windows begin in ``n`` and ``first``, and how many they are."""
    context = np.repeat(np.arange(len(base)), windows)
    lo = np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = base[context] + lo
    n, first = n[at], first[at]
    edge = np.flatnonzero(np.concatenate([[True], (n[1:] != n[:-1]) | (first[1:] != first[:-1]) | (context[1:] != context[:-1])])) if len(n) else np.zeros(0, np.int64)
    size = np.diff(np.append(edge, len(n)))
    more = n[edge] > 1
    edge, size = edge[more], size[more]
    return pa.table([*(k[context[edge]] for k in keys), pa.array(lo[edge].astype(np.int32)), pa.array(size.astype(np.int32)), n[edge], first[edge]],
                    [x for x, _ in _KEYS] + ["lo", "windows", "n", "first_id"])


def repeated_windows(docs: DataFrame, symbols: Symbols, index: Callable, max_group: int = 2000,
                     shard_symbols: int = 1 << 18) -> DataFrame:
    """Runs of windows that occur more than once: doc_id, row, start, windows, n (occurrences) and
    first_id (smallest document that has the window; LAST_ID stands for null).

    ``docs`` has doc_id, row (a hash of doc_id and text) and text. ``index(contents, counts,
    first_ids)`` gets the contexts of whole groups and gives two arrays over all places, occurrences
    in all the contexts and the smallest first_id, and each context's first place and number of windows."""
    found = written(anchored(docs, symbols))
    distinct = found.groupBy("anchor", "c0", "c1").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.coalesce("doc_id", F.lit(LAST_ID))).alias("first_id"),
        F.min(F.struct("row", "start", "windows")).alias("at"))
    groups = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("total")).where("total > 1").drop("total")
    chosen = written(distinct.join(groups, "anchor").select(
        "anchor", "c0", "c1", "n", "first_id", "at.row", "at.start", "at.windows", (F.col("members") > max_group).alias("large")))
    size, large = chosen.agg(F.sum(F.when(~F.col("large"), F.col("windows") + symbols.width)), F.max("large")).first()
    shards = max(1, -(-(size or 0) // shard_symbols))

    def indexed(table: pa.Table) -> pa.Table:
        keys = [table.column(c).to_numpy() for c, _ in _KEYS]
        # rows that repeat a document may have been read in several tasks: one of each context stays
        order = np.lexsort(keys)
        same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
        one = order[np.concatenate([[True], ~same])]
        table, keys = table.take(pa.array(one)), [k[one] for k in keys]
        return _runs(keys, *index(table.column("content").to_pylist(), table.column("n").to_numpy(), table.column("first_id").to_numpy()))

    runs = (_contents(docs, chosen.where("NOT large"), symbols).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
            .groupBy("shard").applyInArrow(indexed, _RUNS))
    if large:
        runs = runs.unionByName(_single_windows(_contents(docs, chosen.where("large"), symbols), symbols))
    return (found.join(runs.withColumnRenamed("windows", "run"), ["anchor", "c0", "c1"])
            .select("doc_id", "row", (F.col("start") + F.col("lo")).alias("start"), F.col("run").alias("windows"), "n", "first_id"))


def _single_windows(contents: DataFrame, symbols: Symbols) -> DataFrame:
    """Runs for the contexts of large groups: each window's digest is counted by itself."""
    def windows(batches):
        import xxhash
        for b in batches:
            for i, content in enumerate(b.column("content").to_pylist()):
                buf = np.frombuffer(content, np.uint8)
                values, starts, _ = symbols.read(buf)
                own = values if symbols.words else buf
                count = len(starts) - symbols.width + 1
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(own[x:x + symbols.width].tobytes()) for x in range(count)), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.column(c)[i].as_py()] * count, pa.int64()) for c in ("anchor", "c0", "c1", "n", "first_id")]
                    + [pa.array(np.arange(count, dtype=np.int32)), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())],
                    ["anchor", "c0", "c1", "n", "first_id", "lo", "w0", "w1"])

    one = contents.mapInArrow(frugal(windows), "anchor long, c0 long, c1 long, n long, first_id long, lo int, w0 long, w1 long")
    total = one.groupBy("w0", "w1").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id")).where("n > 1")
    return one.drop("n", "first_id").join(total, ["w0", "w1"]).select("anchor", "c0", "c1", "lo", F.lit(1).alias("windows"), "n", "first_id")


def covered(runs, length: int, width: int) -> np.ndarray:
    """Marks of the symbols that any window of the runs (an Arrow array of start and windows, or None) covers."""
    edge = np.zeros(length + 1, dtype=np.int32)
    if runs is not None and len(runs):
        start = runs.field("start").to_numpy()
        np.add.at(edge, start, 1)
        np.add.at(edge, np.minimum(length, start + runs.field("windows").to_numpy() - 1 + width), -1)
    return np.cumsum(edge[:-1]) > 0


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank (from 1) of each key among the distinct keys, and the sorted order."""
    order = np.argsort(key)
    sorted_key = key[order]
    out = np.empty(len(key), dtype=np.int64)
    out[order] = np.cumsum(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
    return out, order


class Suffixes:
    """Suffixes of several strings, sorted by their first ``depth`` symbols.

    Symbols are ranks from 1. ``step`` symbols of the raw values make the next symbol of a
    suffix: suffix r goes on with suffix r + step of the same string. ``ends[r]`` is the first
    suffix after the string of r."""

    def __init__(self, values: np.ndarray, ends: np.ndarray, depth: int, step: int = 1):
        n = len(values)
        self.depth, self.step = depth, step
        self.symbol, order = ranked(values)
        at = np.arange(n)

        def later(rank: np.ndarray, by: int) -> np.ndarray:
            """Rank of the suffix that starts ``by`` symbols later, 0 beyond the string's end."""
            to = at + by * step
            return np.where(to < ends, rank[np.minimum(to, n - 1)], 0)

        rank, reach = self.symbol, 1
        while reach < depth:
            jump = min(reach, depth - reach)
            self.half, self.reach = rank, reach
            rank, order = ranked(rank * (n + 1) + later(rank, jump))
            reach += jump
        self.later, self.rank, self.order = later, rank, order
        self.place = np.empty(n, dtype=np.int64)
        self.place[order] = at
        #: suffixes with a whole window of ``depth`` symbols
        self.full = at + (depth - 1) * step < ends
