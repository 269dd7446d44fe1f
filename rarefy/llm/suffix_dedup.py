"""Removal of repeated byte strings by threshold-bounded interval expansion.

Each byte covered by a string of ``width`` bytes that also starts anywhere
else goes. Contexts (see anchors.py) with a second occurrence are gathered
in shards, and a shard is searched through its Burrows-Wheeler transform:

* A suffix's symbols are its consecutive ``stride`` bytes, so a window is
  ``width / stride`` symbols, and the suffixes of all byte offsets are
  sorted by that many symbols.
* Starting from the interval of each single symbol, intervals are extended
  backwards, breadth first: the rows of an interval lead, by the transform,
  to the intervals of the words one symbol longer. An interval whose right
  border has no value yet gets the present length as common prefix there,
  and is queued. So common prefixes come out by increasing value.
* At the threshold the expansion stops. Borders without a value separate
  suffixes that agree in the whole window: each block of them is one
  repeated string.

Defined results: null counts as empty; matches never cross documents; all
strings are judged on the input; texts below ``width`` bytes lose nothing;
rows that repeat a document are other places, so their strings are
repeated; texts are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .anchors import Suffixes, Symbols, covered, repeated_windows
from .common import byte_values, documents, frugal, window_hashes

WIDTH, STRIDE, ANCHOR = 400, 50, 40


def expand(s: Suffixes, starts: np.ndarray) -> np.ndarray:
    """Common prefix (in symbols) of each suffix with the one before it in sorted order, where it
    is below the depth, and -1 elsewhere. ``starts[r]``: first suffix of the string of r."""
    n = len(s.order)
    lcp = np.full(n + 1, -1, dtype=np.int32)
    head = s.symbol[s.order]
    border = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1], [True]]))
    lcp[border] = 0
    left, right = border[:-1], border[1:]
    for length in range(1, s.depth):
        size = right - left
        ends = np.cumsum(size)
        if not len(ends):
            break
        rows = np.arange(int(ends[-1])) + np.repeat(left - (ends - size), size)
        interval = np.repeat(np.arange(len(left)), size)
        suffix = s.order[rows]
        before = suffix - s.step
        has = before >= starts[suffix]
        to, interval = s.place[before[has]], interval[has]
        if not len(to):
            break
        if len(to) > n // 16:
            # many rows: put each in its place instead of sorting them
            at = np.full(n, -1, dtype=np.int64)
            at[to] = interval
            to = np.flatnonzero(at >= 0)
            interval = at[to]
        else:
            order = np.argsort(to)
            to, interval = to[order], interval[order]
        # rows of one longer word stand side by side: same first symbol, same interval behind it
        symbol = head[to]
        new = np.flatnonzero(np.concatenate([[True], (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1])]))
        left, right = to[new], to[np.append(new[1:], len(to)) - 1] + 1
        unset = lcp[right] < 0
        left, right = left[unset], right[unset]
        lcp[right] = length
    return lcp


def index(width: int, stride: int):
    """Index for repeated_windows: occurrences and smallest document of each window."""
    def run(contents: list[bytes], counts: np.ndarray, first_ids: np.ndarray):
        lengths = np.array([len(c) for c in contents], dtype=np.int64)
        rows = lengths - stride + 1
        buf = np.frombuffer(b"".join(contents), dtype=np.uint8)
        base = np.concatenate([[0], np.cumsum(rows)])
        place = np.arange(base[-1]) + np.repeat((np.cumsum(lengths) - lengths) - base[:-1], rows)
        starts, ends = np.repeat(base[:-1], rows), np.repeat(base[1:], rows)
        s = Suffixes(window_hashes(byte_values(buf), stride)[place], ends, width // stride, stride)
        lcp = expand(s, starts)
        full = s.full[s.order]
        split = lcp[:-1] >= 0
        split[1:] |= ~full[1:] | ~full[:-1]
        block = np.cumsum(split) - 1
        owner = np.repeat(np.arange(len(contents)), rows)[s.order]
        total = np.bincount(block, weights=counts[owner]).astype(np.int64)
        least = np.minimum.reduceat(first_ids[owner], np.flatnonzero(split))
        n, first = np.empty(len(block), dtype=np.int64), np.empty(len(block), dtype=np.int64)
        n[s.order], first[s.order] = total[block], least[block]
        return n, first, base[:-1], lengths - width + 1

    return run


def repeated_bytes(docs: DataFrame, width: int = WIDTH, stride: int = STRIDE, anchor: int = ANCHOR,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, kept (bytes that stay), n_bytes, n_removed, n_spans."""
    if width % stride or width <= anchor:
        raise ValueError("the width is a multiple of the stride and larger than the anchor")
    d = documents(docs, id_col, text_col)
    d = d.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    symbols = Symbols(words=False, width=width, k=anchor)
    runs = repeated_windows(d, symbols, index(width, stride))
    spans = runs.groupBy("row").agg(F.collect_set(F.struct("start", "windows")).alias("runs"))

    def remove(batches):
        for b in batches:
            out = []
            for text, found in zip(b.column("text").to_pylist(), b.column("runs")):
                buf = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
                gone = covered(found.values, len(buf), width)
                edges = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and bool(gone[0]))
                out.append((buf[~gone].tobytes(), len(buf), int(gone.sum()), edges))
            kept, total, removed, count = (list(c) for c in zip(*out)) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.binary()), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(count, pa.int64())], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return d.join(spans, "row", "left").mapInArrow(frugal(remove), "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
