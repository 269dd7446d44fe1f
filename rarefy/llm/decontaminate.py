"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

Texts and benchmark items are normalised alike: A-Z lower-cased, every run
of characters other than letters and digits turned into one space. An item
is read in segments of ``segment`` characters that overlap by half (a
shorter item is one segment). A document contains a segment when some
region of it is within ``budget = floor(rate * length)`` edits (insert,
delete, replace). So a passage of one and a half segments that is copied
as it is, is always found.

1. Counting. A region within e edits of a segment of m characters keeps
   at least m + 1 - q(e + 1) of its q-grams, all on diagonals (document
   offset minus segment offset) that differ by e at most. So hits are
   counted in bands of 2(e + 1) diagonals that overlap by half: one band
   holds all the hits of a region. Bands below the bound are discarded.
2. Verifying. Each band left is aligned: the best edit distance of the
   segment against any region of the document that starts on the band's
   diagonals, by dynamic programming within e of them.

The benchmark is a stated query set. It is read in blocks of at most
``block_grams`` characters, so the broadcast of each block is bounded; every
block meets all documents in one map without a shuffle.

Defined results: null and empty texts contain nothing; null and empty
items, and items without a letter or digit, are contained nowhere; items
whose bound would be below one hit are looked up as they are, without
edits; repeated rows and repeated items give repeated results; texts are
read whole; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import documents, frugal, prepared, slices

#: length of q-grams, of segments, and edits allowed per character
Q, SEGMENT, RATE = 10, 50, 0.06
#: characters of a block of items (a q-gram at most for each, twice by the overlap)
BLOCK_GRAMS = 2_000_000
_BASE = np.uint64(0x100000001B3)


def _plain_table() -> np.ndarray:
    """For each code point of the first plane: itself lower-cased (A-Z) where it is a
    letter or digit, a space elsewhere."""
    out = np.full(1 << 16, 32, dtype=np.uint32)
    for cp in range(1 << 16):
        if not 0xD800 <= cp < 0xE000 and chr(cp).isalnum():
            out[cp] = cp
    out[65:91] += 32
    return out


_PLAIN: list[np.ndarray] = []


def plain(texts) -> tuple[np.ndarray, np.ndarray]:
    """Normalised code points of all texts, each ended by a zero, and their offsets."""
    if not _PLAIN:
        _PLAIN.append(_plain_table())
    whole = "\0".join((t or "").replace("\0", " ") for t in texts) + "\0"
    cps = np.frombuffer(whole.encode("utf-32-le", "replace"), dtype=np.uint32)
    out = _PLAIN[0][np.minimum(cps, 0xFFFF)]
    high = cps > 0xFFFF
    if high.any():
        out[high] = cps[high]
    end = cps == 0
    out[end] = 0
    keep = np.ones(len(out), dtype=bool)
    # of a run of spaces one stays; none at the start or end of a text
    gap = out == 32
    before = np.concatenate([[0], out[:-1]])
    keep[gap & ((before == 32) | (before == 0))] = False
    after = np.concatenate([out[1:], [0]])
    keep[gap & (after == 0)] = False
    out = out[keep]
    # a run of spaces before an end leaves its first one, which goes too
    trailing = (out == 32) & (np.concatenate([out[1:], [0]]) == 0)
    out = out[~trailing]
    ends = np.flatnonzero(out == 0)
    return out, np.concatenate([[0], ends + 1])


def gram_hashes(cps: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters from each place on (the last q - 1 places have none)."""
    n = len(cps) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    wide = cps.astype(np.uint64)
    h = wide[:n].copy()
    for i in range(1, q):
        h *= _BASE
        h += wide[i:i + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Segments:
    """Segments of a block of items and an index of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], q: int, segment: int, rate: float):
        self.q, self.item, self.text, self.start = q, [], [], []
        cps, offsets = plain([t for _, t in items])
        for (item, _), a, b in zip(items, offsets[:-1].tolist(), offsets[1:].tolist()):
            own = cps[a:b - 1]
            if not len(own):
                continue
            # the last one reaches back to be of full length
            for s in sorted({max(0, min(s, len(own) - segment)) for s in range(0, len(own), max(1, segment // 2))}):
                self.item.append(item)
                self.start.append(s)
                self.text.append(own[s:s + segment])
        self.budget = [int(rate * len(t)) for t in self.text]
        for i, t in enumerate(self.text):
            # without a bound of at least one hit, only the exact text counts
            if len(t) + 1 - q * (self.budget[i] + 1) < 1:
                self.budget[i] = 0
        self.bound = np.array([max(1, len(t) + 1 - q * (e + 1)) for t, e in zip(self.text, self.budget)], dtype=np.int64)
        keys, seg, pos = [], [], []
        self.short = [i for i, t in enumerate(self.text) if len(t) < q]
        for i, t in enumerate(self.text):
            if len(t) >= q:
                h = gram_hashes(t, q)
                keys.append(h)
                seg.append(np.full(len(h), i, dtype=np.int64))
                pos.append(np.arange(len(h), dtype=np.int64))
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.seg = (np.concatenate(seg) if seg else np.zeros(0, np.int64))[order]
        self.pos = (np.concatenate(pos) if pos else np.zeros(0, np.int64))[order]
        self.bits = max(16, int(len(keys) * 16).bit_length())
        self.seen = np.zeros(1 << self.bits, dtype=bool)
        self.seen[(self.keys >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def bands(self, cps: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, segment, first diagonal, last diagonal, hits) of the bands that meet the
        bound; diagonals count from the start of all documents together."""
        h = gram_hashes(cps, self.q)
        at = np.flatnonzero(self.seen[(h >> np.uint64(64 - self.bits)).astype(np.int64)])
        if not len(at):
            return
        lo = np.searchsorted(self.keys, h[at], side="left")
        n = np.searchsorted(self.keys, h[at], side="right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        total = int(n.sum())
        if not total:
            return
        ends = np.cumsum(n)
        entry = np.arange(total) + np.repeat(lo - (ends - n), n)
        seg, place = self.seg[entry], np.repeat(at, n)
        doc = np.searchsorted(offsets, place, side="right") - 1
        width = np.array(self.budget, dtype=np.int64)[seg] + 1
        shift = 1 << 20  # no segment is so long, so a shifted diagonal is positive
        band = (place - self.pos[entry] + shift) // width
        # hits of one document and segment, by band; neighbours together make the overlapping bands
        order = np.lexsort((band, seg, doc))
        doc, seg, band = doc[order], seg[order], band[order]
        same = (doc[1:] == doc[:-1]) & (seg[1:] == seg[:-1])
        first = np.flatnonzero(np.concatenate([[True], ~same | (band[1:] != band[:-1])]))
        count = np.diff(np.append(first, total))
        d, s, b = doc[first], seg[first], band[first]
        joins = np.zeros(len(s), dtype=bool)
        joins[:-1] = (d[1:] == d[:-1]) & (s[1:] == s[:-1]) & (b[1:] == b[:-1] + 1)
        both = count + np.where(joins, np.append(count[1:], 0), 0)
        for i in np.flatnonzero(both >= self.bound[s]).tolist():
            w = self.budget[s[i]] + 1
            a = int(b[i]) * w - shift
            yield int(d[i]), int(s[i]), a, a + (2 if joins[i] else 1) * w - 1, int(both[i])

    def align(self, cps: np.ndarray, segment: int, first: int, last: int) -> tuple[int, int, int] | None:
        """Least edit distance of the segment to a region that starts on diagonals first..last,
        with the region, where it is within the budget. Only cells on those diagonals and the
        budget on either side are computed, a row of them for each character of the segment."""
        pattern, e, n = self.text[segment], self.budget[segment], len(cps)
        m, low = len(pattern), first - e
        width, none = last - first + 1 + 2 * e, len(pattern) + 1
        # characters that the cells of row i compare: region[i - 1:i - 1 + width]
        region = np.zeros(m + width, dtype=np.uint32)
        a, b = max(0, low), min(n, low + m + width)
        if b - a < m - e:
            return None
        region[a - low:b - low] = cps[a:b]
        k = np.arange(width)
        ends = low + k
        row = np.where((ends >= 0) & (ends <= n), 0, none)
        origin = ends.copy()
        for i in range(1, m + 1):
            sub = row + (region[i - 1:i - 1 + width] != pattern[i - 1])
            up = np.append(row[1:], none) + 1
            take = sub <= up
            best = np.where(take, sub, up)
            start = np.where(take, origin, np.append(origin[1:], 0))
            ends = low + i + k
            best[(ends < 0) | (ends > n)] = none
            # insertions run along the row: best[k] = min over l <= k of best[l] + k - l
            least = np.minimum.accumulate(best - k)
            source = np.maximum.accumulate(np.where(best - k == least, k, 0))
            row, origin = np.minimum(least + k, none), start[source]
            if row.min() > e:
                return None
        j = int(row.argmin())
        return int(row[j]), int(origin[j]), low + m + j

    def found(self, cps: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int, int]]:
        """(document, item, segment start, hits, edits, region from, region to): the best region
        of each segment of each document."""
        best: dict[tuple[int, int], tuple] = {}
        for d, s, a, b, hits in self.bands(cps, offsets):
            if best.get((d, s), (0, (1,)))[1][0] == 0:
                continue  # nothing is closer than no edit
            o = int(offsets[d])
            got = self.align(cps[o:int(offsets[d + 1]) - 1], s, a - o, b - o)
            if got and ((d, s) not in best or got < best[d, s][1]):
                best[d, s] = (hits, got)
        whole = cps.tobytes() if self.short else b""
        for s in self.short:
            needle = self.text[s].tobytes()
            at = whole.find(needle)
            while at >= 0:
                d = int(np.searchsorted(offsets, at // 4, side="right")) - 1
                if at % 4 == 0 and (d, s) not in best:
                    a = at // 4 - int(offsets[d])
                    best[d, s] = (1, (0, a, a + len(self.text[s])))
                at = whole.find(needle, at + 1)
        for (d, s), (hits, got) in sorted(best.items()):
            yield (d, self.item[s], self.start[s], hits, *got)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_grams: int) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks; the driver holds one block at a time."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    block, size = [], 0
    for r in rows.toLocalIterator():
        if block and size + len(r.text) > block_grams:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text))
        size += len(r.text)
    if block:
        yield block


_FOUND = (("doc_id", pa.int64()), ("item_id", pa.int64()), ("seg_start", pa.int32()), ("n_hits", pa.int32()), ("edits", pa.int32()),
          ("region_start", pa.int64()), ("region_end", pa.int64()))


def _search(index: Segments, texts: list) -> Iterator[tuple]:
    """(place of the text, item, segment start, hits, edits, region from, region to)."""
    for lo, hi in slices(texts):
        cps, offsets = plain(texts[lo:hi])
        for d, *found in index.found(cps, offsets):
            yield lo + d, *found


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", q: int = Q, segment: int = SEGMENT,
                 rate: float = RATE, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """One row per document, item and segment found: doc_id, item_id, seg_start, n_hits, edits,
    region_start, region_end (offsets in the normalised text)."""
    d = documents(docs, id_col, text_col)
    schema = "doc_id long, item_id long, seg_start int, n_hits int, edits int, region_start long, region_end long"
    out = d.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, item_text_col, block_grams):
        shared = d.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            index = Segments(shared.value, q, segment, rate)
            for b in batches:
                ids = b.column("doc_id").to_pylist()
                rows = [(ids[i], *found) for i, *found in _search(index, b.column("text").to_pylist())]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FOUND)], [n for n, _ in _FOUND])

        out = out.unionByName(d.mapInArrow(frugal(run), schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
          q: int = Q, segment: int = SEGMENT, rate: float = RATE, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """The rows of ``docs`` that contain no segment of the benchmark, with all their columns."""
    prepared(docs.sparkSession)
    place = docs.columns.index(text_col)
    for block in _blocks(benchmark, item_col, item_text_col, block_grams):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            index = Segments(shared.value, q, segment, rate)
            for b in batches:
                stays = np.ones(b.num_rows, dtype=bool)
                stays[[i for i, *_ in _search(index, b.column(place).to_pylist())]] = False
                yield b.filter(pa.array(stays))

        docs = docs.mapInArrow(frugal(run), docs.schema)
    return docs
