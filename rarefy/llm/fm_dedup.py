"""Removal of word windows that an earlier document has, through an FM-index.

Each word covered by a window of ``width`` words goes if the window's word
sequence also starts in a document with a smaller doc_id. Contexts (see
anchors.py) with a second occurrence are gathered in shards. A shard's
index is the Burrows-Wheeler transform of its contexts' words in a wavelet
matrix of packed bits. The contexts are then streamed against it from their
last word to their first: a backward step narrows the interval of rows to
those with one more word in front, and a match that has reached the
threshold first gives up its last word (its interval widens to the rows
that agree in one word less). So at each word the longest match is known up
to the threshold, and where it reaches the threshold, the interval holds
all the places of the window, with their smallest document.

Words are runs of bytes other than \\x20 and \\x09-\\x0D.

Defined results: null counts as no words; windows are judged on the input;
a null doc_id counts as larger than any other; repeats within a document,
and rows that repeat its doc_id, aren't earlier; texts are read whole; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .anchors import LAST_ID, Suffixes, Symbols, covered, repeated_windows
from .common import byte_values, documents, frugal, joined, span_hashes, word_spans

WIDTH, ANCHOR = 50, 8


class Bits:
    """Packed bits with a count at each 64th, for rank in constant time."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before place i."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletMatrix:
    """Rank of any symbol in a sequence, one level of bits for each bit of a symbol."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels, self.zeros = [], []
        self.height = max(1, int(symbols - 1).bit_length())
        for level in range(self.height - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        every = np.arange(symbols)
        self.origin = self._descend(every, np.zeros(symbols, dtype=np.int64))

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for d, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.rank(i)
            i = np.where(symbol >> (self.height - 1 - d) & 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of the symbol before place i."""
        return self._descend(symbol, i) - self.origin[symbol]


class FMIndex:
    """Backward search over the sorted suffixes of several word strings."""

    def __init__(self, s: Suffixes, starts: np.ndarray, ends: np.ndarray):
        n, sigma = len(s.order), int(s.symbol.max()) + 1
        before = s.order - 1
        # 0 in front of a string's first word, which no search asks for
        self.transform = WaveletMatrix(np.where(before >= starts[s.order], s.symbol[np.maximum(before, 0)], 0), sigma)
        count = np.bincount(s.symbol, minlength=sigma)
        self.first = np.concatenate([[0], np.cumsum(count)])
        # a string's last word has no suffix behind it; its rows stand first among the word's rows
        self.closing = np.bincount(s.symbol[ends - 1 == np.arange(n)], minlength=sigma)
        # rows that agree in one word less than the depth
        a, b = s.order[:-1], s.order[1:]
        by = s.depth - 1 - s.reach
        tail = s.later(s.half, by) if by > 0 else s.half
        cut = np.concatenate([[True], (s.half[a] != s.half[b]) | (tail[a] != tail[b]), [True]])
        edge = np.flatnonzero(cut)
        group = np.cumsum(cut[:-1]) - 1
        self.low, self.high = edge[group], edge[group + 1]

    def start(self, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.first[word], self.first[word + 1]

    def step(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the words with ``word`` in front."""
        both = self.transform.rank(np.concatenate([word, word]), np.concatenate([low, high]))
        base = self.first[word] + self.closing[word]
        return base + both[:len(word)], base + both[len(word):]

    def widen(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of a full match without its last word."""
        return self.low[low], self.high[low]


def index(width: int):
    """Index for repeated_windows: matching statistics of all contexts against the shard."""
    def run(contents: list[bytes], counts: np.ndarray, first_ids: np.ndarray):
        buf, offsets = joined_bytes(contents)
        begin, finish = word_spans(buf)
        base = np.searchsorted(begin, offsets)
        length = np.diff(base)
        starts, ends = np.repeat(base[:-1], length), np.repeat(base[1:], length)
        s = Suffixes(span_hashes(byte_values(buf), begin, finish), ends, width)
        fm = FMIndex(s, starts, ends)
        # places of each full window: rows with an equal rank
        rank = s.rank[s.order]
        edge = np.flatnonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))
        owner = np.repeat(np.arange(len(contents)), length)[s.order]
        total = np.add.reduceat(counts[owner], edge)
        least = np.minimum.reduceat(first_ids[owner], edge)
        n, first = np.zeros(len(s.order), dtype=np.int64), np.zeros(len(s.order), dtype=np.int64)

        order = np.argsort(-length, kind="stable")
        at, left = base[1:][order] - 1, length[order]
        low, high = fm.start(s.symbol[at])
        for matched in range(1, int(left[0])):
            active = int(np.searchsorted(-left, -matched))
            at, low, high = at[:active] - 1, low[:active], high[:active]
            if matched >= width:
                low, high = fm.widen(low)
            low, high = fm.step(s.symbol[at], low, high)
            if matched >= width - 1:
                # the interval is one block of equal windows
                block = np.searchsorted(edge, low, side="right") - 1
                n[at], first[at] = total[block], least[block]
        return n, first, base[:-1], length - width + 1

    return run


def joined_bytes(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(c) + 1 for c in contents])])
    return np.frombuffer(b" ".join(contents) + b" ", dtype=np.uint8), offsets


def earlier_words(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, kept (words that stay, joined by one space), n_words, n_removed."""
    d = documents(docs, id_col, text_col)
    d = d.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    symbols = Symbols(words=True, width=width, k=anchor)
    runs = repeated_windows(d, symbols, index(width))
    earlier = runs.where(F.col("first_id") < F.coalesce("doc_id", F.lit(LAST_ID)))
    spans = earlier.groupBy("row").agg(F.collect_set(F.struct("start", "windows")).alias("runs"))

    def remove(batches):
        for b in batches:
            kept, total, gone = [], [], []
            for text, found in zip(b.column("text").to_pylist(), b.column("runs")):
                buf, _ = joined([text])
                starts, ends = word_spans(buf)
                out = covered(found.values, len(starts), width)
                raw = buf.tobytes()
                kept.append(b" ".join([raw[a:z] for a, z in zip(starts[~out].tolist(), ends[~out].tolist())]))
                total.append(len(starts))
                gone.append(int(out.sum()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.binary()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             ["doc_id", "kept", "n_words", "n_removed"])

    return d.join(spans, "row", "left").mapInArrow(frugal(remove), "doc_id long, kept binary, n_words long, n_removed long")
