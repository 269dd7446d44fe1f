"""Byte-level BPE over a global shuffle of distinct words.

1. Each task splits its texts into pre-tokens and gathers them in blocks
   of about ``block_chars`` characters. A block keeps, per document, the
   positions as codes into the block's own list of distinct words.
2. The distinct words of all blocks are dealt out by word hash, so equal
   words meet in one bucket, where each distinct word is encoded once.
3. The ids go back to their block by a second shuffle and take the places
   the codes name. Decoding looks up the token-byte table.

Words travel in rows of (block, bucket), a word occurs at most once in a
block, and so a word that fills a third of the corpus costs one entry a
block. The vocabulary (its size is checked) is the only broadcast.

Defined results: null text counts as empty and an empty text has no ids;
texts are read whole; repeated rows are encoded alike; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import documents, frugal, partitions

#: entries a vocabulary may have to be broadcast
MAX_VOCABULARY = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if len(ranks) > MAX_VOCABULARY:
        raise ValueError(f"{len(ranks)} tokens; a vocabulary of at most {MAX_VOCABULARY} is broadcast")
    return ranks


# Letters, numbers and white space up to U+00FF, where the classes are short.
_LATIN = {r"\p{L}": "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", r"\p{N}": "0-9\u00b2\u00b3\u00b9\u00bc-\u00be",
          r"\s": "\\t-\\r \u0085\u00a0"}


def pre_tokens(pattern: str):
    """Splitter for the pattern. White space means Unicode's property, as for the rank files'
    tokenizers; texts up to U+00FF take a pattern with plain character classes."""
    import regex
    whole = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                          .replace(r"\S", r"\P{White_Space}")).findall
    inside = pattern.replace(r"\S", f"[^{_LATIN[r'\s']}]")
    for name, chars in _LATIN.items():
        inside = re.sub(r"(\[\^[^\]]*)" + re.escape(name), lambda m: m[1] + chars, inside).replace(name, f"[{chars}]")
    latin = re.compile(inside).findall

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return whole(text)
        return latin(text)

    return split


class Merger:
    """Ids of one pre-token."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken
        self.ranks = ranks
        self.merge = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, word: str) -> list[int]:
        whole = self.ranks.get(word.encode("utf-8"))
        return self.merge(word) if whole is None else [whole]


def packed(x: np.ndarray) -> bytes:
    """32-bit codes by byte planes, deflated: the planes of the high bytes shrink to almost nothing."""
    return zlib.compress(np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], block_chars: int) -> Iterator[tuple[int, list, list]]:
    """(block, doc ids, texts). A block's number is a hash of its rows and its place in the task, whose
    rows are sorted, so a repeated task gives the same numbers, and so do tasks of equal rows."""
    import xxhash
    ids, texts, size, count = [], [], 0, 0

    def done():
        h = xxhash.xxh64(f"{count}:{len(ids)}:".encode())
        for i, t in zip(ids, texts):
            data = (t or "").encode("utf-8")
            h.update(f"{i}:{len(data)}:".encode())
            h.update(data)
        return h.intdigest() - (1 << 63), ids, texts

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids.append(i)
            texts.append(t)
            size += len(t or "")
            if size >= block_chars:
                yield done()
                ids, texts, size, count = [], [], 0, count + 1
    if ids:
        yield done()


def _coded(texts, split, buckets: int) -> tuple[list[np.ndarray], list[list[str]]]:
    """Codes of each text into the block's words, and the words by bucket; the
    codes count through the buckets in order."""
    import xxhash
    seen: defaultdict[str, int] = defaultdict()
    seen.default_factory = seen.__len__
    rows = []
    for t in texts:
        words = split(t or "")
        rows.append(np.fromiter(map(seen.__getitem__, words), np.int32, len(words)))
    bucket = np.fromiter((xxhash.xxh32_intdigest(w.encode("utf-8", "surrogatepass")) % buckets for w in seen), np.int64, len(seen))
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(seen), dtype=np.int64)
    place[order] = np.arange(len(seen))
    words = list(seen)
    by_bucket: list[list[str]] = [[] for _ in range(buckets)]
    for i in order.tolist():
        by_bucket[bucket[i]].append(words[i])
    return [place[r] for r in rows], by_bucket


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id",
           text_col: str = "text", block_chars: int = 8 << 20, buckets: int | None = None, keep_sha: bool = False) -> DataFrame:
    """One row per document: doc_id and ids (token ids in order), with ``keep_sha`` also
    text_sha256 (hex, of the text in UTF-8)."""
    # both scans have to see a task's rows in one order, whatever order they come in
    d = documents(docs, id_col, text_col)
    d = d.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    sc = d.sparkSession.sparkContext
    n = buckets or partitions(d)
    table = sc.broadcast(ranks)
    kept = {"doc_id": pa.int64()} | ({"text_sha256": pa.string()} if keep_sha else {})
    fields = "doc_id long" + ", text_sha256 string" * keep_sha

    def words(batches):
        split = pre_tokens(pattern)
        for block, _, texts in _blocks(batches, block_chars):
            first, rows = 0, []
            for b, ws in enumerate(_coded(texts, split, n)[1]):
                if ws:
                    rows.append((block, b, first, zlib.compress(json.dumps(ws).encode(), 1)))
                first += len(ws)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["block", "bucket", "first", "words"])

    def codes(batches):
        split = pre_tokens(pattern)
        for block, ids, texts in _blocks(batches, block_chars):
            rows = _coded(texts, split, n)[0]
            for lo in range(0, len(ids), 1000):
                part = slice(lo, lo + 1000)
                own = {"doc_id": ids[part]}
                if keep_sha:
                    own["text_sha256"] = [hashlib.sha256((t or "").encode("utf-8")).hexdigest() for t in texts[part]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(ids[part]), pa.int64()), *(pa.array(own[c], t) for c, t in kept.items()),
                     pa.array([packed(r) for r in rows[part]], pa.binary())], ["block", *kept, "codes"])

    def named(batches):
        merger, known = Merger(table.value), {}
        for b in batches:
            out = []
            for ws in b.column("words").to_pylist():
                ids, lengths = [], []
                for w in json.loads(zlib.decompress(ws)):
                    got = known.get(w)
                    if got is None:
                        if len(known) > 500_000:
                            known.clear()
                        got = known[w] = merger.ids(w)
                    ids += got
                    lengths.append(len(got))
                out.append((packed(np.array(lengths, dtype=np.int64)), packed(np.array(ids, dtype=np.int64))))
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("first"), pa.array([x for x, _ in out], pa.binary()),
                                              pa.array([y for _, y in out], pa.binary())], ["block", "first", "lengths", "ids"])

    def reassembled(left: pa.Table, right: pa.Table) -> pa.Table:
        # blocks of equal rows share a number and have equal words: one row for each first
        right = right.take(pa.array(np.unique(right.column("first").to_numpy(), return_index=True)[1]))
        lengths = np.concatenate([unpacked(x) for x in right.column("lengths").to_pylist()] or [np.zeros(0, np.int64)])
        ids = np.concatenate([unpacked(x) for x in right.column("ids").to_pylist()] or [np.zeros(0, np.int64)])
        ends = np.concatenate([[0], np.cumsum(lengths)])
        words = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
        codes = [unpacked(c) for c in left.column("codes").to_pylist()]
        placed = words.take(pa.array(np.concatenate(codes)))
        # the ids of a document are those of its words, one after the other
        cut = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
        whole = pa.ListArray.from_arrays(placed.offsets.take(pa.array(cut)), placed.values)
        return pa.table([*(left.column(c) for c in kept), whole], [*kept, "ids"])

    encoded = (d.mapInArrow(frugal(words), "block long, bucket int, first int, words binary")
               .repartition(n, "bucket").mapInArrow(frugal(named), "block long, first int, lengths binary, ids binary"))
    return (d.mapInArrow(frugal(codes), f"block long, {fields}, codes binary").groupBy("block")
            .cogroup(encoded.groupBy("block")).applyInArrow(reassembled, f"{fields}, ids array<int>"))


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Adds decoded (bytes): each id looked up in the broadcast token-byte table."""
    sc = encoded.sparkSession.sparkContext
    size = max(ranks.values()) + 1
    by_id = [b""] * size
    for k, v in ranks.items():
        by_id[v] = k
    table = sc.broadcast(by_id)

    def run(batches):
        tokens = pa.array(table.value, pa.binary())
        for b in batches:
            ids = b.column("ids").fill_null([]) if b.column("ids").null_count else b.column("ids")
            text = tokens.take(ids.flatten())
            ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
            bounds = np.frombuffer(text.buffers()[1], np.int32)[text.offset:][ends]
            decoded = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(bounds.astype(np.int32)), text.buffers()[2]])
            yield pa.RecordBatch.from_arrays([*b.columns, decoded], [*b.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"
    return encoded.mapInArrow(frugal(run), schema)
