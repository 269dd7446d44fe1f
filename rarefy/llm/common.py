"""Shared helpers: column selection, vectorised word spans and hashes.

Every operator selects its key and text columns first and gives them its
own names, so further columns of the input (also with clashing names)
never meet the operator's columns.
"""

from __future__ import annotations

import ctypes
import functools
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import checkpoint_dir, cut_lineage, ship_package

#: odd multiplier of the polynomial hashes and its inverse modulo 2**64
_MUL = 0x9E3779B97F4A7C15
_INV = pow(_MUL, -1, 1 << 64)
_CHUNK = 1 << 20


#: rows that a Python worker gets at once; texts may be long
BATCH_ROWS = 500
#: mallopt's name for the size from which an array has pages of its own
_MMAP_THRESHOLD = -3


def prepared(spark: SparkSession) -> SparkSession:
    """Ships the package and bounds the Arrow batches of this session."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


@functools.cache
def _lean():
    """Once in a Python worker: freed arrays go back to the system at once, and not into pools
    that the worker keeps beside the executor."""
    pa.set_memory_pool(pa.system_memory_pool())
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(_MMAP_THRESHOLD, 1 << 20)
    return getattr(libc, "malloc_trim", lambda pad: None)


def frugal(run):
    """A task's function that gives freed memory back, also at its end: the Python worker lives on
    beside the executor and would keep it."""
    def wrapped(batches):
        trim = _lean()
        yield from run(batches)
        trim(0)

    return wrapped


def frugal_group(run):
    """The same for a function of one group's table."""
    def wrapped(table: pa.Table) -> pa.Table:
        trim = _lean()
        out = run(table)
        trim(0)
        return out

    return wrapped


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text only (null text stays null)."""
    prepared(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder."""
    return cut_lineage(df)


def written(df: DataFrame) -> DataFrame:
    """A Parquet table in the cluster's shared folder, for what is read more than once and is
    smaller in columns than a checkpoint's rows. It stays there as long as the folder's checkpoints."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/rarefy-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", str(16 << 20)).parquet(path)  # small buffers in the writing tasks
    return spark.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MUL))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(multiplier ** i, inverse ** i) modulo 2**64 for i in 0..n."""
    size = max(1 << 16, 1 << int(n).bit_length(), *_POWERS)  # the longest stays
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for m in (_MUL, _INV):
            a = np.full(size + 1, m, dtype=np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _POWERS[size] = (out[0], out[1])
    return _POWERS[size]


def window_hashes(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive 64-bit values (len - k + 1 of them)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for lo in range(0, n, _CHUNK):
        hi = min(n, lo + _CHUNK)
        up, down = _powers(hi - lo + k)
        part = values[lo:hi + k - 1]
        s = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * down[:len(part)], out=s[1:])
        out[lo:hi] = (s[k:] - s[:len(part) - k + 1]) * up[:hi - lo]
    return mix(out)


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[starts[i]:ends[i]] for ascending, disjoint spans.

    Spans are hashed in chunks of about a million values, so a long text
    needs no long power table; one longer span makes a chunk of its own.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + _CHUNK, side="right")))
        up, down = _powers(int(ends[j - 1]) - base)
        part = values[base:int(ends[j - 1])]
        s = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * down[:len(part)], out=s[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (s[b] - s[a]) * up[a] + (b - a).astype(np.uint64)
        i = j
    return mix(out)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_values(buf: np.ndarray) -> np.ndarray:
    return _BYTE[buf]


def joined(texts, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one space between them, and each text's offset
    (one more offset at the end). Null counts as empty."""
    raw = [t.encode("utf-8") if t else b"" for t in texts]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    buf = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    return (_LOWER[buf] if lower else buf), offsets


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of bytes other than \\x20 and \\x09-\\x0D."""
    gap = _SPACE[buf]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if len(buf) and not gap[0]:
        edge = np.concatenate([[0], edge])
    if len(buf) and not gap[-1]:
        edge = np.concatenate([edge, [len(buf)]])
    return edge[0::2], edge[1::2]


def slices(texts, most: int = 1 << 20):
    """(from, to) of consecutive texts with at most ``most`` characters
    together; one longer text makes a slice of its own."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if len(texts) > lo:
        yield lo, len(texts)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
