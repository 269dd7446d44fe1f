"""Quality classifier: hashed word n-grams, logistic regression, FTRL updates.

Features are single words and pairs of neighbouring words, each hashed to
``2 ** bits`` weights: once as the lower-cased word and once as the word's
shape (runs of capitals, small letters and digits become one sign each),
which stands for words that training never saw. Counts are scaled to the
length ``SCALE``. Training follows the regularised leader, one document at a time,
over a sample of at most ``max_rows`` labelled rows, taken in the order of
a hash of the id; scoring is a sparse dot product in Spark tasks.

Defined results: a null or empty text is scored by the bias alone; rows
with a null label or text are not learned from; repeated labels of a
document count once each distinct label; texts are read whole; an empty
table gives an empty result; without labels every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import byte_values, documents, frugal, joined, mix, slices, span_hashes, word_spans

BITS = 18
#: length of a document's feature vector
SCALE = 4.0
#: labelled rows that training reads at most
MAX_ROWS = 6000

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[48:58], _SHAPE[128:] = 65, 97, 48, 97


def _hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and of their shapes."""
    low = np.where((buf >= 65) & (buf < 91), buf + 32, buf).astype(np.uint8)
    words = span_hashes(byte_values(low), starts, ends)
    shape = _SHAPE[buf]
    keep = np.ones(len(buf), dtype=bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[starts] = True
    place = np.cumsum(keep) - keep
    short = shape[keep]
    # a word's end is a kept separator or the end of the buffer
    to = np.append(place, len(short))[ends]
    return words, span_hashes(byte_values(short), place[starts], to)


def features(texts, bits: int = BITS):
    """For each text, its feature numbers and their values (of length SCALE)."""
    mask = np.uint64((1 << bits) - 1)
    for lo, hi in slices(texts):
        buf, offsets = joined(texts[lo:hi])
        starts, ends = word_spans(buf)
        words, shapes = _hashes(buf, starts, ends)
        cut = np.searchsorted(starts, offsets)
        pair = lambda x, salt: mix(x[:-1] * np.uint64(3) + x[1:] + np.uint64(salt))
        pairs, shape_pairs = (pair(words, 1), pair(shapes, 2)) if len(words) else (words, shapes)
        shapes = mix(shapes + np.uint64(3))
        for i in range(hi - lo):
            a, b = cut[i], cut[i + 1]
            own = np.concatenate([words[a:b], shapes[a:b], pairs[a:max(a, b - 1)], shape_pairs[a:max(a, b - 1)]]) & mask
            ids, n = np.unique(own.astype(np.int64), return_counts=True)
            n = n.astype(np.float32)
            yield ids, n * np.float32(SCALE / np.sqrt((n ** 2).sum())) if len(n) else n


def ftrl(examples, bits: int = BITS, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.01, l2: float = 0.1,
         passes: int = 4) -> np.ndarray:
    """Weights and, last, the bias. ``examples``: list of (ids, values, label 0 or 1)."""
    size = (1 << bits) + 1
    z, g2 = np.zeros(size), np.zeros(size)

    def weights(ids):
        zi = z[ids]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(g2[ids])) / alpha + l2))

    for _ in range(passes):
        for ids, x, y in examples:
            ids, x = np.append(ids, size - 1), np.append(x, 1.0)
            w = weights(ids)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(g2[ids] + g * g) - np.sqrt(g2[ids])) / alpha
            z[ids] += g - sigma * w
            g2[ids] += g * g
    return weights(np.arange(size)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", bits: int = BITS, max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights learned from at most ``max_rows`` labelled rows. The sample's ids (a few bytes
    each, bounded by max_rows) are broadcast to the documents; their features meet in one task."""
    d = documents(docs, id_col, text_col)
    sample = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .where("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows))

    def extract(batches):
        for b in batches:
            rows = list(features(b.column("text").to_pylist(), bits))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), b.column("label"),
                pa.array([i.astype("<i4").tobytes() for i, _ in rows], pa.binary()),
                pa.array([x.astype("<f4").tobytes() for _, x in rows], pa.binary())], ["doc_id", "label", "ids", "x"])

    def fit(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("label").to_numpy(), mix(table.column("doc_id").to_numpy().astype(np.uint64))))
        ids, x, y = (table.column(c).to_pylist() for c in ("ids", "x", "label"))
        w = ftrl([(np.frombuffer(ids[i], "<i4").astype(np.int64), np.frombuffer(x[i], "<f4").astype(np.float64), y[i])
                  for i in order.tolist()], bits)
        return pa.table({"w": pa.array([w.tobytes()], pa.binary())})

    rows = (d.where("text IS NOT NULL").join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
            .mapInArrow(frugal(extract), "doc_id long, label int, ids binary, x binary")
            .withColumn("sample", F.lit(0)).groupBy("sample").applyInArrow(fit, "w binary").collect())
    return np.frombuffer(rows[0]["w"], np.float32) if rows else np.zeros((1 << bits) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier)."""
    d = documents(docs, id_col, text_col)
    bits = (len(weights) - 1).bit_length() - 1
    shared = d.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = shared.value.astype(np.float64)
        for b in batches:
            s = [round(float(1 / (1 + np.exp(-np.clip(w[ids] @ x + w[-1], -35, 35)))), 9)
                 for ids, x in features(b.column("text").to_pylist(), bits)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    return d.mapInArrow(frugal(run), "doc_id long, score double")
