"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. The n-gram abc is the
product (binding) of a's vector permuted twice, b's permuted once and
c's; a text is the sum (bundle) of its n-grams, and so is a language.
Texts are compared with the language prototypes by cosine.

A bundle is linear in the counts, so the training pass only sums counts
of n-grams per language in Spark; their number is bounded by
ALPHABET ** 3 per language. Prototypes are bundled from those counts.

Defined results: a null text or one without a letter gets ``und`` and
score 0; rows with null lang are not learned from; without any training
row every text gets ``und``; texts are read whole; repeated rows count as
often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import frugal, frugal_group, mix, prepared, slices

#: letter codes: 0 for a gap, a-z, and hashed classes for all other letters
ALPHABET = 64
DIMENSION = 1024
#: languages a model may have
MAX_LANGUAGES = 512


def _table() -> np.ndarray:
    """Code of each code point of the first plane: 0 where it is no letter."""
    out = np.zeros(1 << 16, dtype=np.uint8)
    for cp in range(1 << 16):
        c = chr(cp)
        if 0xD800 <= cp < 0xE000 or not c.isalpha():
            continue
        low = c.lower()[:1]
        out[cp] = ord(low) - 96 if "a" <= low <= "z" else 27 + (ord(low) * 2654435761 >> 7) % (ALPHABET - 27)
    return out


_CODES: list[np.ndarray] = []


def letters(texts) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes of all texts with a gap after each, and each text's offset."""
    if not _CODES:
        _CODES.append(_table())
    texts = [(t or "") + " " for t in texts]
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    cps = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = _CODES[0][np.minimum(cps, 0xFFFF)]
    for i in np.flatnonzero(cps > 0xFFFF).tolist():
        codes[i] = 27 + int(cps[i]) % (ALPHABET - 27) if unicodedata.category(chr(cps[i]))[0] == "L" else 0
    return codes, offsets


def trigrams(codes: np.ndarray) -> np.ndarray:
    """Number of the n-gram that ends at each place; n-grams with a gap in the
    middle, and the first two places, get 0, which no vector stands for."""
    c = codes.astype(np.int32)
    out = np.zeros(len(c), dtype=np.int32)
    if len(c) > 2:
        a, b, d = c[:-2], c[1:-1], c[2:]
        gram = (a * ALPHABET + b) * ALPHABET + d
        gram[b == 0] = 0
        out[2:] = gram
    return out


def counts(texts):
    """For each text, the numbers of its n-grams and how often each occurs."""
    for lo, hi in slices(texts):
        part = [" " + t if t else t for t in texts[lo:hi]]
        codes, offsets = letters(part)
        grams = trigrams(codes)
        for i in range(hi - lo):
            own = grams[offsets[i]:offsets[i + 1]]
            if len(own) < 30_000:
                ids, k = np.unique(own, return_counts=True)
            else:
                n = np.bincount(own)
                ids = np.flatnonzero(n)
                k = n[ids]
            if len(ids) and ids[0] == 0:
                ids, k = ids[1:], k[1:]
            yield ids, k, bool(codes[offsets[i]:offsets[i + 1]].any())


def letter_vectors(dimension: int = DIMENSION, seed: int = 1) -> np.ndarray:
    """One vector of +1 and -1 per letter code, the same on every machine."""
    n = ALPHABET * dimension
    bits = mix(np.arange(n, dtype=np.uint64) + np.uint64(seed) * np.uint64(1 << 32)) >> np.uint64(63)
    return (bits.astype(np.int8) * 2 - 1).reshape(ALPHABET, dimension)


class Binder:
    """Vectors of n-grams; a permutation is a rotation."""

    def __init__(self, dimension: int = DIMENSION, seed: int = 1):
        v = letter_vectors(dimension, seed)
        self.pairs = (np.roll(v, 2, axis=1)[:, None, :] * np.roll(v, 1, axis=1)[None, :, :]).reshape(-1, dimension)
        self.last = v
        self.dimension = dimension

    def vectors(self, ids: np.ndarray) -> np.ndarray:
        return self.pairs[ids // ALPHABET] * self.last[ids % ALPHABET]

    def bundle(self, ids: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.dimension, dtype=np.float32)
        for lo in range(0, len(ids), 4096):
            out += weights[lo:lo + 4096].astype(np.float32) @ self.vectors(ids[lo:lo + 4096]).astype(np.float32)
        return out


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang",
          dimension: int = DIMENSION, seed: int = 1) -> tuple[list[str], np.ndarray]:
    """(languages, unit prototypes). Counts of n-grams per language are summed in
    Spark over all rows and bundled there, a language (ALPHABET ** 3 counts at most) in a task; one
    prototype a language reaches the driver, after their number has been checked. The mean of the
    prototypes, which all share, is taken off."""
    prepared(rows.sparkSession)
    d = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang IS NOT NULL")

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs = b.column(1).to_pylist()
            for lang, (ids, n, _) in zip(langs, counts(b.column(0).to_pylist())):
                if lang not in total:
                    total[lang] = np.zeros(ALPHABET ** 3, dtype=np.int64)
                total[lang][ids] += n
        for lang, n in total.items():
            ids = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids), pa.string()), pa.array(ids.astype(np.int32), pa.int32()),
                                              pa.array(n[ids], pa.int64())], ["lang", "gram", "n"])

    def bundled(table: pa.Table) -> pa.Table:
        """A language's prototype from its counts."""
        table = table.sort_by("gram")
        n = table.column("n").to_numpy().astype(np.float64)
        vector = Binder(dimension, seed).bundle(table.column("gram").to_numpy(), n / np.sqrt((n ** 2).sum()))
        return pa.table({"lang": table.column("lang").slice(0, 1), "vector": pa.array([vector.astype("<f4").tobytes()], pa.binary())})

    if d.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"a model has at most {MAX_LANGUAGES} languages")
    summed = d.mapInArrow(frugal(run), "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    found = {r["lang"]: r["vector"] for r in summed.groupBy("lang").applyInArrow(frugal_group(bundled), "lang string, vector binary").collect()}
    names = sorted(found)
    out = np.zeros((len(names), dimension), dtype=np.float32)
    for i, lang in enumerate(names):
        out[i] = np.frombuffer(found[lang], "<f4")
    if len(names) > 1:
        out -= out.mean(axis=0)
    norm = np.sqrt((out ** 2).sum(axis=1, keepdims=True))
    return names, out / np.where(norm > 0, norm, 1)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text",
            keep: tuple[str, ...] = (), names: tuple[str, str] = ("lang_pred", "score"), dimension: int = DIMENSION,
            seed: int = 1) -> DataFrame:
    """doc_id, the columns named in ``keep``, and the prediction and its score under ``names``. The score is the share of
    the best language in exp(20 x cosine) over all languages, so between 0 and 1."""
    prepared(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"),
                    *[F.col(f"`{k}`") for k in keep])

    def run(batches):
        langs_known, prototypes = shared.value
        binder = Binder(dimension, seed)
        for b in batches:
            langs, scores = [], []
            for ids, n, lettered in counts(b.column(1).to_pylist()):
                if not lettered or not langs_known or not len(ids):
                    langs.append("und")
                    scores.append(0.0)
                    continue
                v = binder.bundle(ids, n)
                cos = prototypes @ (v / max(float(np.sqrt((v ** 2).sum())), 1e-12))
                best = int(np.argmax(cos))
                langs.append(langs_known[best])
                scores.append(round(float(1 / np.exp(20 * (cos - cos[best])).sum()), 6))
            rest = [c for i, c in enumerate(b.columns) if i != 1]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             ["doc_id", *keep, *names])

    kept = "".join(f", `{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return d.mapInArrow(frugal(run), f"doc_id long{kept}, `{names[0]}` string, `{names[1]}` double")


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1):
    """crc32 of the id as text, modulo ``parts``, is ``part`` (false for a null id)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))
