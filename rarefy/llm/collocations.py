"""Phrase collocation mining with HAT-trie counts.

Texts are cut into pieces and words; phrases lie within one piece. Counts are
per language, over all occurrences in all documents.

1. Words are counted as strings and get a 64-bit id (two words with one id are
   found out and raise an error).
2. Two-word phrases, then three-word phrases, are counted level by level: a
   phrase can only be frequent where its parts are. A Bloom filter of the
   frequent parts (``filter_bits`` bits, whatever the corpus) keeps most others
   out; what it lets through is counted exactly and dropped after the merge.
3. Each task counts in a HAT-trie per language and gives whole subtrees as
   sorted runs where its memory is short, and at its end. The runs of a prefix
   partition (first two words) are merged in one task; partitions are sized by
   the corpus, and equal phrases of a task are one entry, so a phrase that
   holds a third of all words is one row per task.
4. Scores, the drop rule and the first ``top`` of each language are Spark SQL
   with decimals of 38 digits.

Defined results: null lang counts as ``und``; null and empty texts have no
words; repeated rows count as often as they occur; equal scores and counts are
ordered by the phrase's UTF-8 bytes; texts are read whole (words are taken from
pieces of a million characters at least); further columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import _LOWER, byte_values, checkpointed, frugal, frugal_group, prepared, slices, span_hashes, written
from .hattrie import HatTrie, gram_hash, summed

_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 9]] = True


def words(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts together: the lower-cased bytes, each word's start and end, id and the number of its
    piece. Null counts as empty; a piece never goes beyond its text."""
    raw = b"".join(t.encode("utf-8") + b"\n" for t in texts if t)
    buf = _LOWER[np.frombuffer(raw, dtype=np.uint8)]
    inside = ~_GAP[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    piece = np.searchsorted(np.flatnonzero(_BREAK[buf]), starts)
    return buf, starts, ends, span_hashes(byte_values(buf), starts, ends), piece


def _by_lang(batch: pa.RecordBatch):
    """(lang, texts) of a batch, texts with at most a million characters together (or one longer text)."""
    held: dict[str, list[str]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        if text:
            held.setdefault(lang, []).append(text)
    for lang, texts in held.items():
        for lo, hi in slices(texts):
            yield lang, texts[lo:hi]


def _language(lang: str) -> np.uint64:
    raw = np.frombuffer(lang.encode("utf-8"), dtype=np.uint8)
    return span_hashes(byte_values(raw), np.array([0]), np.array([len(raw)]))[0] if len(raw) else np.uint64(0)


def _slots(lang: str, grams: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of each phrase in the filter."""
    h = gram_hash(np.column_stack([np.full(len(grams), _language(lang)), grams]))
    return np.stack([h >> np.uint64(33), h & np.uint64(0xFFFFFFFF)]) % np.uint64(bits)


def bloom(frequent: DataFrame, ids: list[str], bits: int) -> np.ndarray:
    """Bits of the frequent phrases (lang, ids...), one bit in eight of a byte: ``bits`` / 8 bytes on the driver."""
    page = 1 << 16

    def slots(batches):
        for b in batches:
            lang = np.array(b.column("lang").to_pylist(), dtype=object)
            grams = np.column_stack([b.column(c).to_numpy().view(np.uint64) for c in ids]) if len(lang) else np.zeros((0, 1), np.uint64)
            for x in set(lang.tolist()):
                at = np.unique(_slots(x, grams[lang == x], bits))
                yield pa.RecordBatch.from_arrays([pa.array((at // page).astype(np.int32)), pa.array((at % page).astype(np.int32))], ["page", "bit"])

    def paged(table: pa.Table) -> pa.Table:
        byte = np.zeros(page, dtype=np.uint8)
        byte[table.column("bit").to_numpy()] = 1
        return pa.table({"page": table.column("page").slice(0, 1), "body": pa.array([np.packbits(byte).tobytes()], pa.binary())})

    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in (frequent.mapInArrow(frugal(slots), "page int, bit int").distinct()
              .groupBy("page").applyInArrow(frugal_group(paged), "page int, body binary").toLocalIterator()):
        out[r["page"] * page // 8:(r["page"] + 1) * page // 8] = np.frombuffer(r["body"], np.uint8)
    return out


def _holds(filter_: np.ndarray, lang: str, grams: np.ndarray) -> np.ndarray:
    a, b = _slots(lang, grams, 8 * len(filter_))
    bit = lambda at: (filter_[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1
    return (bit(a) & bit(b)).astype(bool)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, id, word, f of all words."""
    def counted(batches):
        for batch in batches:
            for lang, texts in _by_lang(batch):
                buf, starts, ends, ids, _ = words(texts)
                if not len(ids):
                    continue
                each, first, n = np.unique(ids, return_index=True, return_counts=True)
                raw = buf.tobytes()
                found = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(each)), pa.array(each.view(np.int64)),
                                                  pa.array(found, pa.binary()), pa.array(n.astype(np.int64))], ["lang", "id", "word", "f"])

    each = docs.mapInArrow(frugal(counted), "lang string, id long, word binary, f long")
    return written(each.groupBy("lang", "id").agg(F.sum("f").alias("f"), F.min("word").alias("word"), F.max("word").alias("_other")))


def phrase_counts(docs: DataFrame, width: int, filter_, partitions: int, least: int, limit: int, burst: int) -> DataFrame:
    """lang, w1..w``width``, f of the phrases that occur ``least`` times or more.
    ``filter_`` is the broadcast filter of the frequent parts, one word shorter."""
    names = [f"w{i + 1}" for i in range(width)]

    def runs(batches):
        tries: dict[str, HatTrie] = {}

        def rows(lang, found):
            for grams, counts in found:
                to = (gram_hash(grams[:, :2]) >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)
                order = np.argsort(to, kind="stable")  # within a partition the run stays sorted
                cut = np.searchsorted(to[order], np.arange(partitions + 1, dtype=np.uint64))
                out = [(i, grams[order[a:b]].T.tobytes(), counts[order[a:b]].astype("<i4").tobytes())
                       for i, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(out)), *[pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))]],
                                                 ["lang", "part", "grams", "counts"])

        for batch in batches:
            for lang, texts in _by_lang(batch):
                _, _, _, ids, piece = words(texts)
                if len(ids) < width:
                    continue
                parts = np.column_stack([ids[i:len(ids) - width + 2 + i] for i in range(width - 1)])
                known = _holds(filter_.value, lang, parts)
                keep = (piece[width - 1:] == piece[:len(piece) - width + 1]) & known[:-1] & known[1:]
                at = np.flatnonzero(keep)
                if lang not in tries:
                    tries[lang] = HatTrie(width, burst, limit)
                yield from rows(lang, tries[lang].add(np.column_stack([ids[at + i] for i in range(width)])))
                if sum(t.root.rows for t in tries.values()) > limit:
                    for x, t in tries.items():
                        yield from rows(x, t.spill(t.root.rows // 2))
        for lang, t in tries.items():
            yield from rows(lang, t.drain())

    def merged(table: pa.Table) -> pa.Table:
        grams = np.concatenate([np.frombuffer(g.as_py(), "<u8").reshape(width, -1).T for g in table.column("grams")])
        counts = np.concatenate([np.frombuffer(c.as_py(), "<i4") for c in table.column("counts")]).astype(np.int64)
        grams, counts = summed(grams, counts)
        keep = counts >= least
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * int(keep.sum()), pa.string()),
                         **{c: grams[keep, i].copy().view(np.int64) for i, c in enumerate(names)}, "f": counts[keep]})

    return written(docs.mapInArrow(frugal(runs), "lang string, part int, grams binary, counts binary")
                   .groupBy("lang", "part").applyInArrow(frugal_group(merged), f"lang string, {', '.join(f'{c} long' for c in names)}, f long"))


def collocations(docs: DataFrame, least: int = 10, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
                 part_grams: int = 1_000_000, filter_bits: int = 1 << 26, limit: int = 2_000_000, burst: int = 1 << 15) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases of two or three words."""
    spark = prepared(docs.sparkSession)
    d = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    uni = word_counts(d)
    clash = uni.where("word <> _other").first()
    if clash:
        raise ValueError(f"the words {bytes(clash['word'])!r} and {bytes(clash['_other'])!r} have one id")
    totals = checkpointed(uni.groupBy("lang").agg(F.sum("f").alias("n")))
    partitions = max(1, -(-(totals.agg(F.sum("n")).first()[0] or 0) // part_grams))
    shared = lambda df, ids: spark.sparkContext.broadcast(bloom(df, ids, filter_bits))
    count: Callable = lambda width, filter_: phrase_counts(d, width, filter_, partitions, least, limit, burst)
    bi = count(2, shared(uni.where(F.col("f") >= least).select("lang", "id"), ["id"]))
    tri = count(3, shared(bi.select("lang", "w1", "w2"), ["w1", "w2"]))

    word = lambda c, f: uni.where(F.col("f") >= least).select("lang", F.col("id").alias(c), F.col("f").alias(f))
    pair = lambda a, b, f: bi.select("lang", F.col("w1").alias(a), F.col("w2").alias(b), F.col("f").alias(f))
    longer = (tri.select("lang", "w1", "w2", "f").unionByName(tri.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "f"))
              .groupBy("lang", "w1", "w2").agg(F.max("f").alias("most")))
    twos = (bi.join(longer, ["lang", "w1", "w2"], "left").where("most IS NULL OR 100 * most < 50 * f")
            .join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
            .select("lang", "w1", "w2", F.lit(None).cast("long").alias("w3"), F.col("f").alias("a"), "l", "r", _score("f", "l", "r").alias("score")))
    cut = lambda k: F.struct(_score("f", f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
    threes = (tri.join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"])
              .join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
              .withColumn("best", F.least(cut(1), cut(2)))  # the lowest score, then the smallest k
              .select("lang", "w1", "w2", "w3", F.col("f").alias("a"), "best.l", "best.r", "best.score"))
    # words are looked up for those that can come first: with their ties, whose order needs the words.
    # First of 16 parts of a language each, so that what a language's task reads is bounded by ``top``
    found = twos.unionByName(threes).withColumn("_part", F.pmod(F.xxhash64("w1", "w2", "w3"), F.lit(16)))
    for keys in (["lang", "_part"], ["lang"]):
        first = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"))
        found = found.withColumn("_place", F.rank().over(first)).where(F.col("_place") <= top)
    for c in ("w1", "w2", "w3"):
        names = uni.select("lang", F.col("id").alias(c), F.decode("word", "UTF-8").alias(f"{c}_word"))
        found = found.join(names, ["lang", c], "left")
    found = found.withColumn("phrase", F.concat_ws(" ", "w1_word", "w2_word", "w3_word"))
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _score(a: str, l: str, r: str):  # noqa: E741
    """floor(1000000 * a * a / (l * r)) in decimals; counts below 10**15."""
    x = lambda c: F.col(c).cast("decimal(15,0)")
    return F.call_function("div", x(a) * x(a) * F.lit(1_000_000).cast("decimal(7,0)"), x(l) * x(r))


def _gram(k: int) -> str:
    """All phrases of k words of a piece."""
    return f"SELECT lang, {k} AS k, unnest([array_to_string(ws[i:i + {k - 1}], ' ') FOR i IN range(1, len(ws) - {k - 2})]) AS g FROM p WHERE len(ws) >= {k}"


#: the same by DuckDB
ORACLE = f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
q AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM q),
g AS ({' UNION ALL '.join(_gram(k) for k in (1, 2, 3))}),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS ws FROM f WHERE k > 1 AND f >= 10),
cuts AS (SELECT lang, k, g, a, ws, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT x.lang, x.k, x.g, x.a, cut, u.f AS l, v.f AS r, CAST(1000000::HUGEINT * x.a * x.a // (u.f::HUGEINT * v.f) AS BIGINT) AS score
      FROM cuts x JOIN f u ON u.lang = x.lang AND u.g = array_to_string(ws[1:cut], ' ') AND u.k = cut
                  JOIN f v ON v.lang = x.lang AND v.g = array_to_string(ws[cut + 1:], ' ') AND v.k = x.k - cut),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, k, g ORDER BY score, cut) = 1),
inside AS (SELECT lang, g, max(a) AS most FROM (SELECT lang, array_to_string(ws[1:2], ' ') AS g, a FROM c WHERE k = 3
           UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN inside i ON b.lang = i.lang AND b.g = i.g AND b.k = 2 WHERE i.most IS NULL OR 100 * i.most < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM kept)
SELECT r.lang, rank, g AS phrase, a, l, r.r AS r, n, score FROM ranked r JOIN t ON r.lang = t.lang WHERE rank <= 2000
"""
