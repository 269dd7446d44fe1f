"""Exact duplicates by deterministic block naming (DataFrame functions only).

A text is cut into blocks of ``block_bytes`` bytes. Equal blocks get one
integer name: the distinct blocks are sorted within hash buckets and
numbered, so a name stands for one content and no other. Then adjacent
names are paired and the pairs named in the same way, level by level,
until each document has one name. Documents are equal when their length
and their last name are equal; nothing rests on a hash.

A block or pair that occurs once belongs to a document without a copy, so
it gets no name and its document leaves; each level joins what is left.

Defined results: null text counts as empty; empty texts are equal to each
other; texts of any length are read whole; rows that repeat a doc_id with
an equal text are copies of each other, of which one is kept; a null
doc_id is smaller than any other; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import checkpointed, documents, partitions


def normalised(text: Column) -> Column:
    """Lower-cases A-Z only. ASCII texts take the fast path of lower()."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase)))


def names(items: DataFrame, content: list[str], buckets: int) -> DataFrame:
    """An integer for each distinct content that occurs twice or more: its place in the
    sorted order of its hash bucket, times the number of buckets, plus the bucket."""
    repeated = (items.groupBy(*content).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                .withColumn("_bucket", F.pmod(F.xxhash64(*content), F.lit(buckets))))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*content))
    return repeated.select(*content, (place.cast("long") * buckets + F.col("_bucket")).alias("name"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_bytes: int = 1024) -> DataFrame:
    """One row per input row: doc_id, keep_id (largest doc_id of the equal texts), group_size,
    kept, text_sha256 (of the normalised text), n_bytes."""
    buckets = partitions(docs)
    d = documents(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).cast("binary").alias("bytes"))
    d = d.select("doc_id", "bytes", F.sha2("bytes", 256).alias("sha"), F.length("bytes").cast("long").alias("n_bytes"))
    d = d.withColumn("key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "sha"))
    width = F.greatest(F.ceil(F.col("n_bytes") / block_bytes), F.lit(1)).cast("long")
    blocks = (d.select("key", "n_bytes", "bytes", width.alias("width"), F.explode(F.sequence(F.lit(0).cast("long"), width - 1)).alias("i"))
              .select("key", "n_bytes", "width", "i", F.substring("bytes", (F.col("i") * block_bytes + 1).cast("int"), F.lit(block_bytes)).alias("block")))
    level = checkpointed(blocks.join(names(blocks, ["block"], buckets), "block").select("key", "n_bytes", "width", "i", "name"))

    done = level.where("width = 1").select("key", "n_bytes", "name")
    longest = level.agg(F.max("width")).first()[0] or 1
    span = 1
    while span < longest:
        span *= 2
        half = lambda parity: F.max(F.when(F.col("i") % 2 == parity, F.col("name")))
        pairs = (level.where("width > 1").groupBy("key", "n_bytes", "width", F.floor(F.col("i") / 2).alias("i"))
                 .agg(half(0).alias("left"), F.coalesce(half(1), F.lit(0)).alias("right")))
        # without a right half only at the end of an odd row of names
        pairs = pairs.where((F.col("left").isNotNull()) & ((F.col("right") > 0) | (2 * F.col("i") + 1 == F.col("width"))))
        level = checkpointed(pairs.join(names(pairs, ["left", "right"], buckets), ["left", "right"])
                             .select("key", "n_bytes", F.ceil(F.col("width") / 2).alias("width"), "i", "name"))
        done = done.unionByName(level.where("width = 1").select("key", "n_bytes", "name"))

    whole = done.select("key", F.concat_ws(":", "n_bytes", "name").alias("identity")).distinct()
    row = F.row_number().over(Window.partitionBy("key").orderBy("doc_id"))
    rows = (d.select("doc_id", "key", "sha", "n_bytes").join(whole, "key", "left")
            .select("doc_id", "sha", "n_bytes", F.coalesce("identity", "key").alias("identity"), row.alias("copy")))
    groups = rows.groupBy("identity").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return rows.join(groups, "identity").select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"), "n_bytes")


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256, CAST(strlen(t) AS BIGINT) AS n_bytes
FROM d
"""
