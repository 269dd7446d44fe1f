"""A corpus pipeline over ``documents``: language ID, exact dedup, near-duplicate
removal, benchmark decontamination, tokenization.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the cluster's shared folder and read again as the next stage's
``docs``. All but the last return the columns of documents.

Defined results, for every stage: null and empty texts are handled as the stage's
operator states; further columns pass through all but the last; an empty table gives
an empty result.
"""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rarefy.llm import bpe, decontaminate, exact, jaccard, langid
from rarefy.llm.common import written

#: least share of the best language; texts below it mix languages or have too few letters to tell
LEAST_SCORE = 0.4
TOKENIZER = "byte_bpe_multi_50k.tiktoken"


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``docs`` has it."""
    taken, out = {c.lower() for c in docs.columns}, []
    for n in names:
        while n in taken:
            n = f"_{n}"
        out.append(n)
    return out


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with LEAST_SCORE or more stay. Texts without a letter go."""
    fields = [f"`{c}`" for c in docs.columns]
    lang, score = _free(docs, "lang_pred", "score")
    told = langid.predict(docs, langid.train(docs), keep=tuple(c for c in docs.columns if c != "doc_id"), names=(lang, score))
    return told.where((F.col(lang) != "und") & (F.col(score) >= LEAST_SCORE)).select(*fields)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the document with the largest doc_id stays; of rows that
    repeat it, one. A row without doc_id stays."""
    found = written(exact.exact_duplicates(docs).where("NOT kept AND doc_id IS NOT NULL").select("doc_id", "keep_id", "text_sha256"))
    digest, gone_id, gone_text = _free(docs, "digest", "gone", "gone_text")
    gone = found.where("doc_id <> keep_id").select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_text))
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    named = docs.withColumn(digest, F.sha2(lowered, 256))
    left = named.join(gone, (named["doc_id"] == gone[gone_id]) & (named[digest] == gone[gone_text]), "left_anti")
    if not found.where("doc_id = keep_id").isEmpty():
        left = left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", digest]).unionByName(left.where("doc_id IS NULL"))
    return left.drop(digest)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a Jaccard similarity of 0.8 or more on five-word
    shingles, the one with the smallest doc_id stays. A row without doc_id stays."""
    gone_id, gone_row = _free(docs, "gone", "gone_row")
    gone = (jaccard.jaccard_join(docs, n=5, num=80, den=100, keep_row=True).where("component_id <> doc_id")
            .select(F.col("doc_id").alias(gone_id), F.col("row").alias(gone_row)))
    row = jaccard.row_hash(docs["doc_id"], docs["text"])
    return docs.join(gone, (docs["doc_id"] == gone[gone_id]) & (row == gone[gone_row]), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a passage of the benchmark go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, and whether decoding the ids gives the text again."""
    ranks = bpe.read_ranks(public_tokenizers.path(TOKENIZER))
    out = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, keep_sha=True), ranks)
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"))


STAGES = [("language ID", language_id), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("benchmark decontamination", decontamination), ("byte-level BPE", tokenize)]

#: hyperdimensional profiles and banded alignment have no SQL; the pipeline is tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
