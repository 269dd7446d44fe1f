"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, collocations, decontaminate, dualtree, exact, fm_dedup, jaccard, langid, pii, quality, rpforest, suffix_dedup, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.earlier_words(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode the ids, and digest both."""
    import public_tokenizers
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = bpe.encode(_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return bpe.decode(ids, ranks).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page is captured and rechecked; every recheck is resolved."""
    out = warc.resolve_revisits(warc.captures(_table(spark, sf_dir, "pages")))
    return out.withColumn("headers", warc.header_text("headers"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the labels of four fifths of the ids, score every text."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = lambda c="doc_id": langid.held_out(c, 5, 0)
    weights = quality.train(docs, labels.where(~out()))
    return quality.score(docs, weights).select(
        "doc_id", out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it contains, with what was found."""
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.count(F.lit(1)).alias("n_segments"), F.max("n_hits").alias("most_hits"), F.min("edits").alias("least_edits"),
        F.min("region_start").alias("region_start"), F.max("region_end").alias("region_end"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans; the counts are those of all spans, base and added."""
    def digest(batches):
        for pdf in batches:
            flat = lambda rows: [(r["kind"], r["start"], r["end"]) for r in rows]
            base, found = [flat(r) for r in pdf["base"]], [flat(r) for r in pdf["found"]]
            out = {"doc_id": pdf["doc_id"].astype("Int64")}
            for k in pii.KINDS:
                out[f"n_{k}"] = [sum(x[0] == k for x in f) for f in found]
            out["base_sha256"] = [hashlib.sha256(pii.joined_spans(b).encode()).hexdigest() for b in base]
            out["spans"] = [pii.joined_spans(f) for f in found]
            out["n_base"] = [len(b) for b in base]
            yield pd.DataFrame(out)

    return pii.find_pii(_table(spark, sf_dir, "documents")).mapInPandas(
        digest, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_base long")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(_table(spark, sf_dir, "documents"), n=3, num=90, den=100)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dualtree.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rpforest.near_duplicates(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_substring_dedup, op3_byte_bpe, op4_warc_revisits, op5_quality_classifier, op6_decontamination, op7_exact_dedup,
                                   op8_pii, op9_language_id, op10_ngram_jaccard, op11_ranked_search, op12_collocations, op13_embedding_dedup)}
ORACLES = {"op4_warc_revisits": warc.ORACLE, "op7_exact_dedup": exact.ORACLE, "op11_ranked_search": dualtree.ORACLE, "op12_collocations": collocations.ORACLE,
           "op13_embedding_dedup": rpforest.ORACLE}
