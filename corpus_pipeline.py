"""The corpus pipeline: five operators over ``documents``, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm import bpe, mixing, pii, quality, simhash
from demandlens.llm._common import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: its smallest doc_id."""
    return simhash.keep_one(docs)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced; ``n_chars`` follows."""
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; those it takes no copy of go.

    A document of no words has no part in the mix and goes too.
    """
    return mixing.take(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of what they decode to."""
    path, pattern = bpe.default_vocabulary()
    made = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path, pattern)
    return made.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("simhash near-dedup", simhash_near_dedup),
          ("pii", redact_pii), ("mixing sources", mix_sources), ("byte-level bpe", byte_bpe)]

# near-copy groups, the mix and the encoding have no SQL form; tests hold the stages against
# brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
