"""Two-pass external shuffle into shards.

Pass one scatters records by seeded hashes: the shard is the one whose hash with the doc_id
is largest (rendezvous hashing), the bucket within the shard comes from another hash. Buckets
are sized to fit a task's memory many times over (``bucket_bytes``). Pass two gathers one
bucket at a time, puts it in a fixed order, runs a Fisher-Yates shuffle over it (Spark's
``shuffle``), and writes it under ``shard=<n>``.

Law ``key``: a row's shard depends on its doc_id and the number of shards alone. With one more
shard a row either stays or moves into the new one.

Defined cases: a null text has size 8 and the checksum of an empty text; rows with a null
doc_id all go to one shard, which their hash names; rows that repeat a doc_id share its shard
but are spread over its buckets. An empty table writes no files and reads back empty. Columns
of the input that have the name of a result column are not kept; others are written too.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.llm._common import scratch_path, table, text_or_empty, written

SHARDS = 24
SEED = 4
BUCKET_BYTES = 2 << 20
ADDED = ("size", "shard", "bucket", "place")


def shard_weight(shard: Column, seed: int = SEED, key: str = "doc_id") -> Column:
    """The hash with which a shard bids for a row."""
    return F.xxhash64(F.lit(seed), F.col(key).cast("long"), shard.cast("int"))


def shard_of(shards: int, seed: int = SEED) -> tuple[Column, Column]:
    """The shard of a row, and its bid."""
    bids = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                       lambda s: F.struct(shard_weight(s, seed).alias("bid"), (-s).alias("s")))
    best = F.array_max(bids)
    return -best["s"], best["bid"]


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Shuffle ``docs`` into ``shards`` under ``path``; returns the table of buckets.

    The files hold the input's columns with ``size``, ``bucket`` and ``place`` (the position
    in the bucket), in order of bucket and place. The returned ``(shard, bucket, n, before)``
    gives each bucket's first slot.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(*kept, (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long")
                       .alias("size"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    buckets = max(4, math.ceil(total / shards / bucket_bytes))
    shard, _ = shard_of(shards, seed)
    # the order number spreads rows that repeat an id, and orders the bucket
    order = F.xxhash64(F.lit(seed + 1), F.col("doc_id"), F.monotonically_increasing_id())
    dealt = (rows.withColumn("shard", shard.cast("int")).withColumn("_order", order)
             .withColumn("bucket", F.pmod("_order", F.lit(buckets)).cast("int")))
    parts = max(12, shards * buckets // 2)
    gathered = (dealt.repartition(parts, "shard", "bucket").groupBy("shard", "bucket")
                .agg(F.sort_array(F.collect_list(F.struct(
                    F.col("_order"), F.struct(*kept, "size").alias("row")))).alias("rows")))
    mixed = gathered.select("shard", "bucket", F.posexplode(
        F.shuffle("rows", F.lit(seed + 2))).alias("place", "held"))
    (mixed.select("shard", "held.row.*", "bucket", "place")
     .sortWithinPartitions("shard", "bucket", "place").write.partitionBy("shard").parquet(path))
    stored = read_shards(docs.sparkSession, path, mixed.select(
        "held.row.*", "bucket", "place", "shard"))
    counted = stored.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")
                             .rowsBetween(Window.unboundedPreceding, -1))
    return counted.withColumn("before", F.coalesce(before, F.lit(0)))


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The records of the shards, columns as in ``like``."""
    return spark.read.schema(like.schema).parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, from the files written."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_path(spark, "shards")
    buckets = written(write_shards(docs, path), "shard-buckets", files=4)
    rows = spark.read.schema("doc_id long, text string, size long, bucket int, place int, shard int"
                             ).parquet(path)
    facts = rows.select("doc_id", "size", F.crc32(text_or_empty()).alias("text_crc32"), "shard",
                        "bucket", "place")
    _, bid = shard_of(SHARDS)
    grown = shard_weight(F.lit(SHARDS))
    return (facts.join(buckets, ["shard", "bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("before") + F.col("place")).cast("long").alias("slot"),
                    F.when(grown > bid, F.lit(SHARDS)).otherwise(F.col("shard"))
                    .alias("grown_shard")))
