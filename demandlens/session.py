"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the platform; the library only reads its settings. The
helpers here set defaults only where a setting is still unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


# Settings recommended for a cluster run at large scale. The library never sets them on a
# cluster session; the platform or the job submitter does.
CLUSTER_CONF = {
    # AQE re-plans at runtime: coalesces small shuffle partitions, splits skewed join
    # partitions, and turns a sort-merge join into a broadcast one when a side is measured small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # start high and let AQE coalesce; ~100 TB of input reaches the first shuffle already
    # pre-aggregated, but the raw-table aggregations need many partitions to stay in memory
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    # broadcasts stay behind size checks: the static one uses plan estimates (for parquet the
    # compressed file size, which can understate the in-memory size), so it keeps Spark's
    # 10 MB default; the runtime one uses measured shuffle sizes and can be larger
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # a join on (material, store, date) may use sides dealt by (material, store): the windows'
    # partitioning carries through the lookups
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """A session in this process, with scratch folders of its own (tests, bench, tools)."""
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName("demandlens")
               .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="demandlens-ckpt-"))
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="demandlens-wh-"))
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
