"""Small files next to Spark's tables, through the session's own file systems."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = at(spark, path)
    return bool(fs.exists(where))


def remove(spark: SparkSession, path: str) -> None:
    fs, where = at(spark, path)
    fs.delete(where, True)


def listed(spark: SparkSession, path: str) -> list:
    """Status of what lies in a folder; nothing for a folder that does not exist."""
    fs, where = at(spark, path)
    return list(fs.listStatus(where)) if fs.exists(where) else []


def read_json(spark: SparkSession, path: str):
    """The content of a small file, or None."""
    fs, where = at(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, content) -> None:
    """Create or replace a small file in one step: a complete new file takes its name."""
    folder, _, name = path.rpartition("/")
    fs, new = at(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    stream = fs.create(new, True)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()).rename(new, at(spark, path)[1], how)
