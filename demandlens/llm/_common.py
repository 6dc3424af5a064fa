"""Shared helpers of the training-data operators: scratch tables, word rules, Arrow rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# characters that separate words (fixed value of the contracts): space, TAB to CR
SEPARATORS = " \t\n\x0b\f\r"
SEPARATOR_RUN = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a scratch folder of its own. A cluster
    session without it is refused, since no machine-local folder would do.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    named = "file://" + tempfile.mkdtemp(prefix="demandlens-llm-")
    spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    A lost executor then costs a re-read, not a recomputation, and a plan that reads the
    result several times computes it once. ``files`` merges the parts of a table known to be
    small against its input (one row per source, say) into so many files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.coalesce(files) if files else df).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def squeezed(col: Column) -> Column:
    """The text without its word separators."""
    return F.translate(col, SEPARATORS, "")


def words(col: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; an empty array for a text without any."""
    parts = F.split(col, SEPARATOR_RUN)
    return F.filter(parts, lambda w: w != "")


def word_count(col: Column) -> Column:
    """Number of words, without building them one by one.

    Splitting leaves an empty first or last piece where the text begins or ends with a
    separator; an empty text splits into one empty piece.
    """
    trimmed = F.btrim(col, F.lit(SEPARATORS))
    return F.when(trimmed == "", F.lit(0)).otherwise(
        F.size(F.split(trimmed, SEPARATOR_RUN))).cast("long")


def byte_words(text: str | None) -> list[bytes]:
    """The same words in UTF-8; ``bytes.split`` separates at exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class Rows:
    """Collects output rows by column and hands them out as record batches of bounded size."""

    def __init__(self, schema: pa.Schema, most_rows: int = 4096, most_bytes: int = 8 << 20):
        self.schema, self.most_rows, self.most_bytes = schema, most_rows, most_bytes
        self._reset()

    def _reset(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.rows = self.bytes = 0

    def add(self, *values, weight: int = 0) -> None:
        for column, value in zip(self.columns, values, strict=True):
            column.append(value)
        self.rows += 1
        self.bytes += weight

    @property
    def full(self) -> bool:
        return self.rows >= self.most_rows or self.bytes >= self.most_bytes

    def take(self) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(self.columns, self.schema, strict=True)],
            schema=self.schema)
        self._reset()
        return batch

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield self.take()
