"""Exact top-k by inner product over a bit-sliced index.

Rows are cut into blocks. A block's index holds, per attribute (vector component), one bitmap
per bit of ``value - smallest value``, without the ``DROPPED`` lowest bits (the quantised
attribute), beside the exact values.

A query adds the slices with bitmap arithmetic only: the bits of its weight shift a slice, a
negative weight takes the complement, and carry-save adders reduce the slices of each place
value until one per place is left. These are the slices of the rows' quantised scores. Top
rows are then selected from the most significant slice downward, which gives the k-th largest
quantised score. What the dropped bits can add is bounded by the query's weights; rows within
that bound of the k-th score are the boundary, found by one more descent, and are resolved by
their exact scores. The answer is exact for any data.

Blocks of the index meet blocks of the query set as keyed cells, so a task holds one block of
each. Each cell returns k rows a query; a window per query merges them.

Defined cases: vectors that are null or hold null or non-finite components take no part, as
query or candidate. Shorter vectors count as padded with zeros. Rows that have the query's id
are not its candidates. Repeated rows are candidates each; repeated query rows (id and
vector) count once. Ties go to the smaller id, then in any order (such rows are equal). Null ids take no
part. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.llm._common import table, written

SCALE = 256
EVERY = 50                       # queries: ids divisible by this
TOP = 5
BLOCK_ROWS = 16384
BLOCK_QUERIES = 256
DROPPED = 2


def quantised(vectors: DataFrame) -> DataFrame:
    """``(vec_id, x)``: ``floor(256 * component)`` of the vectors that take part."""
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c)
                    & (F.abs(c) < F.lit(float("inf"))))
    return (vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(
                "embedding", lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double"))
                .cast("long")).alias("x")))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


class BlockIndex:
    """Bitmaps of one block: ``slices[d]`` has the kept bits of attribute d, low to high."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, dropped: int = DROPPED):
        self.ids, self.values, self.dropped = ids, values, dropped
        n = len(ids)
        self.words = (n + 63) // 64
        self.floor = values.min(axis=0)
        kept = (values - self.floor) >> dropped
        self.bits = [int(m).bit_length() for m in kept.max(axis=0)]
        self.slices = []
        for d, bits in enumerate(self.bits):
            raw = np.zeros((bits, self.words * 64), np.uint8)
            for j in range(bits):
                raw[j, :n] = kept[:, d] >> j & 1
            self.slices.append(np.packbits(raw, axis=1, bitorder="little").view(np.uint64))
        self.live = self._map(np.ones(n, bool))

    def _map(self, flags: np.ndarray) -> np.ndarray:
        wide = np.zeros(self.words * 64, bool)
        wide[:len(flags)] = flags
        return np.packbits(wide, bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, low to high, of ``sum |w| * (kept or its complement)``."""
        places: dict[int, list[np.ndarray]] = {}
        for d, weight in enumerate(query.tolist()):
            own, size = self.slices[d], abs(weight)
            if not size or not len(own):
                continue
            own = ~own if weight < 0 else own
            k = 0
            while size >> k:
                if size >> k & 1:
                    for j in range(len(own)):
                        places.setdefault(k + j, []).append(own[j:j + 1])
                k += 1
        out, p = [], 0
        top = max(places, default=-1)
        while p <= top:
            column = places.pop(p, [])
            if not column:
                out.append(np.zeros(self.words, np.uint64))
                p += 1
                continue
            stack = np.concatenate(column)
            carried = []
            while len(stack) > 1:
                thirds = len(stack) // 3
                if thirds:
                    a, b, c = (stack[i * thirds:(i + 1) * thirds] for i in range(3))
                    half = a ^ b
                    carry = a & b
                    carry |= half & c
                    half ^= c
                    stack = np.concatenate((half, stack[3 * thirds:]))
                else:
                    carry = stack[:1] & stack[1:]
                    stack = stack[:1] ^ stack[1:]
                carried.append(carry)
            out.append(stack[0])
            if carried:
                places.setdefault(p + 1, []).extend(carried)
                top = max(top, p + 1)
            p += 1
        return out

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows, best first."""
        width = self.values.shape[1]
        weights = np.zeros(width, np.int64)
        weights[:min(width, len(query))] = query[:width]
        live = self.live
        own = self.ids == query_id
        if own.any():
            live = live & ~self._map(own)
        slices = self.scores(weights)
        if int(np.bitwise_count(live).sum()) > k:
            # descend: sure rows, and rows still equal to the k-th score's leading bits
            sure, even, kth = np.zeros_like(live), live, 0
            for p in range(len(slices) - 1, -1, -1):
                ones = even & slices[p]
                if int(np.bitwise_count(sure | ones).sum()) >= k:
                    even = ones
                    kth |= 1 << p
                else:
                    sure, even = sure | ones, even & ~slices[p]
            # the dropped bits add up to this much of a kept unit
            loose = int(np.abs(weights).sum()) * ((1 << self.dropped) - 1) >> self.dropped
            live = self._at_least(slices, live, kth - loose - 1)
        rows = np.flatnonzero(np.unpackbits(live.view(np.uint8), bitorder="little"))
        exact = self.values[rows] @ weights
        order = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows[order]], exact[order]

    def _at_least(self, slices: list[np.ndarray], live: np.ndarray, least: int) -> np.ndarray:
        if least <= 0:
            return live
        above, even = np.zeros_like(live), live
        for p in range(len(slices) - 1, -1, -1):
            if least >> p & 1:
                even = even & slices[p]
            else:
                above, even = above | (even & slices[p]), even & ~slices[p]
        return above | even


RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, block_rows: int = BLOCK_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; both inputs are ``(vec_id, x array<long>)``."""
    # rows are dealt to blocks once and kept, so that a task run again meets the same blocks
    held = written(vectors.select("vec_id", "x", F.rand(11).alias("deal")), "bits-rows")
    asked = written(queries.select("vec_id", "x").distinct().withColumn("deal", F.rand(12)),
                    "bits-queries")
    blocks = max(1, math.ceil(held.count() / block_rows))
    chunks = max(1, math.ceil(asked.count() / block_queries))

    def cells(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.select("vec_id", "x", F.floor(F.col("deal") * n).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    def answer(rows: pa.Table, questions: pa.Table) -> pa.Table:
        if not rows.num_rows or not questions.num_rows:
            return RESULT.empty_table()
        index = BlockIndex(rows.column("vec_id").to_numpy(), _matrix(rows.column("x")))
        found = []
        for query_id, query in zip(questions.column("vec_id").to_pylist(),
                                   questions.column("x").to_pylist()):
            ids, scores = index.top(query_id, np.array(query, np.int64), k)
            found.append((np.full(len(ids), query_id, np.int64), ids, scores))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], schema=RESULT)

    left = cells(held, "block", blocks, "chunk", chunks).groupBy("block", "chunk")
    right = cells(asked, "chunk", chunks, "block", blocks).groupBy("block", "chunk")
    merged = left.cogroup(right).applyInArrow(answer, "query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (merged.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op8_bitsliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 of every query over all embeddings."""
    rows = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where(F.col("vec_id") % EVERY == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, [floor(256 * c::DOUBLE) for c in embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([c for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
  FROM v AS q, v WHERE q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
