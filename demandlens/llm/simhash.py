"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's fingerprint has one bit per bit of its shingles' XXH64. Two fingerprints link
when they differ in at most two of the 64 bits.

Candidates: the 64 bits are cut into three segments. Two errors leave at least one segment
whole, and the segment after it then has at most two errors. The perfect binary (23, 12)
Golay code gives every 23-bit word one nearest codeword; the *keys* of a segment are the
indices of the codewords next to it and next to each word one bit away. Words that differ in
two bits have a word between them that is one bit from both, so they share an index. A key of
a fingerprint is therefore (number and bits of the whole segment, one index of the next
segment), and linked fingerprints share at least one key. Fingerprints join on keys and each
pair is verified by its bit count.

Keys held by more than ``MOST_IN_KEY`` distinct fingerprints (large groups of near copies)
are not paired. Their fingerprints go through an exact linear way instead: each is keyed by
itself and by its 64 neighbours at distance one. Two fingerprints share such a key exactly
when they differ in at most two bits, so everything under one key links to its smallest
member, and no key has more than 65 members.

Links then form components by alternating large-star and small-star steps, all as Spark
joins and map-side combinable minima over distinct fingerprints; documents come in last.

Defined cases: a null text counts as empty; a text without words has fingerprint zero and
links like any other. Rows with equal fingerprints are one component whatever their ids. A
null doc_id never names a component unless the component has no other id (then null).
Repeated rows all come out. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.llm._common import Rows, byte_words, table, written

SHINGLE_WORDS = 3
MOST_BITS = 2                    # the keys are built for two
HASH_SEED = 42
SEGMENTS = ((42, 22), (21, 21), (0, 21))   # (lowest bit, bits) of the three segments
GENERATOR = 0b110001110101       # x^11+x^10+x^6+x^5+x^4+x^2+1 of the (23, 12) Golay code
MOST_IN_KEY = 32
OWN = "__simhash_fp"             # the only column name that a document may not have
ROUNDS = 60                      # bound on star rounds; their number grows with log(longest chain)


# ------------------------------------------------------------------------- fingerprints

def shingle_hashes(text: str | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased words, repeats included."""
    found = byte_words(text)
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if n < size:
        return np.array([digest(b" ".join(found).lower(), HASH_SEED)], np.uint64)
    joined = b" ".join(found).lower()
    lengths = np.fromiter(map(len, found), np.int64, n) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:n - size + 1].tolist()
    stops = (ends - 1)[size - 1:].tolist()
    return np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops)),
                       np.uint64, n - size + 1)


def fingerprint_of(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, as an unsigned integer."""
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 8192):
        part = hashes[k:k + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * counts > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(df: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint as a signed long."""
    source = df.select("doc_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = Rows(schema, most_rows=1 << 30)
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    fp = fingerprint_of(shingle_hashes(text, size))
                    out.add(doc, fp - (1 << 64) if fp >> 63 else fp)
            yield from out.rest()
    return source.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fp long")


# ---------------------------------------------------------------------------- Golay keys

def _remainders() -> np.ndarray:
    """Remainder modulo the generator of each single bit of a 23-bit word."""
    out = []
    for bit in range(23):
        value = 1 << bit
        for high in range(22, 10, -1):
            if value >> high & 1:
                value ^= GENERATOR << (high - 11)
        out.append(value)
    return np.array(out, np.int64)


class Golay:
    """Nearest codewords of the perfect (23, 12) code."""

    def __init__(self):
        self.remainder = _remainders()
        self.error = np.zeros(1 << 11, np.int64)
        single = [1 << i for i in range(23)]
        for i in range(23):
            self._note(single[i])
            for j in range(i):
                self._note(single[i] | single[j])
                for k in range(j):
                    self._note(single[i] | single[j] | single[k])

    def _note(self, pattern: int) -> None:
        self.error[self.syndrome(np.array([pattern], np.int64))[0]] = pattern

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros_like(words)
        for bit in range(23):
            out ^= np.where(words >> bit & 1, self.remainder[bit], 0)
        return out

    def index(self, words: np.ndarray) -> np.ndarray:
        """The 12 message bits of the nearest codeword."""
        return (words ^ self.error[self.syndrome(words)]) >> 11

    def keys(self, words: np.ndarray, bits: int) -> np.ndarray:
        """Indices next to each word and next to its neighbours: shape (words, 1 + bits)."""
        return np.stack([self.index(words), *(self.index(words ^ (1 << b))
                                              for b in range(bits))], axis=1)


def golay_keys(fps: DataFrame) -> DataFrame:
    """``(key, fp)`` for distinct fingerprints: about 18 keys each."""
    schema = pa.schema([("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Golay()
        for batch in batches:
            everything = batch.column(0).to_numpy(zero_copy_only=False)
            for k in range(0, len(everything), 8192):
                fp = everything[k:k + 8192]
                raw = fp.view(np.uint64)
                parts = [((raw >> np.uint64(low)) & np.uint64((1 << bits) - 1)).astype(np.int64)
                         for low, bits in SEGMENTS]
                for a in range(3):
                    b = (a + 1) % 3
                    near = np.sort(code.keys(parts[b], SEGMENTS[b][1]), axis=1)
                    fresh = np.ones(near.shape, bool)
                    fresh[:, 1:] = near[:, 1:] != near[:, :-1]
                    row, col = np.nonzero(fresh)
                    key = (np.int64(a) << 40) | (parts[a][row] << 12) | near[row, col]
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])],
                                                     schema=schema)
    return fps.select("fp").mapInArrow(run, "key long, fp long")


def links(fps: DataFrame, most_in_key: int = MOST_IN_KEY) -> DataFrame:
    """``(a, b)``, a > b: links that connect what is within two bits; ``fps`` are distinct."""
    keys = written(golay_keys(fps), "simhash-keys")
    held = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(keys.join(held, "key"), "simhash-shared")
    few = shared.where(F.col("n") <= most_in_key).select("key", "fp")
    x, y = few.alias("x"), few.alias("y")
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= MOST_BITS
    pairs = (x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") > F.col("y.fp")) & near)
             .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))
    many = shared.where(F.col("n") > most_in_key).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"),
                    *[F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long") for i in range(64)])
    middles = many.select("fp", F.explode(F.transform(
        flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("middle"))
    # at most 65 members each: linked through their middle to the smallest of them
    groups = (middles.groupBy("middle").agg(F.sort_array(F.collect_set("fp")).alias("g"))
              .where(F.size("g") > 1))
    stars = groups.select(F.explode(F.slice("g", F.lit(2), F.size("g") - 1)).alias("a"),
                          F.element_at("g", 1).alias("b"))
    return pairs.unionByName(stars).distinct()


# ---------------------------------------------------------------------------- components

def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: root is the smallest node that links reach; nodes without links are not listed.

    Large-star: the larger neighbours of a node link to its smallest neighbour (or itself).
    Small-star: a node's smaller neighbours and itself link to the smallest of them. Both are
    one minimum per node, combined on the map side, joined back to the edges.
    """
    now = written(edges.select("a", "b"), "stars")
    seen = None
    for _ in range(ROUNDS):
        if seen == (seen := _summary(now)):
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        large = written(large, "stars")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").where("b <> m").select(F.col("b").alias("a"),
                                                              F.col("m").alias("b"))
                 .union(down.select("a", F.col("m").alias("b"))).distinct())
        now = written(small, "stars")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _summary(edges: DataFrame) -> tuple:
    """Count and an order-free digest of the edges: two numbers."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())


def near_duplicates(df: DataFrame, size: int = SHINGLE_WORDS,
                    most_bits: int = MOST_BITS) -> DataFrame:
    """``(doc_id, fp, root, component_id)``: root is the smallest fingerprint of the component."""
    if most_bits != MOST_BITS:
        raise ValueError("the Golay keys are built for two differing bits")
    rows = written(fingerprints(df, size), "simhash-fp")
    # one row per distinct fingerprint, combined before the shuffle
    least = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    found = components(links(least))
    rooted = least.join(found, least.fp == found.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = written(rooted.join(named, "root").select("fp", "root", "component_id"),
                      "simhash-classes")
    return rows.join(classes, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(df: DataFrame, size: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``df`` that stay: one per component, of its smallest doc_id.

    Where rows share an id but not a component, each component keeps its own. A component
    without any doc_id keeps one row of its smallest fingerprint. Kept rows are whole, with all
    columns.
    """
    classes = near_duplicates(df, size, most_bits)
    # per component the smallest id and, among its rows, the smallest fingerprint
    kept = written(classes.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp")).alias("k"))
        .select("k.doc_id", F.col("k.fp").alias(OWN)), "simhash-kept")
    # an id of one row needs no fingerprint to be found again
    repeated = written(classes.where("doc_id is not null").groupBy("doc_id")
                       .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"),
                       "simhash-repeated")
    named = df.where("doc_id is not null")
    single = (named.join(kept.where("doc_id is not null").join(repeated, "doc_id", "left_anti")
                         .select("doc_id"), "doc_id", "left_semi"))
    several = (with_fingerprint(named.join(repeated, "doc_id", "left_semi"), size)
               .join(kept, ["doc_id", OWN], "left_semi").dropDuplicates(["doc_id", OWN]))
    nameless = (with_fingerprint(df.where("doc_id is null"), size)
                .join(kept.where("doc_id is null").select(OWN), OWN, "left_semi")
                .dropDuplicates([OWN]))
    return (single.select(*df.columns).unionByName(several.select(*df.columns))
            .unionByName(nameless.select(*df.columns)))


def with_fingerprint(df: DataFrame, size: int) -> DataFrame:
    """All columns of ``df`` and its fingerprint as ``OWN``."""
    schema = T.StructType([*df.schema.fields, T.StructField(OWN, T.LongType())])
    at = df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint_of(shingle_hashes(t, size))
                             for t in batch.column(at).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made)],
                                             names=[*batch.schema.names, OWN])
    return df.mapInArrow(run, schema)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")
