"""Phrase collocations by stripes.

A *stripe* belongs to a prefix and is an associative counter of the words that follow it; its
entry under ``TOTAL`` counts the prefix itself. Tasks build stripes of up to ``CHUNK_TOKENS``
words at a time, cut by a hash of the next word into ``SEGMENTS`` parts so that the stripe of
a hot prefix is never in one place, and send them in bundles, a row per chunk and bundle. A
bundle's stripes are merged element by element (a sum per next word); the number of bundles
follows the input, so that one of them fits a task, and a prefix or pair that is everywhere
adds an entry per chunk. All that the result needs is then in that one structure: an extension's
frequency is an entry, a prefix's frequency its total, and the entry that subsumes a phrase the
largest of those that extend it by one word, to the right (its own stripe) or to the left.

A phrase is frequent only if its parts are, so the second pass over the texts, for prefixes of
two and three words, leaves out what contains an infrequent pair. It asks a bitmap of fixed
size, broadcast, in which frequent pairs set a bit each. The bitmap only saves work: a pair
that shares a bit passes, is counted like any other, and falls to the exact threshold. Once a
corpus has far more frequent pairs than bits, the pass sends every sequence of three and four words.

A phrase of two to four words is a candidate from ``least`` occurrences. Cut into a first part
and a rest it scores ``floor(2000000 * a / (l + r))``, and the cut with the lowest score counts.
A candidate goes if a longer candidate that contains it has at least ``subsumed`` percent of its
occurrences. It is enough to look one word further: a longer candidate's own parts of
intermediate length are candidates with at least its frequency.

Defined cases: a null text counts as empty; a null language is ``und``, together with rows that
say so; empty texts, texts of separators and empty tables give nothing; repeated rows count each
time. Very long texts are read in slices that end where a piece ends. Other columns are not
read. Ranks are per language; ties fall to the larger frequency, then to the phrase's bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.llm._common import table, text_or_empty, written

LONGEST = 4                      # words of a phrase; stripes are built for prefixes of 1 to 3
LEAST = 30                       # occurrences of a candidate
SUBSUMED = 80                    # percent
TOP = 2000                       # results of a language
TOTAL = ""                       # the entry of a stripe that counts its prefix
BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n" * 9 + b" ")
CHUNK_TOKENS = 1 << 20
SLICE_BYTES = 1 << 20
SEGMENTS = 32
BUNDLE_BYTES = 2 << 20           # bytes of text for each bundle of stripes, about
PAIR_BITS = 1 << 26              # 8 MB
SALTS = 256                      # first round of the ranking
# words are joined by line feeds, which no word has; ``sizes`` counts the entries of each stripe
BUNDLES = pa.schema([("bundle", pa.int32()), ("langs", pa.string()), ("prefixes", pa.string()),
                     ("sizes", pa.list_(pa.int32())), ("nexts", pa.string()),
                     ("counts", pa.list_(pa.int64()))])
BUNDLES_DDL = ("bundle int, langs string, prefixes string, sizes array<int>, nexts string, "
               "counts array<bigint>")


# ------------------------------------------------------------------------------- words

class _Ids(dict):
    """Word -> number within the chunk; 0 is a break between pieces, -1 no word.

    ``whole`` is a number for the language's empty prefix.
    """

    def __init__(self, chunk: Chunk, lang: str):
        super().__init__({b"\n": 0, b"": -1})
        self.chunk, self.at, self.whole = chunk, len(chunk.langs), len(chunk.words)
        chunk.langs.append(lang)
        chunk.words.append(b"")
        chunk.lang_of.append(self.at)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.chunk.words)
        self.chunk.words.append(word)
        self.chunk.lang_of.append(self.at)
        return n


class Chunk:
    """Words of some texts as one array of numbers; equal words of two languages differ."""

    def __init__(self):
        self.words, self.lang_of, self.langs = [b""], [0], []
        self.ids: dict[str, _Ids] = {}
        self.parts: list[np.ndarray] = []
        self.tokens = 0

    def add(self, lang: str, text: bytes) -> None:
        own = self.ids.get(lang)
        if own is None:
            own = self.ids[lang] = _Ids(self, lang)
        split = text.lower().translate(BREAKS).replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(own.__getitem__, split), np.int64, len(split))
        ids = ids[ids >= 0]
        self.parts += [ids, np.zeros(1, np.int64)]
        self.tokens += len(ids) + 1

    def array(self) -> np.ndarray:
        return np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)


def slices(text: bytes) -> Iterator[bytes]:
    """Parts of a long text that end with a piece; a piece is never cut."""
    if len(text) <= SLICE_BYTES:
        yield text
        return
    marked, at = text.translate(BREAKS), 0
    while at < len(text):
        stop = marked.find(b"\n", at + SLICE_BYTES)
        stop = len(text) if stop < 0 else stop + 1
        yield text[at:stop]
        at = stop


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word)


def pair_bit(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Place of a pair in the bitmap, from the hashes of its words."""
    h = first * np.uint64(0x9E3779B97F4A7C15) + second
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h ^ (h >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64)


# ------------------------------------------------------------------------------ stripes

class Names:
    """Words of a chunk and their languages, by number."""

    def __init__(self, chunk: Chunk, bundles: int):
        self.words = pa.array(chunk.words, pa.binary()).cast(pa.string())
        # a language may hold line feeds
        langs = [lang.replace("%", "%25").replace("\n", "%0A") for lang in chunk.langs]
        self.langs = pa.array(langs, pa.string()).take(pa.array(chunk.lang_of))
        self.code = np.fromiter(map(zlib.crc32, chunk.words), np.int64)
        self.bundles, self.size = bundles, np.int64(len(chunk.words))

    def bundle_of(self, heads: list[np.ndarray], segment: np.ndarray) -> np.ndarray:
        h = segment.astype(np.uint64)
        for head in heads:
            h = (h + self.code[head].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        return (h % np.uint64(self.bundles)).astype(np.int64)

    def bundled(self, heads: list[np.ndarray], segment: np.ndarray, sizes: np.ndarray,
                nexts: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        """A row per bundle. ``heads[j]`` is the j-th word of every stripe's prefix; the entries
        of a stripe follow each other."""
        bundle = self.bundle_of(heads, segment)
        order = np.argsort(bundle, kind="stable")
        starts, size = (np.cumsum(sizes) - sizes)[order], sizes[order]
        ends = np.cumsum(size)
        entry = np.repeat(starts - (ends - size), size) + np.arange(len(nexts))
        rows, first = np.unique(bundle[order], return_index=True)
        by_stripe = pa.array(np.append(first, len(order)), pa.int32())
        by_entry = pa.array(np.append((ends - size)[first], len(nexts)), pa.int32())

        def joined(offsets: pa.Array, values: pa.Array) -> pa.Array:
            return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")
        prefix = [self.words.take(pa.array(h[order])) for h in heads]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()),
             joined(by_stripe, self.langs.take(pa.array(heads[0][order]))),
             joined(by_stripe, prefix[0] if len(prefix) == 1 else
                    pc.binary_join_element_wise(*prefix, " ")),
             pa.ListArray.from_arrays(by_stripe, pa.array(size, pa.int32())),
             joined(by_entry, self.words.take(pa.array(nexts[entry]))),
             pa.ListArray.from_arrays(by_entry, pa.array(counts[entry], pa.int64()))],
            schema=BUNDLES)

    def stripes(self, heads: list[np.ndarray], prefix: np.ndarray,
                following: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Stripes of occurrences: ``heads[j][prefix[i]]`` is the j-th word of occurrence i's
        prefix, ``following[i]`` the word after it."""
        if not len(following):
            return
        keys, counts = np.unique(
            (prefix * SEGMENTS + self.code[following] % SEGMENTS) * self.size + following,
            return_counts=True)
        stripe, nexts = np.divmod(keys, self.size)
        starts = np.flatnonzero(np.diff(stripe, prepend=-1))
        owner, segment = np.divmod(stripe[starts], SEGMENTS)
        yield self.bundled([h[owner] for h in heads], segment,
                           np.diff(np.append(starts, len(keys))), nexts, counts)


def _short(chunk: Chunk, bundles: int, pairs: bytes | None) -> Iterator[pa.RecordBatch]:
    """Stripes of prefixes of one word, and the total of the empty prefix. As an entry, number 0
    is the empty word and so the total."""
    a, names = chunk.array(), Names(chunk, bundles)
    count = np.bincount(a, minlength=names.size)
    lang_of = np.array(chunk.lang_of)
    for ids in chunk.ids.values():
        count[ids.whole] = count[1:][lang_of[1:] == ids.at].sum()
    own = np.arange(1, names.size)
    none = np.zeros(len(own), np.int64)
    yield names.bundled([own], none, none + 1, none, count[1:])
    at = np.flatnonzero((a[:-1] > 0) & (a[1:] > 0))
    yield from names.stripes([np.arange(names.size)], a[at], a[at + 1])


def _long(chunk: Chunk, bundles: int, pairs: bytes) -> Iterator[pa.RecordBatch]:
    """Stripes of prefixes of two and three words, all of whose pairs may be frequent."""
    a, names = chunk.array(), Names(chunk, bundles)
    v = names.size
    bitmap = np.frombuffer(pairs, np.uint8)
    hashes = np.array([word_hash(chunk.langs[n], w) for n, w in zip(chunk.lang_of, chunk.words)],
                      np.uint64)
    bit = pair_bit(hashes[a[:-1]], hashes[a[1:]], 8 * len(bitmap))
    passes = ((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
              & (a[:-1] > 0) & (a[1:] > 0))
    three = np.flatnonzero(passes[:-1] & passes[1:])
    keys, prefix = np.unique(a[three] * v + a[three + 1], return_inverse=True)
    yield from names.stripes([keys // v, keys % v], prefix, a[three + 2])
    # those among them that go on with another such pair
    longer = (three < len(passes) - 2) & passes[np.minimum(three + 2, len(passes) - 1)]
    four = three[longer]
    triples, triple = np.unique(prefix[longer] * v + a[four + 2], return_inverse=True)
    pair = keys[triples // v]
    yield from names.stripes([pair // v, pair % v, triples % v], triple, a[four + 3])


def merged(group: pa.Table, least: int) -> pa.Table:
    """Stripes of one bundle, merged: ``(lang, prefix, next, n)`` of entries from ``least``."""
    def words(column: str) -> pa.Array:
        return pc.list_flatten(pc.split_pattern(group[column], "\n")).combine_chunks()
    sizes = pc.list_flatten(group["sizes"]).to_numpy()
    of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
    entries = pa.table({"lang": words("langs").dictionary_encode().take(of),
                        "prefix": words("prefixes").take(of), "next": words("nexts"),
                        "n": pc.list_flatten(group["counts"])})
    sums = entries.group_by(["lang", "prefix", "next"]).aggregate([("n", "sum")])
    sums = sums.filter(pc.greater_equal(sums["n_sum"], least))
    langs = [lang.replace("%0A", "\n").replace("%25", "%") for lang in
             sums["lang"].cast(pa.string()).to_pylist()]
    del entries, of
    pa.default_memory_pool().release_unused()
    return pa.table({"lang": pa.array(langs, pa.string()), "prefix": sums["prefix"],
                     "next": sums["next"], "n": sums["n_sum"]})


def stripes(docs: DataFrame, build, least: int, bundles: int, pairs=None,
            chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Merged stripes as rows ``(lang, prefix, next, n)``; ``docs`` has ``lang, text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = pairs.value if pairs else None
        chunk = Chunk()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for k, lang in enumerate(batch.column(0).to_pylist()):
                for part in slices(texts[k].as_py()):
                    chunk.add(lang, part)
                    if chunk.tokens >= chunk_tokens:
                        yield from build(chunk, bundles, bitmap)
                        chunk = Chunk()
        if chunk.tokens:
            yield from build(chunk, bundles, bitmap)
    return (docs.mapInArrow(run, BUNDLES_DDL).groupBy("bundle").applyInArrow(
        lambda group: merged(group, least), "lang string, prefix string, next string, n bigint"))


def frequent_pairs(pairs: DataFrame, bits: int) -> bytes:
    """A bitmap with the bit of every ``(lang, prefix, next)``; its size does not grow."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            lang, first, second = (c.to_pylist() for c in batch.columns)
            left = np.array([word_hash(g, w.encode()) for g, w in zip(lang, first)], np.uint64)
            right = np.array([word_hash(g, w.encode()) for g, w in zip(lang, second)], np.uint64)
            bit = pair_bit(left, right, bits)
            np.bitwise_or.at(own, bit >> 3, np.left_shift(1, bit & 7).astype(np.uint8))
        filled = own.view("<i8")
        slot = np.flatnonzero(filled)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(filled[slot])], ["slot", "word"])
    words = (pairs.select("lang", "prefix", "next").mapInArrow(run, "slot long, word long")
             .groupBy("slot").agg(F.bit_or("word").alias("word")).toArrow())
    out = np.zeros(bits >> 6, "<i8")
    out[words.column(0).to_numpy()] = words.column(1).to_numpy()
    return out.tobytes()


# ---------------------------------------------------------------------------- candidates

def _phrase(first: int | None, count: int | None = None):
    """Some words of the phrase, joined again."""
    return F.array_join(F.slice("words", first, F.size("words") - 1 if count is None else count), " ")


def mine(docs: DataFrame, least: int = LEAST, subsumed: int = SUBSUMED, top: int = TOP,
         pair_bits: int = PAIR_BITS, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of every language."""
    spark = docs.sparkSession
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                         text_or_empty().alias("text")).where("text <> ''")
    size = source.agg(F.sum(F.octet_length("text").cast("decimal(38,0)"))).first()[0] or 0
    bundles = 1 + int(size) // BUNDLE_BYTES
    short = written(stripes(source, _short, least, bundles, None, chunk_tokens), "stripes-short")
    pairs = short.where(F.col("next") != TOTAL)
    bitmap = spark.sparkContext.broadcast(frequent_pairs(pairs, pair_bits))
    longer = stripes(source, _long, least, bundles, bitmap, chunk_tokens)
    known = written(
        short.where((F.col("next") == TOTAL) & (F.col("prefix") != ""))
        .select("lang", F.col("prefix").alias("phrase"), "n")
        .unionByName(pairs.unionByName(longer).select(
            "lang", F.concat_ws(" ", "prefix", "next").alias("phrase"), "n")), "stripes-known")
    bitmap.destroy()
    sizes = short.where((F.col("next") == TOTAL) & (F.col("prefix") == "")).select(
        "lang", F.col("n").alias("all"))

    split = known.withColumn("words", F.split("phrase", " ")).where(F.size("words") > 1)
    cuts = split.select("lang", "phrase", F.col("n").alias("a"), "words",
                        F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    parts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("rest"))
    left = known.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    # the product may pass 64 bits, the quotient does not pass a million
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) "
                   "div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").cast("long")
    lowest = (parts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
              .withColumn("score", score).groupBy("lang", "phrase")
              .agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    above = (split.where(F.size("words") > 2)
             .select("lang", F.col("n").alias("longer"),
                     F.explode(F.array(_phrase(1), _phrase(2))).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (lowest.join(above, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | ~_reaches("longer", subsumed, "a"))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # a language may hold most rows: its best are found per salt first
    salted = Window.partitionBy("lang", "salt").orderBy(*order)
    best = (kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
            .withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
            .drop("salt", "rank"))
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return (ranked.where(F.col("rank") <= top).join(sizes, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                    F.col("all").alias("n"), "score"))


def _reaches(longer: str, percent: int, own: str):
    """``100 * longer >= percent * own``, in numbers that do not overflow."""
    return (F.col(longer).cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
            >= F.col(own).cast("decimal(20,0)") * F.lit(percent).cast("decimal(3,0)"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language, over all documents."""
    return mine(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
      FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS pos FROM p),
g AS (SELECT lang, size, array_to_string(w[pos:pos + size - 1], ' ') AS phrase
      FROM i, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE pos + size - 1 <= len(w)),
f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f
      WHERE size > 1 AND f >= 30),
k AS (SELECT *, unnest(range(1, size)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.f AS l, y.f AS r,
             ((2000000::HUGEINT * k.a) // (x.f + y.f))::BIGINT AS score
      FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ')
             JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ')),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
b AS (SELECT lang, a, array_to_string(w[i:i + sub - 1], ' ') AS phrase
      FROM (SELECT lang, size, a, w, unnest(range(1, size)) AS i FROM c),
           (SELECT unnest([2, 3]) AS sub) WHERE sub < size AND i + sub - 1 <= size),
o AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN b USING (lang, phrase)
      WHERE 100 * b.a >= 80 * c.a),
t AS (SELECT m.*, row_number() OVER (PARTITION BY m.lang ORDER BY score DESC, a DESC,
                                     encode(phrase)) AS rank
      FROM m ANTI JOIN o USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM t JOIN n USING (lang) WHERE rank <= 2000
"""
