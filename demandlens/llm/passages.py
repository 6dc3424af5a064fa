"""Substring dedup with repeated-phrase automata.

A *window* is ``WINDOW`` consecutive words of one document. A word is removed when it lies in a
window whose words also start in a document with a smaller id.

1. Anchors. Every window picks the smallest hash among its ``ANCHOR``-word phrases. Equal
   windows pick equal anchors, and neighbouring windows mostly pick the same one, so a
   document has about one anchor per five words. Anchors held by two different texts are
   found by a map-side combinable minimum and maximum of the text's hash: copies of one text
   hold the same hash and cost nothing more.
2. Confirmed passages. Runs of windows on a shared anchor are cut out as passages (real
   words), and equal passages collapse before they are shuffled. Anchors in more than ``HOT``
   texts send each window as a passage of its own, spread by the window's hash.
3. Automata. Passages are dealt by anchor, so all places a window can recur in meet in one
   shard. A shard goes through its anchors in order, and compiles an Aho-Corasick automaton
   (pyahocorasick) over the windows of a bounded number of passages at a time: each word is one symbol,
   each window a pattern with the smallest id that has it. All passages then stream through
   the automaton, which locates every occurrence by its words, not by hashes.
4. What was located joins back to the places that hold the passage, then to the texts.

Which anchors are shared goes to the scanning tasks as a bitmap of a fixed number of bits
(``BITMAP_BITS``). It may let more through than is shared, never less. Where the corpus
outgrows it the result stays exact and step 2 moves more text, up to 3.4 times the input.

Whole copies of a text need no automaton: all words of such a document (if it has a window)
are in windows of the copy with the smallest id.

Defined cases: a null text counts as empty and has no words; texts shorter than a window lose
nothing. A null doc_id counts as larger than any id. Rows with equal ids are one document to
each other: neither removes words of the other. Repeated rows get equal results. Empty tables
give empty results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm._common import Rows, byte_words, table, text_or_empty, written

WINDOW = 13
ANCHOR = 5
HOT = 512
BITMAP_BITS = 1 << 26
BITMAP_PARTS = 64
BATCH = 4000                     # passages per automaton
KNOWN = 60_000                   # passages that a task collapses before it writes them out
NO_ID = (1 << 63) - 1


def word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def phrase_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    n = len(hashes) - size + 1
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n]
    return _mix(out)


def anchors_of(hashes: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> np.ndarray:
    """The anchor of the window at each place, as signed integers."""
    phrases = phrase_hashes(hashes, anchor)
    span = window - anchor + 1
    least = phrases[:len(phrases) - span + 1].copy()
    for j in range(1, span):
        np.minimum(least, phrases[j:j + len(least)], out=least)
    return least.view(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, doc, h1, h2, text)``; h1 and h2 identify the text."""
    text = text_or_empty()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2"),
        text.alias("text"))


def shared_anchors(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    """``(anchor, n)``: anchors in two different texts, and how many rows hold them."""
    schema = pa.schema([("anchor", pa.int64()), ("h1", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                found, owner = [], []
                for h1, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ws = byte_words(text)
                    if len(ws) >= window:
                        own = np.unique(anchors_of(word_hashes(ws), window, anchor))
                        found.append(own)
                        owner.append(np.full(len(own), h1, np.int64))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(found)), pa.array(np.concatenate(owner))],
                        schema=schema)
    held = texts.select("h1", "text").mapInArrow(run, "anchor long, h1 long")
    return (held.groupBy("anchor").agg(F.min("h1").alias("low"), F.max("h1").alias("high"),
                                       F.count(F.lit(1)).alias("n"))
            .where("low < high").select("anchor", "n"))


def bitmap(anchors: DataFrame, bits: int = BITMAP_BITS) -> bytes:
    """The anchors' low bits as a bitmap; its parts are joined per part, then by the driver."""
    part_bits = bits // BITMAP_PARTS
    schema = pa.schema([("part", pa.int32()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            place = batch.column(0).to_numpy(zero_copy_only=False) & (bits - 1)
            np.bitwise_or.at(own, place >> 3, (1 << (place & 7)).astype(np.uint8))
        for i in range(BITMAP_PARTS):
            piece = own[i * part_bits // 8:(i + 1) * part_bits // 8]
            if piece.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([piece.tobytes()], pa.binary())],
                    schema=schema)

    def join(group: pa.Table) -> pa.Table:
        total = np.zeros(part_bits // 8, np.uint8)
        for piece in group.column("bits"):
            total |= np.frombuffer(piece.as_buffer(), np.uint8)
        return pa.table([group.column("part").slice(0, 1),
                         pa.array([total.tobytes()], pa.binary())], schema=schema)
    made = (anchors.select("anchor").coalesce(16).mapInArrow(run, "part int, bits binary")
            .groupBy("part").applyInArrow(join, "part int, bits binary"))
    whole = np.zeros(bits // 8, np.uint8)
    for row in made.toLocalIterator():           # at most bits / 8 bytes in all
        whole[row.part * part_bits // 8:(row.part + 1) * part_bits // 8] = np.frombuffer(
            row.bits, np.uint8)
    return whole.tobytes()


PASSAGE_SCHEMA = pa.schema([
    ("key", pa.int64()), ("th", pa.int64()), ("words", pa.binary()), ("low", pa.int64()),
    ("high", pa.int64()), ("doc", pa.int64()), ("h1", pa.int64()), ("start", pa.int32())])
PASSAGE_DDL = ("key long, th long, words binary, low long, high long, doc long, h1 long, "
               "start int")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def cut_passages(texts: DataFrame, shared: bytes, hot: bytes, window: int, anchor: int,
                 bits: int) -> DataFrame:
    """Passages on shared anchors and the places that hold them, in one table.

    Rows with ``words`` are passages, collapsed within the task: smallest and largest id. Rows
    without are places: ``doc, h1, start``.
    """
    context = texts.sparkSession.sparkContext
    shared_map, hot_map = context.broadcast(shared), context.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_shared = np.frombuffer(shared_map.value, np.uint8)
        in_hot = np.frombuffer(hot_map.value, np.uint8)
        out = Rows(PASSAGE_SCHEMA, most_rows=20_000)
        known: dict[tuple[int, bytes], list[int]] = {}

        def note(key: int, cut: list[bytes], doc: int, h1: int, start: int) -> None:
            joined = b" ".join(cut)
            th = _signed(xxhash.xxh64_intdigest(joined))
            seen = known.get((key, joined))
            if seen is None:
                known[key, joined] = [doc, doc, th]
            elif doc < seen[0]:
                seen[0] = doc
            elif doc > seen[1]:
                seen[1] = doc
            out.add(key, th, None, None, None, doc, h1, start)

        def spill() -> None:
            for (key, joined), (low, high, th) in known.items():
                out.add(key, th, joined, low, high, None, None, None, weight=len(joined))
            known.clear()

        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                for doc, h1, text in zip(*(c.to_pylist() for c in part.columns)):
                    ws = byte_words(text)
                    if len(ws) < window:
                        continue
                    own = anchors_of(word_hashes(ws), window, anchor)
                    place = own & (bits - 1)
                    hit = in_shared[place >> 3] >> (place & 7).astype(np.uint8) & 1
                    if not hit.any():
                        continue
                    edge = np.flatnonzero(own[1:] != own[:-1]) + 1
                    first = np.concatenate(([0], edge))
                    last = np.concatenate((edge, [len(own)]))
                    use = hit[first].astype(bool)
                    warm = (in_hot[place >> 3] >> (place & 7).astype(np.uint8) & 1)[first]
                    for i, j, hot_one in zip(first[use].tolist(), last[use].tolist(),
                                             warm[use].tolist()):
                        if hot_one:
                            for w in range(i, j):
                                cut = ws[w:w + window]
                                key = _signed(xxhash.xxh64_intdigest(b" ".join(cut), 7))
                                note(key, cut, doc, h1, w)
                        else:
                            note(int(own[i]), ws[i:j + window - 1], doc, h1, i)
                    if len(known) >= KNOWN:
                        spill()
                    while out.full:
                        yield out.take()
        spill()
        yield from out.rest()
    return texts.select("doc", "h1", "text").mapInArrow(run, PASSAGE_DDL)


def _symbol(number: int) -> str:
    """One character per word; surrogates are left out."""
    return chr(number + 1 if number < 0xD7FF else number + 0x801)


def locate(passages: list[tuple[int, int, bytes, int, int]], window: int) -> list[tuple]:
    """``(key, th, smallest ids of its windows)`` for passages that other documents hold too.

    One automaton over all windows of the passages; every passage streams through it.
    """
    merged: dict[tuple[int, int, bytes], list[int]] = {}
    for key, th, joined, low, high in passages:
        seen = merged.setdefault((key, th, joined), [low, high])
        seen[0], seen[1] = min(seen[0], low), max(seen[1], high)
    held: dict[int, int] = {}
    for key, _, _ in merged:
        held[key] = held.get(key, 0) + 1
    live = [(k, v) for k, v in merged.items() if held[k[0]] > 1 or v[0] < v[1]]
    symbols: dict[bytes, str] = {}
    least: dict[str, int] = {}
    coded = []
    for (key, th, joined), (low, high) in live:
        code = "".join([symbols.get(w) or symbols.setdefault(w, _symbol(len(symbols)))
                        for w in joined.split(b" ")])
        coded.append((key, th, code, high))
        for i in range(len(code) - window + 1):
            w = code[i:i + window]
            if least.get(w, NO_ID + 1) > low:
                least[w] = low
    if not least:
        return []
    automaton = ahocorasick.Automaton()
    for w, low in least.items():
        automaton.add_word(w, low)
    automaton.make_automaton()
    out = []
    for key, th, code, high in coded:
        ids = [NO_ID] * (len(code) - window + 1)
        for end, low in automaton.iter(code):
            ids[end - window + 1] = low
        if min(ids) < high:
            out.append((key, th, ids))
    return out


def located(passages: DataFrame, window: int) -> DataFrame:
    """``(key, th, ids)``: shards of passages by key, run through automata."""
    schema = pa.schema([("key", pa.int64()), ("th", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out = Rows(schema, most_rows=8192)
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                for row in zip(*(c.to_pylist() for c in batch.slice(k, 2048).columns)):
                    if len(held) >= BATCH and row[0] != held[-1][0]:
                        for found in locate(held, window):
                            out.add(*found)
                        held = []
                        if out.full:
                            yield out.take()
                    held.append(row)
        for found in locate(held, window):
            out.add(*found)
        yield from out.rest()
    dealt = passages.select("key", "th", "words", "low", "high")
    n = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (dealt.repartition(n, "key").sortWithinPartitions("key")
            .mapInArrow(run, "key long, th long, ids array<long>"))


def removals(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
             bits: int = BITMAP_BITS, hot_above: int = HOT) -> DataFrame:
    """``(doc, h1, whole, starts)``: texts that lose words.

    ``starts`` are the windows to remove; ``whole`` says that a copy has a smaller id.
    """
    texts = _texts(docs)
    anchors = written(shared_anchors(texts, window, anchor), "passage-anchors")
    shared, hot = bitmap(anchors, bits), bitmap(anchors.where(F.col("n") > hot_above), bits)
    cut = written(cut_passages(texts, shared, hot, window, anchor, bits), "passage-cuts")
    found = located(cut.where("words is not null"), window)
    places = cut.where("words is null").select("key", "th", "doc", "h1", "start")
    starts = (places.join(found, ["key", "th"])
              .select("doc", "h1", F.filter(
                  F.transform("ids", lambda low, i: F.when(low < F.col("doc"),
                                                           i + F.col("start"))),
                  lambda s: s.isNotNull()).alias("s"))
              .where(F.size("s") > 0)
              .groupBy("doc", "h1").agg(F.flatten(F.collect_set("s")).alias("starts")))
    ids = texts.select("doc", "h1", "h2")
    first = ids.groupBy("h1", "h2").agg(F.min("doc").alias("first"),
                                        F.max("doc").alias("last")).where("first < last")
    copies = (ids.join(first, ["h1", "h2"]).where("doc > first").select("doc", "h1")
              .distinct().withColumn("whole", F.lit(True)))
    return starts.join(copies, ["doc", "h1"], "full").select(
        "doc", "h1", F.coalesce("whole", F.lit(False)).alias("whole"), "starts")


def _set_bits(whole: np.ndarray, values: np.ndarray, bits: int) -> np.ndarray:
    """Is the bit of each value set?"""
    at = values & (bits - 1)
    return (whole[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def strip_passages(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   bits: int = BITMAP_BITS, hot_above: int = HOT) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept)`` per row; ``kept`` is the UTF-8 of what is left.

    Texts that lose nothing are not shuffled: a bitmap of those that may lose words sends only
    these to the join.
    """
    gone = written(removals(docs, window, anchor, bits, hot_above), "passage-removals")
    texts = _texts(docs)
    shipped = docs.sparkSession.sparkContext.broadcast(
        bitmap(gone.select(F.col("h1").alias("anchor")), bits))

    @F.pandas_udf("boolean")
    def holds(values: pd.Series) -> pd.Series:
        return pd.Series(_set_bits(np.frombuffer(shipped.value, np.uint8), values.to_numpy(), bits))

    touched = texts.where(holds("h1")).join(gone, ["doc", "h1"], "left").select(
        "doc_id", "text", F.coalesce("whole", F.lit(False)).alias("whole"), "starts")
    others = texts.select("doc_id", "text", F.lit(False).alias("whole"),
                          F.lit(None).cast("array<int>").alias("starts"), "h1")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("n_removed", pa.int64()), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema, most_rows=2048)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                for doc_id, text, whole, starts in zip(
                        *(c.to_pylist() for c in batch.slice(k, 256).columns[:4])):
                    ws = byte_words(text)
                    n = len(ws)
                    if whole and n >= window:
                        ws = []
                    elif starts:
                        count = np.zeros(n + 1, np.int64)
                        at = np.unique(np.array(starts, np.int64))
                        count[at] += 1
                        count[at + window] -= 1
                        ws = [w for w, c in zip(ws, np.cumsum(count[:n]).tolist()) if not c]
                    kept = b" ".join(ws)
                    out.add(doc_id, n, n - len(ws), kept, weight=len(kept))
                    if out.full:
                        yield out.take()
        yield from out.rest()

    def run_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.frombuffer(shipped.value, np.uint8)

        def spared() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = _set_bits(whole, batch.column(4).to_numpy(zero_copy_only=False), bits)
                for k in range(0, batch.num_rows, 1024):
                    yield batch.slice(k, 1024).filter(pa.array(~hit[k:k + 1024]))
        return run(spared())

    result = "doc_id long, n_words long, n_removed long, kept binary"
    return touched.mapInArrow(run, result).union(others.mapInArrow(run_others, result))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that a document with a smaller id has."""
    kept = strip_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                                      lambda w: w <> '') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM d),
g AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 12], ' ') AS win FROM p
      WHERE pos + 12 <= len(w)),
f AS (SELECT win, min(doc_id) AS earliest FROM g GROUP BY win),
c AS (SELECT DISTINCT doc_id, pos + o AS pos
      FROM (SELECT g.doc_id, g.pos, unnest(range(13)) AS o FROM g JOIN f USING (win)
            WHERE f.earliest < g.doc_id)),
k AS (SELECT doc_id, count(*) AS n, string_agg(w[pos], ' ' ORDER BY pos) AS t
      FROM p ANTI JOIN c USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
