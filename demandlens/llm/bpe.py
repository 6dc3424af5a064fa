"""Byte-level BPE encoding and decoding.

Each match of the splitting pattern is encoded on its own. A segment tree over the byte
positions of a match keeps, per node, the smallest pair rank below it and the leftmost
position that has it. A merge takes the root, joins that pair, and updates the tree at the
live neighbours only: a match of n bytes costs O(n log n), so a run of a million letters is
no special case. A node has ``FAN`` children, so a usual match has a root and leaves only.

``encode`` and ``decode`` are the operators, and ``round_trip`` is both in one step, so that a
task has one Python worker and one copy of the ranks. All work row by row inside ``mapInArrow``
and move no data between tasks. A worker keeps the ids of at most ``CACHED_PIECES`` pieces of at
most ``CACHED_CHARS`` characters and hands out rows once they hold ``BATCH_BYTES`` of text: neither
depends on the input. Ids are kept and joined as packed 32-bit values and become Arrow arrays as
they are; decoding takes the tokens of all ids of a batch at once.

Defined cases: a null text counts as empty and gives an empty id list; an empty text too. A
null id list decodes to empty bytes. Repeated rows are encoded once each. An input column
that has the name of a result column (``ids``, ``decoded``) is replaced; other columns pass, but
``round_trip`` leaves the text out, since ``decoded`` has its bytes.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.llm._common import table

# pieces that a worker keeps; when full, they become the older half and a new half begins, so
# frequent pieces stay and nothing is left out
CACHED_PIECES = 400_000          # about 80 MB
CACHED_CHARS = 48
BATCH_BYTES = 4 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Ranks:
    """Ranks of the tokens, also shifted so that a byte position fits below them."""

    SHORT, SHORT_BITS, LONG_BITS = 64, 6, 32

    def __init__(self, ranks: dict[bytes, int]):
        self.plain = ranks
        self.single = [ranks.get(bytes([b])) for b in range(256)]
        self.short = {t: r << self.SHORT_BITS for t, r in ranks.items()}
        most = max(ranks.values(), default=0) + 1
        self.short_none = 1 << (most << self.SHORT_BITS).bit_length()
        self.long_none = 1 << (most << self.LONG_BITS).bit_length()

    def long(self, token: bytes, none: int) -> int:
        rank = self.plain.get(token)
        return none if rank is None else rank << self.LONG_BITS


FAN_BITS = 4
FAN = 1 << FAN_BITS


def merge_piece(piece: bytes, table: Ranks) -> tuple[int, ...]:
    """Token ids of one match of the pattern.

    A segment tree over byte positions: leaf i holds the pair that starts at byte i as its
    rank, shifted, plus i, and a node the smallest of its ``FAN`` children, so the smallest of
    the top level is the leftmost pair of the smallest rank. A merge changes three leaves, those
    of the merged token, of the token it swallowed, and of its live neighbour before; their
    paths to the top are renewed together.
    """
    ranks, n = table.plain, len(piece)
    whole = ranks.get(piece)
    if whole is not None or not n:
        return () if whole is None else (whole,)
    if n < table.SHORT:
        find, none, bits = table.short.get, table.short_none, table.SHORT_BITS
    else:
        find, none, bits = table.long, table.long_none, table.LONG_BITS
    mask = (1 << bits) - 1
    leaves = [find(piece[i:i + 2], none) + i for i in range(n - 1)]
    leaves.append(none)
    top, steps = leaves, []
    while len(top) > FAN:
        low, top = top, [min(top[i:i + FAN]) for i in range(0, len(top), FAN)]
        steps.append((low, top))
    # a live token starts at i, where its id is, and ends at after[i], where the next one starts
    ids = [table.single[b] for b in piece]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    while (best := min(top)) < none:
        i = best & mask
        ids[i] = best >> bits
        j = after[i]
        ids[j], leaves[j] = -1, none
        end = after[i] = after[j]
        if end < n:
            before[end] = i
            leaves[i] = find(piece[i:after[end]], none) + i
        else:
            leaves[i] = none
        h = before[i]
        if h >= 0:
            leaves[h] = find(piece[h:end], none) + h
        if steps:
            x = h if h >= 0 else i
            for low, up in steps:
                x, i, j = x >> FAN_BITS, i >> FAN_BITS, j >> FAN_BITS
                up[x] = min(low[x << FAN_BITS:(x + 1) << FAN_BITS])
                if i != x:
                    up[i] = min(low[i << FAN_BITS:(i + 1) << FAN_BITS])
                if j != i:
                    up[j] = min(low[j << FAN_BITS:(j + 1) << FAN_BITS])
    if None in ids:
        raise KeyError(piece)
    return tuple([token for token in ids if token >= 0])


class Encoder(dict):
    """Maps a piece to its ids, packed; unseen pieces are merged, short ones kept."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.table, self.pieces = Ranks(ranks), regex.compile(pattern).findall
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", merge_piece(piece.encode("utf-8", "replace"), self.table)).tobytes()
        if len(piece) <= CACHED_CHARS:
            if len(self) >= CACHED_PIECES // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text)))


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process, for all its tasks."""
    return Encoder(_ranks(path), pattern)


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    return read_ranks(path)


@lru_cache(maxsize=2)
def _tokens(path: str) -> pa.Array:
    """The bytes of every id; null where the file has no such rank."""
    ranks = _ranks(path)
    out: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return pa.array(out, pa.large_binary())


def _ship(spark: SparkSession, path: str) -> str:
    """Give the rank file to every executor; returns the name to ask SparkFiles for."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def _mapped(df: DataFrame, source: str, made: list[tuple[str, T.DataType]], convert,
            drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns ``made``, which ``convert`` makes of some values of ``source``."""
    names = [name for name, _ in made]
    at = [i for i, f in enumerate(df.schema.fields) if f.name not in (*names, *drop)]
    schema = T.StructType([*(df.schema.fields[i] for i in at),
                           *(T.StructField(name, kind) for name, kind in made)])
    src = df.schema.fieldNames().index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(src)
            start = 0
            for stop in _cuts(values):
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in at), *convert(part.column(src))],
                    names=schema.fieldNames())
                start = stop
    return df.mapInArrow(run, schema)


def _cuts(values: pa.Array) -> list[int]:
    """Ends of slices that hold ``BATCH_BYTES`` each, or one row that is larger."""
    lengths = pc.binary_length(values) if pa.types.is_string(values.type) else pc.multiply(
        pc.list_value_length(values), 4)
    sizes = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    out, done = [], 0
    while not out or out[-1] < len(values):
        before = sizes[done - 1] if done else 0
        done = max(done + 1, int(np.searchsorted(sizes, before + BATCH_BYTES, "right")))
        out.append(min(done, len(values)))
    return out


def _starts(lengths) -> np.ndarray:
    """Where each of consecutive rows starts and the last one ends."""
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _encoded(texts: pa.Array, encoder: Encoder) -> tuple[np.ndarray, pa.Array]:
    """Where the ids of each text start, and the ids of all texts."""
    rows = [encoder.encode(t) if t else b"" for t in texts.to_pylist()]
    return (_starts([len(r) // 4 for r in rows]),
            pa.array(np.frombuffer(b"".join(rows), np.int32)))


def _lists(starts: np.ndarray, ids: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), ids)


def _joined(starts: np.ndarray, ids: pa.Array, tokens: pa.Array) -> pa.Array:
    """Per row the bytes of its ids: those of all ids, one after another, cut at row starts."""
    taken = tokens.take(ids)
    if taken.null_count:
        raise ValueError("an id that the rank file does not have")
    _, ends, data = taken.buffers()
    ends = np.frombuffer(ends, np.int64)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(ends[starts]), data]).cast(pa.binary())


IDS, BYTES = T.ArrayType(T.IntegerType(), False), T.BinaryType()


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int): the tokens of the whole text, special tokens not used."""
    name = _ship(df.sparkSession, ranks_path)

    def convert(texts: pa.Array) -> list[pa.Array]:
        return [_lists(*_encoded(texts, _encoder(SparkFiles.get(name), pattern)))]
    return _mapped(df, text, [("ids", IDS)], convert)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary): the bytes that the ids stand for."""
    name = _ship(df.sparkSession, ranks_path)

    def convert(lists: pa.Array) -> list[pa.Array]:
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        return [_joined(_starts(lengths), lists.flatten(), _tokens(SparkFiles.get(name)))]
    return _mapped(df, ids, [("decoded", BYTES)], convert)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` without its text: ``ids``, and ``decoded``, made from the ids alone."""
    name = _ship(df.sparkSession, ranks_path)

    def convert(texts: pa.Array) -> list[pa.Array]:
        path = SparkFiles.get(name)
        starts, ids = _encoded(texts, _encoder(path, pattern))
        return [_lists(starts, ids), _joined(starts, ids, _tokens(path))]
    return _mapped(df, text, [("ids", IDS), ("decoded", BYTES)], convert, drop=(text,))


def default_vocabulary() -> tuple[str, str]:
    """Rank file and pattern of the installed public vocabulary."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document and the digest of what they decode to."""
    path, pattern = default_vocabulary()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, path, pattern).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
