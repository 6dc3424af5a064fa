"""Fill-in-middle transformation over a Roaring-style set of unit boundaries.

A text is cut into units (lines with their line feed). The ends of the units, in code points,
form a sorted set of integers, held as a Roaring bitmap is: values are grouped by their upper
bits into containers of 65,536, each an array, a bitmap or a list of runs, whichever is
smallest, and the set keeps the containers' cumulative cardinalities. The k-th boundary is found by
a search over those and a select inside one container, so both cut offsets cost a logarithm
whatever the length of the text.

The two cuts are drawn from a seeded hash of the row's id: prefix, middle and suffix are whole
units, any of them may be empty. Marked with sentinels they are put in the order prefix,
suffix, middle (``psm``) or suffix, prefix, middle (``spm``). ``fill_in_middle`` works row by
row inside one ``mapInArrow`` and moves no data between tasks; ``restore`` is its inverse, from
output and form alone, in built-in functions.

Defined cases: a null text counts as empty; an empty text, or one that contains a sentinel, is
left ``plain`` with null lengths. A null id is hashed as an empty name. Repeated rows come out
alike. An input column that has the name of a result column is replaced; the text column is
dropped, since ``restore`` gives it back; other columns pass. Empty tables stay empty.
"""

from __future__ import annotations

import hashlib
import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandlens.llm._common import Rows, table

MARKS = ("<P>", "<S>", "<M>")    # prefix, suffix, middle
SEED = 7
FIM_PERCENT, SPM_PERCENT = 100, 50
CONTAINER_BITS = 16
MOST_IN_ARRAY = 4096             # beyond it a bitmap of 8 KB is smaller than an array
MADE = (("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
        ("middle_chars", T.LongType()), ("output", T.StringType()))


# -------------------------------------------------------------------------- boundary set

class ArrayContainer:
    """The lower bits themselves, in order."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit per possible value, and the number of set bits before each word of 64."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << CONTAINER_BITS, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1                       # the lowest set bit goes
        return (at << 6) + (word & -word).bit_length() - 1


class RunContainer:
    """Starts of runs of consecutive values, and the number of values before each run."""

    def __init__(self, low: np.ndarray, starts: np.ndarray):
        self.first = low[starts].astype(np.uint16)
        self.before = starts

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[at]) + k - int(self.before[at])


def container(low: np.ndarray):
    """The smallest container for the lower bits of one group."""
    starts = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
    plain = 2 * len(low) if len(low) <= MOST_IN_ARRAY else 1 << (CONTAINER_BITS - 3)
    if 2 + 4 * len(starts) < plain:
        return RunContainer(low, starts)
    return ArrayContainer(low) if len(low) <= MOST_IN_ARRAY else BitmapContainer(low)


class BoundarySet:
    """Sorted distinct integers with ``select(k)``: the k-th smallest, from 0."""

    def __init__(self, values: np.ndarray):
        self.keys, starts = np.unique(values >> CONTAINER_BITS, return_index=True)
        ends = np.append(starts[1:], len(values))
        low = values & ((1 << CONTAINER_BITS) - 1)
        self.containers = [container(low[a:b]) for a, b in zip(starts, ends)]
        self.upto = ends.tolist()                  # cumulative cardinalities

    def __len__(self) -> int:
        return self.upto[-1] if self.upto else 0

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = bisect_right(self.upto, k)
        inside = k - (self.upto[at - 1] if at else 0)
        return (int(self.keys[at]) << CONTAINER_BITS) + self.containers[at].select(inside)


def line_ends(text: str) -> np.ndarray:
    """Code point offsets at which the units ``[^\\n]*\\n|[^\\n]+`` end."""
    if text.isascii():
        points = np.frombuffer(text.encode(), np.uint8)
    else:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.flatnonzero(points == 10) + 1
    return ends if not text or text[-1] == "\n" else np.append(ends, len(text))


# ------------------------------------------------------------------------- transformation

def draws(row_id, seed: int) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the row's id."""
    name = f"{seed}:{'' if row_id is None else row_id}"
    return struct.unpack(">4I", hashlib.sha256(name.encode()).digest()[:16])


def transform(text: str, row_id, seed: int, fim_percent: int, spm_percent: int,
              marks: tuple[str, str, str]) -> tuple:
    """``(n, form, prefix_chars, middle_chars, output)`` of one text."""
    bounds = BoundarySet(line_ends(text))
    n = len(bounds)
    h1, h2, h3, h4 = draws(row_id, seed)
    if not n or any(m in text for m in marks) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    cut, end = (bounds.select(k - 1) if k else 0 for k in (a, b))
    prefix, middle, suffix = text[:cut], text[cut:end], text[end:]
    p, s, m = marks
    if h4 % 100 < spm_percent:
        return n, "spm", cut, end - cut, "".join((s, suffix, p, prefix, m, middle))
    return n, "psm", cut, end - cut, "".join((p, prefix, s, suffix, m, middle))


def _check(marks: tuple[str, str, str]) -> None:
    """Sentinels must be found unambiguously wherever they are put."""
    for a in marks:
        for b in marks:
            if a == b and marks.count(a) > 1 or not a or (a != b and a in b) or any(
                    a[-k:] == b[:k] for k in range(1, min(len(a), len(b)))):
                raise ValueError(f"sentinels overlap: {a!r}, {b!r}")


def fill_in_middle(df: DataFrame, row_id: str = "doc_id", text: str = "text", seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
                   marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``df`` without its text, and ``n, form, prefix_chars, middle_chars, output``."""
    _check(marks)
    made = {name for name, _ in MADE}
    fields = df.schema.fields
    kept = [i for i, f in enumerate(fields) if f.name not in made and f.name != text]
    names = [f.name for f in fields]
    id_at, text_at = names.index(row_id), names.index(text)
    schema = T.StructType([*(fields[i] for i in kept), *(T.StructField(k, t) for k, t in MADE)])
    arrow = pa.schema([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                       ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            out = Rows(arrow, most_rows=1024)
            for k in range(batch.num_rows):
                whole = batch.column(text_at)[k].as_py() or ""
                out.add(*transform(whole, batch.column(id_at)[k].as_py(), seed, fim_percent,
                                   spm_percent, marks), weight=len(whole))
                if out.full or k + 1 == batch.num_rows:
                    part, new = batch.slice(start, k + 1 - start), out.take()
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(i) for i in kept), *new.columns], names=schema.names)
                    start = k + 1
    return df.mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form",
             marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output stands for, as an expression."""
    _check(marks)
    p, s, m = marks
    whole = F.col(output)
    head, middle = F.substring_index(whole, m, 1), F.substring_index(whole, m, -1)

    def between(first: str, second: str) -> Column:
        return F.substring_index(F.substring_index(head, second, 1), first, -1)
    return (F.when(F.col(form) == "psm", F.concat(
                between(p, s), middle, F.substring_index(head, s, -1)))
            .when(F.col(form) == "spm", F.concat(
                F.substring_index(head, p, -1), middle, between(s, p))).otherwise(whole))


def restore(df: DataFrame, text: str = "text",
            marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``df`` of ``fill_in_middle`` with the text back in column ``text``."""
    return df.withColumn(text, restored(marks=marks))


def op13_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, cuts and digests of every whole document."""
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                  sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
g AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS units,
             ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
             ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(units)::BIGINT AS n,
             least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                       OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, array_to_string(units[1:lo], '') AS prefix,
             array_to_string(units[lo + 1:hi], '') AS middle,
             array_to_string(units[hi + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
         AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
