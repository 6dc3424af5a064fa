"""URL filter: rules, then a classifier over segmented host and path words.

Rules (host suffix and path prefix) decide first; the longest fitting rule wins. A url without
a rule is judged by multinomial naive Bayes over the words of its host and path. Hosts run words together,
so a unigram model splits them first: the split with the largest product of word
probabilities, found by the Viterbi algorithm over the letters.

Both models come from the table itself, from all its rows, by Spark aggregations:

* unigrams: exact counts of the words, not numbers, of page titles, of paths and of hosts'
  hyphenated parts. They stay a table: the substrings of the distinct runs of letters in urls
  are joined to it, so an unseen string is unseen however many words there are;
* naive Bayes: exact token counts per class. They stay a table too: the tokens of a url, with
  how often it has them, are joined to it and summed per url. Classes are weak labels, the only ones
  that a table of urls offers: a url whose segmented host has a word of ``SEED_WORDS`` is an
  example of "block", others of "allow". What the classifier adds is the tokens that go with those
  words, on hosts that have none of them.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule, and
verdict allow. Repeated rows get equal results. Empty tables give empty results. Very long runs of
letters are split in linear time and space, since no word is longer than ``LONGEST``: their
substrings carry a number in place of the run.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm._common import Rows, table, written

# (verdict, rule): the fixed rules of the filter
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
# fixed words that mark a host as unwanted in the weak labels
SEED_WORDS = frozenset(("adult", "ads", "bet", "bets", "casino", "gambling", "gratis", "jackpot",
                        "lottery", "pharma", "pills", "poker", "porn", "sex", "slots", "spam",
                        "track", "viagra", "xxx"))
# base counts of the unigram model for words that titles may lack
PRIOR_WORDS = (*sorted(SEED_WORDS), "blog", "cheap", "example", "farm", "free", "m", "win", "www",
               "x")
PRIOR_COUNT = 50
LONGEST = 20
MOST_HELD = 100_000              # words that a task counts before it hands them on
UNKNOWN_BASE = 10.0              # an unseen word of n letters counts as 1 / (total * 10 ** n)
MARGIN = 0.0                     # log odds above which a url is blocked


# ----------------------------------------------------------------------- parts and rules

def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                                  "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does."""
    rule = verdict = F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        at, _, start = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


# ----------------------------------------------------------------------- segmentation

PARTS = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


def split_letters(letters: str, counts: dict[str, int], total: float) -> list[str]:
    """The split of least cost; ``counts`` has the known substrings, ``total`` is a logarithm."""
    best, back = [0.0], [0]
    for end in range(1, len(letters) + 1):
        least, start = math.inf, end - 1
        for begin in range(max(0, end - LONGEST), end):
            n = counts.get(letters[begin:end])
            c = best[begin] + (total - math.log(n) if n
                               else total + (end - begin) * math.log(UNKNOWN_BASE))
            if c < least:
                least, start = c, begin
        best.append(least)
        back.append(start)
    out, end = [], len(letters)
    while end:
        out.append(letters[back[end]:end])
        end = back[end]
    return out[::-1]


def parts_of(text: str) -> list[str]:
    return PARTS.findall(text.lower())


def is_letters(part: str) -> bool:
    return part.isascii() and part.isalpha()


def features(own: str = "own", rest: str = "rest") -> Column:
    """Host words and path words; the path's are marked, numbers there are one token."""
    def listed(column: str) -> Column:
        return F.filter(F.split(column, " "), lambda w: w != "")
    marked = F.transform(listed(rest), lambda w: F.concat(
        F.lit("/"), F.when(w.rlike(r"\A[0-9]+\z"), "0").otherwise(w)))
    return F.concat(listed(own), marked)


# ----------------------------------------------------------------------- models

def unigrams(parted: DataFrame) -> DataFrame:
    """``(word, n)``: word counts over titles, paths and hyphenated host parts of all rows."""
    title = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?is)<title>([^<]*)", 1)
    heard = parted.select(F.concat_ws(" ", F.lower(title), F.lower("path"), F.when(
        F.col("host").contains("-"), F.col("host"))).alias("t"))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def made(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                           pa.array(list(counts.values()), pa.int64())],
                                          schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in PARTS.findall(text):
                    if len(word) <= LONGEST and not word.isdigit():
                        counts[word] = counts.get(word, 0) + 1
            if len(counts) >= MOST_HELD:
                yield made(counts)
                counts = {}
        yield made(counts)
    prior = parted.sparkSession.createDataFrame([(w, PRIOR_COUNT) for w in PRIOR_WORDS],
                                                "word string, n long")
    return written(heard.mapInArrow(run, "word string, n long").unionByName(prior)
                   .groupBy("word").agg(F.sum("n").alias("n")), "url-unigrams")


def splits(parted: DataFrame, counts: DataFrame) -> DataFrame:
    """``(part, split)``: the words, joined by blanks, of each distinct run of letters in urls."""
    def run_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            for column in batch.columns:
                for text in column.to_pylist():
                    seen.update(filter(is_letters, parts_of(text)))
            if len(seen) >= MOST_HELD:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["part"])
                seen = set()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["part"])
    parts = written(parted.select("host", "path").mapInArrow(run_parts, "part string").distinct()
                    .withColumn("id", F.monotonically_increasing_id()), "url-letters")
    pair = pa.schema([("id", pa.int64()), ("word", pa.string())])

    def run_subs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(pair)
        for batch in batches:
            for part, number in zip(*(c.to_pylist() for c in batch.columns)):
                for k in range(0, len(part), MOST_HELD // LONGEST):
                    starts = range(k, min(len(part), k + MOST_HELD // LONGEST))
                    for sub in {part[i:j] for i in starts
                                for j in range(i + 1, min(len(part), i + LONGEST) + 1)}:
                        out.add(number, sub, weight=len(sub))
                        if out.full:
                            yield out.take()
        yield from out.rest()
    held = (parts.select("part", "id").mapInArrow(run_subs, "id long, word string").distinct()
            .join(counts, "word"))
    known = held.groupBy("id").agg(F.collect_list("word").alias("words"),
                                   F.collect_list("n").alias("ns"))
    total = math.log(float(counts.agg(F.sum("n")).first()[0]) + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            split = [" ".join(split_letters(p, dict(zip(w or (), n or ())), total))
                     for p, w, n in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(split, pa.string())],
                                             ["part", "split"])
    return written(parts.join(known, "id", "left").select("part", "words", "ns")
                   .mapInArrow(run, "part string, split string"), "url-splits")


def with_words(parted: DataFrame, split: DataFrame) -> DataFrame:
    """``parted`` with ``own`` and ``rest``: the words of host and path, joined by blanks."""
    schema = pa.schema([("row", pa.int64()), ("side", pa.int32()), ("at", pa.int32()),
                        ("part", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Rows(schema)
        for batch in batches:
            for row, *texts in zip(*(c.to_pylist() for c in batch.columns)):
                for side, text in enumerate(texts):
                    for at, part in enumerate(parts_of(text)):
                        out.add(row, side, at, part, weight=len(part))
                        if out.full:
                            yield out.take()
        yield from out.rest()
    tokens = parted.select("row", "host", "path").mapInArrow(
        run, "row long, side int, at int, part string").join(split, "part", "left")
    listed = tokens.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        "side", "at", F.coalesce("split", "part").alias("words")))).alias("all"))

    def side(k: int) -> Column:
        return F.coalesce(F.array_join(F.transform(F.filter("all", lambda t: t["side"] == k),
                                                   lambda t: t["words"]), " "), F.lit(""))
    return written(parted.drop("html").join(listed, "row", "left")
                   .withColumn("own", side(0)).withColumn("rest", side(1)).drop("all"),
                   "url-words")


def log_odds(tokens: DataFrame) -> tuple[DataFrame, float]:
    """``(token, odds)``: log odds of "block" given a token, with add-one counts; and the prior's.

    ``tokens`` has a row per url: ``tokens`` (array) and ``bad``, its weak label.
    """
    spread = tokens.select("bad", F.explode("tokens").alias("token"))
    counts = written(spread.groupBy("token").agg(
        F.count_if(F.col("bad")).alias("bad"), F.count_if(~F.col("bad")).alias("good")), "url-tokens")
    all_bad, all_good, used = counts.agg(F.sum("bad"), F.sum("good"), F.count(F.lit(1))).first()
    urls, bad_urls = tokens.agg(F.count(F.lit(1)), F.count_if(F.col("bad"))).first()

    def share(n: str, total: int | None) -> Column:
        return (F.col(n) + 1) / F.lit(float((total or 0) + max(used, 1)))
    odds = F.log(share("bad", all_bad)) - F.log(share("good", all_good))
    return (counts.select("token", odds.alias("odds")),
            math.log((bad_urls + 1) / (urls - bad_urls + 1)))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict, words, log_odds)`` of every url."""
    parted = written(pages.select(F.col("page_id").cast("long").alias("page_id"),
                                  host_of(F.col("url")).alias("host"),
                                  path_of(F.col("url")).alias("path"), "html").select(
        "page_id", "host", "path", F.regexp_extract(F.coalesce("html", F.lit("")),
                                                    r"(?is)<title>[^<]*", 0).alias("html"),
        F.monotonically_increasing_id().alias("row")),
        "url-parts")
    worded = with_words(parted, splits(parted, unigrams(parted)))
    seeds = F.array(*[F.lit(w) for w in sorted(SEED_WORDS)])
    tokens = (worded.withColumn("tokens", features())
              .withColumn("bad", F.arrays_overlap(F.split("own", " "), seeds)))
    odds, prior = log_odds(tokens)
    # a token counts as often as a url has it; a frequent one is joined to a single row of odds
    sums = (tokens.select("row", F.explode("tokens").alias("token"))
            .groupBy("row", "token").agg(F.count(F.lit(1)).alias("n")).join(odds, "token")
            .groupBy("row").agg(F.round(F.sum(F.col("n") * F.col("odds")), 9).alias("own_odds")))
    rule, decided = fitting_rule(F.col("host"), F.col("path"), rules)
    scored = (tokens.join(sums, "row", "left")
              .withColumn("log_odds", F.lit(prior) + F.coalesce("own_odds", F.lit(0.0))))
    method = F.when((F.col("host") != "") & (F.col("log_odds") > MARGIN), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(decided, method).alias("verdict"),
                         F.array_join("tokens", " ").alias("words"), "log_odds")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return judge(table(spark, sf_dir, "pages"))
