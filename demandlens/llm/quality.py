"""Quality rules with distribution divergence.

Base rules count words, symbols, repeated lines and words in repeated five-word windows. The
method then compares two histograms of a document with those of its language by
Jensen-Shannon divergence (its root, the distance, base 2, is between 0 and 1):

* character classes: lower-case ASCII letters, capitals, digits, separators, sentence marks,
  symbols, other characters;
* common words: the fixed common words of the language, and all other words.

References are the summed histograms of all documents of the language, one small row per
language, by one map-side combinable aggregate. Documents too short for a histogram
(``LEAST_CHARS``, ``LEAST_WORDS``) are not judged by it.

The most word distance is relative to the distance that a text without any common word has from
the same reference: common words are a minor share of all words, so even that distance is far
below 1. A share of it is allowed, and what chance adds to a plain text of so many words.

Only built-in functions are used. Five-word windows are compared by their 64-bit hashes within
one document; a document without equal hashes skips the rest of that rule.

Defined cases: a null text counts as empty: it has no words and fails the base rule. Every value
of ``lang``, null among them, has a reference of its own. The common words are those of the part
before the first ``-`` or ``_``, in any case (``en-US``, ``EN``); a language without a list, or
null, is judged by its character classes only, and its word distance is null. Repeated rows get equal results. Empty tables give empty results. ``judge`` replaces
columns of the input that have the name of a result column (or begin with ``q_``);
``keep_good`` returns all columns unchanged.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm._common import SEPARATOR_RUN, SEPARATORS, table, text_or_empty, written

# fixed values: common words by language
COMMON = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "for", "was", "on", "are", "with"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "ist"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"),
}
WINDOW = 5
LEAST_WORDS_BASE = 10
MOST_REPEATED_PERCENT = 20
LEAST_CHARS = 200
LEAST_WORDS = 50
MOST_CHAR_DISTANCE = 0.30
MOST_WORD_DISTANCE = 0.50        # whatever the reference
# of the distance of a text without common words: this share, and WORD_NOISE / sqrt(words), between
# the least and the most share
WORD_SHARE, LEAST_WORD_SHARE, MOST_WORD_SHARE = 0.35, 0.50, 0.90
WORD_NOISE = 1.4
LEAST_BARE_DISTANCE = 0.20       # a reference of few common words is not narrower than this

SENTENCE_MARKS = r"[.,;:!?'\"()-]"
SYMBOLS = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E&&[^.,;:!?'\"()-]]"
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
          "kept")


def _count(pattern: str) -> Column:
    return F.regexp_count("q_text", F.lit(pattern)).cast("long")


def _list_of(lang: str) -> Column:
    """The language whose common words a value of ``lang`` uses."""
    return F.lower(F.regexp_extract(F.col(lang), r"\A([A-Za-z]+)(?:[-_].*)?\z", 1))


def _nonempty(parts: str) -> Column:
    """Pieces without an empty first or last one."""
    lead = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size(parts) > 1) & (F.get(parts, F.size(parts) - 1) == ""), 1).otherwise(0)
    return F.slice(parts, lead + 1, F.greatest(F.size(parts) - lead - tail, F.lit(0)))


def with_histograms(docs: DataFrame) -> DataFrame:
    """``docs`` with ``q_*`` columns: text, language, its list, lengths, and the two histograms.

    Words are counted without an array of them: with two spaces between words and one at
    either end, `` the `` occurs once per word "the", and taking it out shortens the text.
    """
    base = (docs.withColumn("q_text", text_or_empty()).withColumn("q_lang", F.col("lang"))
            .withColumn("q_list", _list_of("lang"))
            .withColumn("q_trim", F.regexp_replace(
                F.lower(F.btrim("q_text", F.lit(SEPARATORS))), SEPARATOR_RUN, "  ")))
    spaced = base.withColumn("q_spaced", F.concat(F.lit(" "), F.col("q_trim"), F.lit(" ")))

    def times(piece: str, text: str) -> Column:
        gone = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(piece), F.lit("")))
        return F.floor(gone / len(piece.encode())).cast("long")

    def held(words: tuple[str, ...]) -> Column:
        return F.array(*[times(f" {w} ", "q_spaced") for w in words])
    n_common = max(map(len, COMMON.values()))
    common = reduce(lambda c, lang: F.when(F.col("q_list") == lang, held(COMMON[lang])).otherwise(c),
                    COMMON, F.array_repeat(F.lit(0).cast("long"), n_common))
    classes = [_count("[A-Z]"), _count("[0-9]"), _count(r"[\x20\x09-\x0D]"), _count(SENTENCE_MARKS),
               _count(SYMBOLS), _count(r"[^\x00-\x7F]")]
    counted = (spaced.withColumn("q_common", common).withColumn("q_some", F.array(*classes))
               .withColumn("q_n", F.when(F.col("q_trim") == "", F.lit(0).cast("long"))
                           .otherwise(times("  ", "q_trim") + 1))
               .withColumn("q_chars", F.char_length("q_text").cast("long"))
               .drop("q_trim", "q_spaced"))
    some = F.aggregate("q_some", F.lit(0).cast("long"), lambda a, x: a + x)
    known_words = F.aggregate("q_common", F.lit(0).cast("long"), lambda a, x: a + x)
    return (counted.withColumn("q_char_hist", F.concat(F.array(F.col("q_chars") - some), "q_some"))
            .withColumn("q_word_hist", F.concat(F.array(F.col("q_n") - known_words), "q_common"))
            .drop("q_some", "q_common"))


def references(histograms: DataFrame) -> DataFrame:
    """``(q_ref, r_char, r_word)``: summed histograms, one row per value of ``lang``."""
    def summed(column: str, size: int) -> Column:
        return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(size)])
    n_words = 1 + max(map(len, COMMON.values()))
    return histograms.groupBy(F.col("q_lang").alias("q_ref")).agg(summed("q_char_hist", 7).alias("r_char"),
                                            summed("q_word_hist", n_words).alias("r_word"))


def js_distance(p: Column | str, q: Column | str) -> Column:
    """Jensen-Shannon distance, base 2, of two histograms; null where one is empty."""
    def share(column: Column | str) -> Column:
        total = F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.transform(column, lambda x: x / F.nullif(total, F.lit(0)))

    def term(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
    parts = F.zip_with(share(p), share(q), lambda a, b: (
        term(a, (a + b) / 2) + term(b, (a + b) / 2)) / 2)
    total = F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.abs(total))          # rounding can leave a zero just below zero


def bare_distance() -> Column:
    """The distance that a text without common words has from the reference ``r_word``."""
    bare = F.transform("r_word", lambda x, i: F.when(i == 0, 1).otherwise(0).cast("long"))
    return js_distance(bare, "r_word")


def most_word_distance() -> Column:
    bare = F.greatest(F.col("q_bare"), F.lit(LEAST_BARE_DISTANCE))
    noise = F.lit(WORD_NOISE) / F.sqrt(F.greatest(F.col("q_n"), F.lit(1)))
    return F.least(F.lit(MOST_WORD_DISTANCE), F.lit(MOST_WORD_SHARE) * bare, F.greatest(
        F.lit(LEAST_WORD_SHARE) * bare, F.lit(WORD_SHARE) * bare + noise))


def base_measures(df: DataFrame) -> DataFrame:
    """The base rule's numbers, from what ``with_histograms`` adds."""
    df = (df.withColumn("q_parts", F.split("q_text", SEPARATOR_RUN))
          .withColumn("q_words", _nonempty("q_parts")).drop("q_parts"))
    lines = F.filter(F.split("q_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    grams = F.when(F.col("q_n") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.greatest(F.col("q_n").cast("int") - WINDOW, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("q_words", i + j) for j in range(WINDOW)]))).otherwise(
        F.array().cast("array<bigint>"))
    step = (df.withColumn("q_lines", lines).withColumn("q_grams", grams)
            .withColumn("n_dup_lines", (F.size("q_lines") - F.size(F.array_distinct("q_lines")))
                        .cast("long"))
            .withColumn("q_same", F.size(F.array_distinct("q_grams")) < F.size("q_grams"))
            .drop("q_lines"))
    # sorted (hash, place): equal neighbours are windows found again
    step = step.withColumn("q_sorted", F.when(F.col("q_same"), F.array_sort(F.transform(
        "q_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))).drop("q_grams")
    step = step.withColumn("q_twice", F.when(F.col("q_same"), F.array_sort(F.filter(
        F.transform("q_sorted", lambda s, k: F.when(
            F.coalesce(s["g"] == F.get("q_sorted", k - 1)["g"], F.lit(False))
            | F.coalesce(s["g"] == F.get("q_sorted", k + 1)["g"], F.lit(False)), s["i"])),
        lambda i: i.isNotNull())))).drop("q_sorted")
    covered = F.aggregate(F.transform("q_twice", lambda p, k: F.least(
        F.lit(WINDOW), F.coalesce(F.get("q_twice", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return (step.withColumn("n_repeat_words", F.when(F.col("q_same"), covered).otherwise(
                F.lit(0).cast("long")))
            .withColumn("n_words", F.col("q_n"))
            .withColumn("word_chars", (F.col("q_chars") - F.get("q_char_hist", F.lit(3))))
            .withColumn("n_symbols", _count("[#*$%&|<>]"))
            .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS_BASE) | (
                100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))
            .drop("q_twice", "q_same"))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the base numbers and the histograms.

    ``q_part``, a column that Spark must not compute twice, keeps filters on the numbers above
    this step. Pushed below it they would be spelled out in terms of the text, and each array
    that the steps share would be made again for each of its elements.
    """
    own = docs.drop(*[c for c in docs.columns if c in RESULT or c.startswith("q_")])
    return base_measures(with_histograms(own)).drop("q_text", "q_words").withColumn(
        "q_part", F.monotonically_increasing_id())


def decide(measured: DataFrame, refs: DataFrame) -> DataFrame:
    """Distances to the references, and the verdict."""
    refs = refs.withColumn("q_bare", bare_distance())
    judged = (measured.join(refs, F.col("q_lang").eqNullSafe(F.col("q_ref")), "left")
              .withColumn("char_distance", F.when(F.col("q_chars") >= LEAST_CHARS,
                                                  js_distance("q_char_hist", "r_char")))
              .withColumn("word_distance", F.when((F.col("q_n") >= LEAST_WORDS)
                                                  & F.col("q_list").isin(*COMMON),
                                                  js_distance("q_word_hist", "r_word"))))
    fine = (F.coalesce(F.col("char_distance") <= MOST_CHAR_DISTANCE, F.lit(True))
            & F.coalesce(F.col("word_distance") <= most_word_distance(), F.lit(True)))
    return judged.withColumn("kept", ~F.col("base_failed") & fine & (F.col("q_part") >= 0))


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the base numbers, ``char_distance``, ``word_distance`` and ``kept``.

    Two passes over the texts: the references first, so that no text is written or shuffled.
    """
    refs = written(references(with_histograms(docs.select("text", "lang"))), "quality-refs",
                   files=1)
    own = [c for c in docs.columns if c not in RESULT and not c.startswith("q_")]
    return decide(measure(docs), refs).select(*own, *RESULT, "char_distance", "word_distance")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that the rules keep, with the columns of ``docs`` as they are.

    Texts are counted once: the rows are written with their numbers, and references and
    verdicts come from there.
    """
    whole = docs.select("text", "lang", F.struct(*docs.columns).alias("whole"))
    measured = written(measure(whole).drop("text", "lang"), "quality-measures")
    return decide(measured, references(measured)).where("kept").select("whole.*")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers and the verdict for every document; texts are read once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = written(measure(docs).drop("text"), "quality-measures")
    return decide(measured, references(measured)).select("doc_id", *RESULT, "char_distance",
                                                         "word_distance")
