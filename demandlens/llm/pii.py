"""Personal data by bootstrapped contextual extraction.

Base spans are the matches of four fixed patterns that pass their checks. They are the seed
entities. Around seeds and around *candidates* (identifier-like strings that no base span
touches) the words before and after give lexical patterns. The graph of patterns and
instances (distinct normalised strings) is scored in rounds:

* a pattern's confidence is the share of its instances that are known, shrunk for patterns of few
  instances; patterns below ``LEAST_CONFIDENCE`` or with fewer than ``LEAST_SUPPORT`` known
  instances count for nothing;
* an instance's score is the chance that at least one of its patterns is right; instances
  that reach ``LEAST_SCORE`` become known for the next round.

Known candidates are added to the spans, with the kind of their pattern. So is every candidate
whose digits are those of a seed: the same identifier in another notation. Only built-in
functions run. Texts are read once: the spans and contexts that they hold go to a table, and
the rounds run over that table's edges, which are counted (pattern, instance) pairs.

Where matches lie: splitting a text by a pattern gives the pieces between the matches that
extracting all matches gives, so lengths of pieces and matches add up to positions in code points.

Patterns are written so that Java matches them in linear time and without recursion
(possessive, and starting only where a run starts or the last match ended); they match what
the plain forms in ``PLAIN`` match.

Defined cases: a null text counts as empty and has no spans; repeated rows get equal results,
and count as one document in the graph; null ids are matched like any id. Equal matches under
two kinds are two spans. Empty tables give empty results; other columns are not read, save by
``redact``, which keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlens.llm._common import table, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
# fixed values: the base patterns in plain form
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LINEAR = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a text where this is not found has no match of the kind
NEEDED = {"email": "@", "ip": r"\.", "card": "[0-9]", "phone": r"\+"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"      # a number up to 255

# identifier-like strings beside the base patterns, by the kind that they could be
LOOSE_EMAIL = (r"(?<![^\x20\x09-\x0D<>\"',;:()\[\]])[^\x20\x09-\x0D<>\"',;:()\[\]@]++"
               r"(?:@|\[at\]|\(at\))[^\x20\x09-\x0D<>\"',;:()\[\]@]++")
LOOSE_EMAIL_NEEDED = r"@|\[at\]|\(at\)"
LOOSE_NUMBER = r"(?<![0-9A-Za-z_.+-])[0-9](?:[\x20().:/-]{0,2}+[0-9])++(?![0-9A-Za-z_])"
LEAST_SUPPORT = 5
LEAST_CONFIDENCE = 0.9
LEAST_SCORE = 0.9
SHRINK = 0.25
ROUNDS = 3
CONTEXT_CHARS = 40


# ------------------------------------------------------------------------------ positions

def _sums_before(lengths: Column, name: str) -> Column:
    """Sum of the elements before each element, in blocks: O(k * sqrt k) for k elements."""
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(lengths))).cast("int"))

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(lengths) - 1), block)
    blocks = F.transform(starts, lambda s: total(F.slice(lengths, s + 1, block)))
    upto = F.transform(blocks, lambda _, i: total(F.slice(blocks, F.lit(1), i)))
    return F.transform(lengths, lambda _, i: F.get(upto, F.floor(i / block).cast("int")) + total(
        F.slice(lengths, i - i % block + 1, i % block)))


def _matches(df: DataFrame, name: str, pattern: str, needed: str) -> DataFrame:
    """``df`` with column ``name``: structs (s, e, v, before, after) of all matches in ``p_text``.

    ``before`` and ``after`` are the pieces of text next to the match, cut to the context.
    """
    might = F.col("p_text").rlike(needed)
    empty = F.array().cast("array<string>")
    step = df.withColumn("p_found", F.when(might, F.regexp_extract_all(
        "p_text", F.lit(pattern), 0)).otherwise(empty))
    step = step.withColumn("p_pieces", F.when(F.size("p_found") > 0, F.split(
        "p_text", pattern, -1)).otherwise(empty))
    step = step.withColumn("p_lengths", F.transform("p_found", lambda m, i: (
        F.char_length(m) + F.char_length(F.get("p_pieces", i))).cast("long")))
    step = step.withColumn("p_before", F.when(F.size("p_found") > 0, _sums_before(
        F.col("p_lengths"), name)).otherwise(F.array().cast("array<bigint>")))
    spans = F.transform("p_found", lambda m, i: F.struct(
        (F.get("p_before", i) + F.char_length(F.get("p_pieces", i))).cast("long").alias("s"),
        (F.get("p_before", i) + F.get("p_lengths", i)).cast("long").alias("e"), m.alias("v"),
        F.right(F.get("p_pieces", i), F.lit(CONTEXT_CHARS)).alias("before"),
        F.left(F.get("p_pieces", i + 1), F.lit(CONTEXT_CHARS)).alias("after")))
    return step.withColumn(name, spans).drop("p_found", "p_pieces", "p_lengths", "p_before")


# --------------------------------------------------------------------------------- checks

def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Every second digit from the right counts twice, less nine where that exceeds nine."""
    n = F.length(digits)
    doubled = F.transform(F.sequence(F.lit(1), n), lambda i: F.when(
        (n - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(d) for d in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                     F.substring(digits, i, F.lit(1)).cast("int") + 1)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"\A{OCTET}(?:\.{OCTET}){{3}}\z")
    n = F.length(_digits(value))
    if kind == "card":
        return F.when(n.between(16, 19), passes_luhn(_digits(value))).otherwise(F.lit(False))
    return n.between(8, 15)


# --------------------------------------------------------------------------------- spans

SPAN = "array<struct<kind:string,s:bigint,e:bigint,v:string,before:string,after:string>>"


def _overlaps(span: Column, others: str) -> Column:
    return F.exists(others, lambda o: (o["s"] < span["e"]) & (span["s"] < o["e"]))


def find_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, base, loose)``: base spans by kind and start, and candidates."""
    df = docs.select("doc_id", text_or_empty().alias("p_text")).withColumn(
        "th", F.xxhash64("p_text"))
    for kind in KINDS:
        df = _matches(df, f"p_{kind}", LINEAR[kind], NEEDED[kind])
    def checked(kind: str) -> Column:
        return F.transform(F.filter(f"p_{kind}", lambda m: _valid(kind, m["v"])),
                           lambda m: shaped(m, F.lit(kind)))

    def shaped(m: Column, kind: Column) -> Column:
        return F.struct(kind.alias("kind"), m["s"].alias("s"), m["e"].alias("e"),
                        m["v"].alias("v"), m["before"].alias("before"), m["after"].alias("after"))
    df = df.withColumn("base", F.concat(*map(checked, KINDS))).drop(*[f"p_{k}" for k in KINDS])
    df = _matches(df, "p_mail", LOOSE_EMAIL, LOOSE_EMAIL_NEEDED)
    df = _matches(df, "p_number", LOOSE_NUMBER, "[0-9]")

    def number_kind(value: Column) -> Column:
        n = F.length(_digits(value))
        return (F.when(value.rlike(r"\A[0-9]++(?:\.[0-9]++){3,}+\z"), "ip")
                .when(n.between(12, 19), "card").when(n.between(7, 11), "phone"))
    loose = F.concat(F.transform("p_mail", lambda m: shaped(m, F.lit("email"))),
                     F.transform("p_number", lambda m: shaped(m, number_kind(m["v"]))))
    free = F.filter(loose, lambda m: m["kind"].isNotNull() & ~_overlaps(m, "base"))
    return df.withColumn("loose", free).select("doc_id", "th", "base", "loose")


# ---------------------------------------------------------------------------- the graph

def _context_patterns(span: Column) -> Column:
    """Lexical patterns of a span: kind and the words before, after, or around it."""
    before = F.lower(F.regexp_extract(span["before"], r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]*\z", 1))
    two = F.lower(F.regexp_extract(
        span["before"], r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[\x20\x09-\x0D]*\z", 1))
    after = F.lower(F.regexp_extract(span["after"], r"\A[\x20\x09-\x0D]*([^\x20\x09-\x0D]+)", 1))

    def named(label: str, word: Column) -> Column:
        return F.when(word != "", F.concat_ws("|", span["kind"], F.lit(label), word))
    return F.filter(F.array(named("1", before), named("2", two), F.when(
        before != "", named("a", F.when(after != "", F.concat_ws(" ", before, F.lit("_"), after))))),
        lambda p: p.isNotNull())


def _instance(span: Column) -> Column:
    # the dots of an address tell 1.2.3.45 from 12.3.4.5
    return F.concat_ws("|", span["kind"], F.when(span["kind"].isin("email", "ip"), F.lower(span["v"]))
                       .otherwise(_digits(span["v"])))


def edges_of(found: DataFrame) -> DataFrame:
    """``(pattern, instance, seed)``: distinct edges over all documents.

    An occurrence without words around it has one edge, to the null pattern.
    """
    rows = found.select(F.explode(F.concat(
        F.transform("base", lambda m: F.struct(F.lit(True).alias("seed"), m.alias("m"))),
        F.transform("loose", lambda m: F.struct(F.lit(False).alias("seed"), m.alias("m"))))
    ).alias("o")).select("o.seed", "o.m")
    return (rows.select("seed", _instance(F.col("m")).alias("instance"),
                        F.explode_outer(_context_patterns(F.col("m"))).alias("pattern"))
            .groupBy("pattern", "instance").agg(F.max("seed").alias("seed")))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(instance, score)``: seeds, and candidates that became known."""
    edges = written(edges, "pii-edges")
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("seed"))
    known = seeds.select("instance", F.when(F.col("seed"), 1.0).otherwise(0.0).alias("score"))
    for _ in range(rounds):
        known = written(known, "pii-known")
        scored = edges.where("pattern is not null").join(known, "instance")
        hit = F.sum(F.when(F.col("score") >= LEAST_SCORE, F.lit(1)).otherwise(F.lit(0)))
        patterns = (scored.groupBy("pattern").agg(hit.alias("hits"), F.count(F.lit(1)).alias("n"))
                    .withColumn("confidence", F.col("hits") / (F.col("n") + SHRINK))
                    .where((F.col("hits") >= LEAST_SUPPORT)
                           & (F.col("confidence") >= LEAST_CONFIDENCE))
                    .select("pattern", "confidence"))
        reached = (edges.join(patterns, "pattern").groupBy("instance")
                   .agg(F.round(1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"),
                                                                 F.lit(0.999))))), 9)
                        .alias("reached")))
        known = (known.join(reached, "instance", "left").select(
            "instance", F.greatest(F.col("score"), F.coalesce("reached", F.lit(0.0)))
            .alias("score")))
    return written(known, "pii-known").where(F.col("score") >= LEAST_SCORE)


def all_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, base, added)``: base spans and what the method adds, per row."""
    found = written(find_spans(docs), "pii-found")
    chosen = written(bootstrap(edges_of(found)), "pii-chosen")
    held = found.where(F.size("loose") > 0).select("doc_id", "th", F.explode("loose").alias("m"))
    # a number of 12 to 15 digits is a card candidate, but may repeat a phone seed; no candidate is
    # a phone of that length, so only seeds match
    digits = F.length(_digits(F.col("m.v")))
    phone_too = (F.col("m.kind") == "card") & digits.between(12, 15)
    kinds = F.when(phone_too, F.array(F.lit("card"), F.lit("phone"))).otherwise(F.array("m.kind"))
    as_kind = held.withColumn("kind", F.explode(kinds)).withColumn(
        "m", F.col("m").withField("kind", F.col("kind")))
    own = (as_kind.withColumn("instance", _instance(F.col("m")))
           .join(chosen, "instance", "left_semi")
           .groupBy("doc_id", "th").agg(F.collect_set(F.struct("m.kind", "m.s", "m.e"))
                                        .alias("added")))
    f, o = found.alias("f"), own.alias("o")
    return (f.join(o, F.col("f.doc_id").eqNullSafe(F.col("o.doc_id"))
                   & (F.col("f.th") == F.col("o.th")), "left")
            .select("f.doc_id", "f.th", F.transform("f.base", lambda m: F.struct(
                m["kind"].alias("kind"), m["s"].alias("s"), m["e"].alias("e"))).alias("base"),
                F.coalesce("o.added", F.array().cast("array<struct<kind:string,s:bigint,e:bigint>>"))
                .alias("added")))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(
        ":", m["kind"], m["s"].cast("string"), m["e"].cast("string"))), ",")


def _in_order(spans: Column) -> Column:
    """Spans by kind as listed, then start."""
    ranked = F.transform(spans, lambda m: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), m["kind"]).alias("k"), m["s"].alias("s"),
        m["e"].alias("e"), m["kind"].alias("kind")))
    return F.array_sort(ranked)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets.

    Overlapping spans are replaced as one, under the kind of the first. Other columns stay; a
    null text stays null. Column names that begin with ``__pii`` are reserved.
    """
    spans = all_spans(docs)
    marked = (spans.where((F.size("base") > 0) | (F.size("added") > 0))
              .select("doc_id", "th", F.concat("base", "added").alias("spans")).distinct())
    d = docs.withColumn("__pii_th", F.xxhash64(text_or_empty())).alias("d")
    m = marked.alias("m")
    joined = d.join(m, F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
                    & (F.col("d.__pii_th") == F.col("m.th")), "left").select(
        *[F.col(f"d.`{c}`") for c in docs.columns], F.array_sort(F.transform(
            "m.spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"),
                                          x["kind"].alias("kind")))).alias("__pii_spans"))
    zero = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def put(state: Column, x: Column) -> Column:
        piece = F.substring(F.col("text"), (state["at"] + 1).cast("int"),
                            F.greatest(F.lit(0), x["s"] - state["at"]).cast("int"))
        return F.struct(
            F.when(x["s"] >= state["at"], F.concat(state["out"], piece, F.lit("["), x["kind"],
                                                   F.lit("]"))).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], x["e"]).alias("at"))
    done = F.aggregate("__pii_spans", zero, put, lambda state: F.concat(
        state["out"], F.substring(F.col("text"), (state["at"] + 1).cast("int"),
                                  F.char_length("text"))))
    return joined.select(*[
        (F.when(F.col("__pii_spans").isNull(), F.col("text")).otherwise(done).alias("text")
         if c == "text" else F.col(f"`{c}`")) for c in docs.columns])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and digest, and all spans, of every document."""
    found = all_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda m: m["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(number, KINDS),
                        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
                        _listed(_in_order(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))


