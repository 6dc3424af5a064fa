"""Mixing sources to target weights by entropy balancing.

Sources get token targets; document rates are the ones closest in relative entropy to "every
document once" that meet the targets. The convex dual has one multiplier per source, and the
rate of a document is ``min(cap, exp(multiplier * size / mean size))``. Newton steps on the dual run
as Spark aggregations, over (source, size) cells: documents of equal size in a source have
equal rates, so the cells are an exact pre-aggregate and a source with a third of all rows
is summed like any other.

Rates are rounded into whole copies on the cells, which get a number of copies each:

1. The ``LARGEST`` largest sizes of a source are fixed one after another, from the largest down.
   Each takes the number nearest to what the rates ask for that the smaller documents can still
   make up, so a document that dominates its source is decided first and the rest adapts.
2. The other sizes take the steps of the cumulated copies in order of size; their words are
   then off by less than their largest size.
3. What is left over is moved one cell at a time, by the copies that bring a source nearest to its
   target, until every source is within ``NEAR`` of it (or half a word) or no move of a cell improves
   it. Only then the documents of a cell share its copies: all get the whole part, and those that
   come first in the order of a seeded hash one more.

No step works on documents but the last, and none ranks all sources in one task: sources are
numbered by a range-partitioned sort, and the level of the targets is found by sums.

Defined cases: a null text has size 0; documents of size 0 take 0 words; null sources form
one source, ordered last; a null doc_id is hashed like any value; rows that repeat id, source and
size are counted once each, and which of them takes one copy more cannot be told from outside.
Empty tables give empty results. Clashing names: the operator reads only the named columns and
returns its own; ``take`` returns all columns, and reserves names that begin with ``__mix``. All
sums that decide anything are exact or rounded to fixed decimals, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.llm._common import table, text_or_empty, word_count, written

WEIGHTS = (3.0, 1.0, 2.0)        # by source in code point order, repeating
SHARE = 1.5                      # of all sizes
CAP = 2.0                        # most copies of a document, and of a source
NEWTON_STEPS = 40                # most steps; they end once all sources meet their target
TOLERANCE = 1e-6                 # relative, of the rates
LARGEST = 256                    # sizes of a source that are fixed one after another
NEAR = 1e-5                      # relative, of the copies
PART = 16_384                    # documents of a cell that are put in order together
ROWS = 4096                      # repeated rows that are written out together
SEED = 20
STEEPEST = 60.0                  # a multiplier beyond +-this leaves every rate at a bound


def numbered(per: DataFrame, by: str = "source") -> DataFrame:
    """``per`` with ``place``: 1 for the first value of ``by``, nulls last.

    Partitions of a range-partitioned sort number their own rows; what lies before a partition
    is a sum over one row per partition.
    """
    dealt = written(per.repartitionByRange(F.col(by).asc_nulls_last())
                    .withColumn("part", F.spark_partition_id()), "mix-ranges")
    own = Window.partitionBy("part").orderBy(F.col(by).asc_nulls_last())
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n"))
                           .alias("before"))
    return (dealt.withColumn("own", F.row_number().over(own)).join(before, "part")
            .withColumn("place", (F.col("before") + F.col("own")).cast("long"))
            .drop("part", "own", "before"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   cap: float = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size, n)`` counts.

    A target is ``min(cap * source_size, level * weight)``. The level rises from where no source is
    full: what full sources cannot take is shared again by weight until none is above. Each round
    is one aggregate that gives a row per weight.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long")
                                      .alias("source_size"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    ranked = written(numbered(per).select("source", "source_size", w.alias("w")), "mix-sources")
    most = F.lit(cap) * F.col("source_size")
    level, full = 0.0, -1
    while True:
        above = most <= F.lit(level) * F.col("w")
        sums = ranked.groupBy("w", above.alias("above")).agg(
            F.sum("source_size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
        now = sum(r.n for r in sums if r.above)
        free = sum(r.w * r.n for r in sums if not r.above)
        if now == full or not free:
            break
        full = now
        rest = share * sum(r["size"] for r in sums) - cap * sum(r["size"] for r in sums if r.above)
        level = rest / free
    target = F.when(above, most).otherwise(F.lit(level) * F.col("w"))
    return ranked.select("source", "source_size", target.alias("target"))


def _rate(cap: float):
    """The tilted rate for multiplier ``m`` and scaled size ``x``."""
    return F.least(F.lit(cap), F.exp(F.greatest(F.lit(-700.0), F.least(
        F.lit(700.0), F.col("m") * F.col("x")))))


def solve_multipliers(sizes: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """``(source, mean_size, m)``: the dual's solution by distributed Newton iterations.

    Per source the dual's gradient is ``sum(rate * size) - target``. Newton's step is kept
    inside the bracket known so far (else halved), which makes it safe where the cap bends
    the gradient.
    """
    cells = written(sizes.where("size > 0"), "mix-cells", files=8)
    stats = cells.groupBy("source").agg(
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_size"))
    state = (targets.join(stats, targets.source.eqNullSafe(stats.source), "inner")
             .select(targets.source, "mean_size", "target",
                     F.when(F.col("target") >= F.col("source_size") * cap, F.lit(STEEPEST))
                     .otherwise(F.lit(0.0)).alias("m"),
                     F.lit(-STEEPEST).alias("low"), F.lit(STEEPEST).alias("high"),
                     (F.col("target") >= F.col("source_size") * cap).alias("done")))
    state = written(state, "mix-state", files=2)
    for _ in range(NEWTON_STEPS):
        s, c = state.alias("s"), cells.alias("c")
        x = (F.col("c.size") / F.col("s.mean_size"))
        rated = (c.join(s, F.col("c.source").eqNullSafe(F.col("s.source")))
                 .select(F.col("s.source").alias("source"), F.col("s.m").alias("m"),
                         x.alias("x"), F.col("c.size").alias("size"), F.col("c.n").alias("n"))
                 .withColumn("rate", _rate(cap)))
        sums = rated.groupBy("source").agg(
            F.round(F.sum(F.col("rate") * F.col("size") * F.col("n")), 4).alias("got"),
            F.round(F.sum(F.when(F.col("rate") < cap, F.col("rate") * F.col("x")
                                 * F.col("size") * F.col("n")).otherwise(0.0)), 4).alias("slope"))
        g = sums.alias("g")
        rest = F.col("g.got") - F.col("s.target")
        low = F.when(rest < 0, F.col("s.m")).otherwise(F.col("s.low"))
        high = F.when(rest > 0, F.col("s.m")).otherwise(F.col("s.high"))
        newton = F.col("s.m") - rest / F.nullif(F.col("g.slope"), F.lit(0.0))
        inside = newton.isNotNull() & (newton > low) & (newton < high)
        met = F.abs(rest) <= F.lit(TOLERANCE) * F.greatest(F.col("s.target"), F.lit(1.0))
        state = written(s.join(g, F.col("s.source").eqNullSafe(F.col("g.source"))).select(
            F.col("s.source").alias("source"), F.col("s.mean_size").alias("mean_size"),
            F.col("s.target").alias("target"),
            F.when(F.col("s.done") | met, F.col("s.m"))
            .otherwise(F.round(F.when(inside, newton).otherwise((low + high) / 2), 12)).alias("m"),
            low.alias("low"), high.alias("high"), (F.col("s.done") | met).alias("done")),
            "mix-state", files=2)
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select("source", "mean_size", F.round("m", 9).alias("m"))


def round_cells(cells: DataFrame, targets: DataFrame, solved: DataFrame,
                cap: float = CAP) -> DataFrame:
    """``(source, size, n, target, source_size, rate, k)``: copies ``k`` of every cell.

    ``cells`` has ``source, size, n`` and no cell of size 0.
    """
    most = int(cap)
    t, v = targets.alias("t"), solved.alias("v")
    model = (t.join(v, F.col("t.source").eqNullSafe(F.col("v.source")))
             .select("t.source", "source_size", "target", "mean_size", "m"))
    c, k = cells.alias("c"), model.alias("k")
    rated = (c.join(k, F.col("c.source").eqNullSafe(F.col("k.source")))
             .select("c.source", "c.size", "c.n", "target", "source_size",
                     (F.col("c.size") / F.col("mean_size")).alias("x"), "m")
             .withColumn("rate", F.when(F.col("target") >= F.lit(cap) * F.col("source_size"),
                                        F.lit(cap)).otherwise(F.round(_rate(cap), 9)))
             .drop("x", "m"))
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    whole = Window.partitionBy("source")
    ideal = F.col("rate") * F.col("n") * F.col("size")
    placed = (rated.withColumn("place", F.row_number().over(down))
              .withColumn("below", F.col("source_size") - F.sum(F.col("size") * F.col("n")).over(down))
              .withColumn("asked", F.round(F.sum(ideal).over(whole) - F.sum(ideal).over(down), 4)))
    placed = written(placed, "mix-placed")

    # 1: the largest sizes, one after another
    step = F.struct("place", "size", "n", "below", "asked")
    top = placed.where(F.col("place") <= LARGEST).groupBy("source").agg(
        F.array_sort(F.collect_list(step)).alias("cells"), F.first("target").alias("target"))

    def fix(state, cell):
        rest, size = state["rest"], cell["size"]
        high = F.floor(rest / size)
        low = F.ceil((rest - F.lit(cap) * cell["below"]) / size)
        over = rest - high * size
        wanted = F.when(low <= high, F.greatest(low, F.least(high, F.round(
            (rest - cell["asked"]) / size).cast("long")))).otherwise(
            F.when(over - F.lit(cap) * cell["below"] <= size - over, high).otherwise(high + 1))
        copies = F.greatest(F.lit(0).cast("long"), F.least(
            cell["n"] * most, wanted)).cast("long")
        return F.struct((rest - copies * size).cast("double").alias("rest"),
                        F.concat(state["ks"], F.array(copies)).alias("ks"))
    start = F.struct(F.col("target").cast("double").alias("rest"),
                     F.array().cast("array<bigint>").alias("ks"))
    fixed = (top.withColumn("ks", F.aggregate("cells", start, fix, lambda s: s["ks"]))
             .select("source", F.explode(F.arrays_zip("cells", "ks")).alias("e"))
             .select("source", F.col("e.cells.size").alias("size"), F.col("e.ks").alias("k")))

    # 2: the others, by the steps of the cumulated copies
    upto = F.sum(F.col("rate") * F.col("n")).over(down)
    smaller = placed.where(F.col("place") > LARGEST).withColumn("upto", F.round(upto, 6))
    stepped = smaller.select("source", "size", (
        F.floor(F.col("upto") + 0.5) - F.floor(F.round(
            F.col("upto") - F.col("rate") * F.col("n"), 6) + 0.5)).alias("k"))
    both = fixed.unionByName(stepped).alias("b")
    p = placed.alias("p")
    now = written(p.join(both, F.col("p.source").eqNullSafe(F.col("b.source"))
                         & (F.col("p.size") == F.col("b.size")))
                  .select("p.source", "p.size", "p.n", "p.target", "p.source_size", "p.rate",
                          F.greatest(F.lit(0), F.least(F.col("p.n") * most, F.col("b.k")))
                          .cast("long").alias("k")), "mix-cells")

    # 3: what is left over, one cell at a time
    while True:
        rest = (now.groupBy("source").agg(
            F.round(F.first("target") - F.sum(F.col("k") * F.col("size")), 3).alias("rest"),
            F.first("target").alias("t")).where(F.abs("rest") > F.greatest(
                F.lit(0.5), F.lit(NEAR) * F.col("t"))))
        a, r = now.alias("a"), rest.alias("r")
        moved = F.greatest(-F.col("k"), F.least(
            F.col("n") * most - F.col("k"), F.round(F.col("rest") / F.col("size")).cast("long")))
        moves = (a.join(r, F.col("a.source").eqNullSafe(F.col("r.source")))
                 .select("a.source", "size", "rest", moved.alias("j"))
                 .withColumn("left", F.round(F.abs(F.col("rest") - F.col("j") * F.col("size")), 3))
                 .where(F.col("left") < F.abs("rest"))
                 .groupBy("source").agg(F.min(F.struct("left", "size", "j")).alias("best")))
        moves = written(moves.select("source", "best.size", "best.j"), "mix-moves", files=2)
        if moves.isEmpty():
            return now
        g = moves.alias("g")
        now = written(a.join(g, F.col("a.source").eqNullSafe(F.col("g.source"))
                             & (F.col("a.size") == F.col("g.size")), "left")
                      .select("a.source", "a.size", "n", "target", "source_size", "rate",
                              (F.col("k") + F.coalesce("j", F.lit(0))).cast("long").alias("k")),
                      "mix-cells")


def share_out(rows: DataFrame, plan: DataFrame, keys: list[str]) -> DataFrame:
    """Copies of distinct ``(source, size, *keys)`` rows that stand for ``g`` rows each:
    ``base`` copies for all of them and one more for ``plus`` of them.

    A large cell is put in order in parts of about ``PART`` rows, by the same hash.
    """
    r, p = rows.alias("r"), plan.alias("p")
    draw = F.xxhash64(F.lit(SEED), *[F.col(f"r.`{c}`") for c in keys], F.col("r.size"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("p.n") / PART)).cast("long")
    joined = (r.join(p, F.col("r.source").eqNullSafe(F.col("p.source"))
                     & (F.col("r.size") == F.col("p.size")), "left")
              .select("r.*", "p.n", "rate", "k", draw.alias("draw"),
                      F.when(F.col("p.n") > PART, F.pmod(draw, parts)).alias("part")))
    cell = ("source", "size")
    sums = joined.where("part is not null").groupBy(*cell, "part").agg(F.sum("g").alias("in_part"))
    before = sums.select(*cell, "part", (F.sum("in_part").over(
        Window.partitionBy(*cell).orderBy("part")) - F.col("in_part")).alias("before"))
    order = Window.partitionBy(*cell, "part").orderBy("draw", *[F.col(f"`{c}`") for c in keys])
    upto = joined.withColumn("upto", F.sum("g").over(order.rowsBetween(
        Window.unboundedPreceding, Window.currentRow)))
    u, b = upto.alias("u"), before.alias("b")
    ahead = F.coalesce("before", F.lit(0)) + F.col("upto") - F.col("g")
    return (u.join(b, F.col("u.source").eqNullSafe(F.col("b.source"))
                   & (F.col("u.size") == F.col("b.size")) & (F.col("u.part") == F.col("b.part")),
                   "left")
            .select(*[F.col(f"u.`{c}`") for c in rows.columns],
                    F.coalesce("rate", F.lit(0.0)).alias("rate"),
                    F.coalesce(F.floor(F.col("k") / F.col("n")), F.lit(0)).cast("long").alias("base"),
                    F.when(F.col("k").isNotNull(), F.greatest(F.lit(0), F.least(
                        F.col("g"), F.col("k") % F.col("n") - ahead))).otherwise(0)
                    .cast("long").alias("plus")))


def plan_copies(sized: DataFrame, keys: list[str], weights=WEIGHTS, share: float = SHARE,
                cap: float = CAP) -> DataFrame:
    """``(source, size, *keys, g, source_size, target, rate, base, plus)`` of distinct rows."""
    rows = written(sized.withColumn("size", F.col("size").cast("long"))
                   .groupBy("source", "size", *keys).agg(F.count(F.lit(1)).alias("g")), "mix-rows")
    sizes = written(rows.groupBy("source", "size").agg(F.sum("g").alias("n")), "mix-sizes")
    targets = written(source_targets(sizes, weights, share, cap), "mix-targets", files=2)
    solved = solve_multipliers(sizes, targets, cap)
    plan = round_cells(sizes.where("size > 0"), targets, solved, cap)
    shared = share_out(rows, plan.select("source", "size", "n", "rate", "k"), keys)
    s, t = shared.alias("s"), targets.alias("t")
    return s.join(t, F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        "s.*", "source_size", "target")


def mix(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Copies per document: ``(doc_id, source, size, source_size, target, rate, copies, taken)``.

    ``sized`` has ``doc_id, source, size``. ``taken = copies * size`` and ``copies <= cap``.
    """
    planned = written(plan_copies(sized.select("doc_id", "source", "size"), ["doc_id"], weights,
                                  share, cap), "mix-planned")
    one = planned.where(F.col("g") == 1).withColumn("copies", F.col("base") + F.col("plus"))
    # repeated rows are written out in parts, so that none of them fills a task
    parts = (planned.where(F.col("g") > 1)
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("g") - 1) / ROWS))))
             .repartition("doc_id", "size", "part"))
    many = (parts.withColumn("j", F.explode(F.sequence(
                F.col("part") * ROWS + 1, F.least(F.col("g"), (F.col("part") + 1) * ROWS))))
            .withColumn("copies", F.col("base") + F.when(F.col("j") <= F.col("plus"), 1).otherwise(0))
            .drop("part", "j"))
    return one.unionByName(many).select(
        "doc_id", "source", "size", "source_size", "target", "rate",
        F.col("copies").cast("int").alias("copies"),
        (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def take(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; the size is the text's words.

    Rows are told apart by all their columns: rows that share an id have copies of their own.
    Wholly equal rows stand for each other.
    """
    own = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.withColumn("__mix_row", own)
    sized = rows.select("doc_id", "__mix_row", "source", word_count(text_or_empty()).alias("size"))
    planned = plan_copies(sized, ["doc_id", "__mix_row"], weights, share, cap)
    total = F.col("g") * F.col("base") + F.col("plus")
    taken = written(planned.select("doc_id", "__mix_row", "g", total.alias("total"))
                    .where("total > 0"), "mix-taken")
    d, t = rows.alias("d"), taken.alias("t")
    # the hash decides nearly always; the id, which may be null, only on top of it
    found = (d.join(t, (F.col("d.__mix_row") == F.col("t.__mix_row"))
                    & F.col("d.doc_id").eqNullSafe(F.col("t.doc_id")))
             .select("d.*", "t.g", F.col("t.total").alias("__mix_total")).withColumnRenamed(
                 "g", "__mix_g"))
    one = found.where(F.col("__mix_g") == 1)
    many = found.where(F.col("__mix_g") > 1).dropDuplicates(["doc_id", "__mix_row"])
    return (one.unionByName(many)
            .withColumn("__mix_copy", F.explode(F.sequence(F.lit(1).cast("long"),
                                                           F.col("__mix_total"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(text_or_empty()).alias("size"))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
