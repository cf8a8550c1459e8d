"""Mixing sources to target weights by entropy balancing.

Of all document rates w between 0 and `CAP`, entropy balancing takes those nearest to 1 in
relative entropy that give each source its target number of words. They are exponentially
tilted, w = min(CAP, exp(lambda_source * size / scale)), and lambda is where the convex
dual has its minimum; Newton steps with a bracket find it, each step one aggregate over the
table of (source, size, documents), which holds all that the dual needs. Rates are then
rounded to whole copies: a hash of the document is compared with the rate's fraction, and
a shift of the hash per source, found by histograms, takes most of the rounding error out;
a few documents that still fit take the rest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folio_sync.llm.common import WORDS, discarded, whole_text, written

CAP = 3.0
WEIGHTS = (5.0, 2.0, 1.0)
NEWTON_STEPS = 60
NEAR = 1e-9  # of the target
BINS = 512
FILLS = 6  # documents a source at most takes on top, each the largest that still fits


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, target: shares by weight of all words, none above cap * source_size.

    Sources get the weights in turn, in code point order with null last. The final shares
    are a water level: min(level * weight, cap * size), with the level that uses all words.
    The table has one row per source."""
    every = Window.partitionBy()
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    full = Window.orderBy(F.col("fills_at"), F.col("nth"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    number = F.row_number().over(in_order)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int"))
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    ahead = full.rowsBetween(0, Window.unboundedFollowing)
    levels = (
        sources.withColumn("nth", number).withColumn("weight", weight)
        .withColumn("room", cap * F.col("source_size"))
        .withColumn("fills_at", F.col("room") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every).cast("double"))
        .withColumn("taken_before", F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        .withColumn("weight_ahead", F.sum("weight").over(ahead))
        .withColumn("level", (F.col("total") - F.col("taken_before")) / F.col("weight_ahead"))
        # the first source, by what fills it, that the level does not fill sets the level
        .withColumn("first", F.min(F.when(
            F.col("fills_at") >= F.col("level"), F.struct("fills_at", "nth", "level"))).over(every))
    )
    target = F.least(F.coalesce(F.col("first.level") * F.col("weight"), F.col("room")), F.col("room"))
    return levels.select("source", "source_size", "n_docs", target.alias("target"))


def _rate(tilt: Column, cap: float) -> Column:
    return F.exp(F.least(tilt, F.lit(math.log(cap))))


def tilts(counted: DataFrame, targets: DataFrame, cap: float = CAP, steps: int = NEWTON_STEPS) -> DataFrame:
    """source, lambda, scale: where the dual of each source has its minimum, by Newton steps.

    `counted` is (source, size, n). A step that leaves the bracket is replaced by its middle.
    A source whose target is its whole room, or nothing, needs no tilt: null."""
    solved = written(
        targets.where("target > 0 and target < source_size * %r * (1 - 1e-12)" % cap)
        .select("source", "target", (F.col("source_size") / F.col("n_docs")).alias("scale"),
                F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"),
                F.lit(None).cast("double").alias("high"), F.lit(False).alias("done")),
        "tilts",
    )
    sized = written(counted.where("size > 0"), "sizes")
    for _ in range(steps):
        x = F.col("size") / F.col("scale")
        rate = _rate(F.col("lam") * x, cap)
        moments = (
            sized.join(solved.where("not done").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
            .groupBy("source")
            .agg(F.sum(F.col("n") * F.col("size") * rate).alias("words"),
                 F.sum(F.when(F.col("lam") * x < math.log(cap), F.col("n") * F.col("size") * x * rate)
                       .otherwise(0.0)).alias("slope"))
            .withColumnRenamed("source", "s")
        )
        gap = F.col("words") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - F.try_divide(gap, F.col("slope"))
        inside = newton.isNotNull() & ~F.isnan(newton) & (F.col("low").isNull() | (newton > F.col("low"))) & (
            F.col("high").isNull() | (newton < F.col("high")))
        middle = (
            F.when(F.col("low").isNull(), 2 * F.col("high") - 1)
            .when(F.col("high").isNull(), 2 * F.col("low") + 1)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        # without one side of the bracket a Newton step may go twice as far as the last one, plus one
        bounded = F.greatest(F.least(newton, 2 * F.abs(F.col("lam")) + 1), -2 * F.abs(F.col("lam")) - 1)
        moved = F.when(F.col("done"), F.col("lam")).otherwise(F.when(inside, bounded).otherwise(middle))
        last, solved = solved, written(
            solved.join(moments, F.col("source").eqNullSafe(F.col("s")), "left")
            .select("source", "target", "scale", "done", "lam", "words", "slope", gap.alias("gap"),
                    low.alias("low"), high.alias("high"))
            .select("source", "target", "scale",
                    F.when(F.col("gap").isNotNull() & (F.abs("gap") <= NEAR * F.col("target")), F.col("lam"))
                    .otherwise(moved).alias("lam"), "low", "high",
                    (F.col("done") | F.col("gap").isNull() | (F.abs("gap") <= NEAR * F.col("target"))
                     | F.coalesce(F.col("high") - F.col("low") < 1e-13, F.lit(False))).alias("done")),
            "tilts",
        )
        discarded(last)
        if solved.where("not done").isEmpty():
            break
    discarded(sized)
    return solved.select("source", "lam", "scale")


def _picked(binned: DataFrame, needs: DataFrame, label: str) -> DataFrame:
    """source, bin, need: the bin in which the running sum of words passes the need, and what
    the bins before it leave of the need. `binned` has at most `BINS` rows a source."""
    running = Window.partitionBy("source").orderBy("bin")
    sums = (
        binned.withColumn("upto", F.sum("words").over(running))
        .withColumnRenamed("source", "s")
        .join(needs, F.col("s").eqNullSafe(F.col("source")))
    )
    first = F.min(F.when(F.col("upto") > F.col("need"), F.struct("bin", "upto", "words")))
    return written(
        sums.groupBy("source").agg(F.first("need").alias("need"), first.alias("at"))
        .select(
            "source",
            F.coalesce(F.col("at.bin"), F.lit(BINS)).alias("bin"),  # all of them, if even the sum of all is below
            (F.col("need") - (F.col("at.upto") - F.col("at.words"))).alias("need"),
        ),
        label,
    )


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnRenamed("source", "s")
    return left.join(right, F.col("source").eqNullSafe(F.col("s")), how).drop("s")


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, words: str = WORDS
) -> DataFrame:
    """One row per row of `docs(doc_id, text, source, ...)`: doc_id, source, size, source_size,
    target, taken, copies, rate.

    Size counts `words` in the whole text, a null text has none; null is a source of its own
    and the last. A document is taken 0 to `cap` times as a whole. Sources without words have
    target 0; an empty table gives no rows; rows that repeat a document are taken each for itself;
    other columns are not read. Only ids, sources and sizes decide, so that reruns agree."""
    sizes = written(
        docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                    F.regexp_count(whole_text(), F.lit(words)).cast("long").alias("size"),
                    F.monotonically_increasing_id().alias("row")),
        "doc-sizes",
    )
    targets = written(source_targets(sizes, weights, cap), "targets")
    lambdas = tilts(sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), targets, cap)
    known = _same_source(targets, lambdas, "left")
    rated = _same_source(sizes, known).withColumn(
        "rate",
        F.when(F.col("size") == 0, 0.0)
        .when(F.col("lam").isNotNull(), _rate(F.col("lam") * F.col("size") / F.col("scale"), cap))
        .when(F.col("target") > 0, cap).otherwise(0.0),
    )
    unit = F.pmod(F.xxhash64("doc_id", "size"), F.lit(1 << 52)) / float(1 << 52)
    whole = F.floor("rate").cast("long")
    # an extra copy where the hash is below the rate's fraction plus the source's shift
    place = ((unit - (F.col("rate") - whole)) + 1) / 2 * BINS
    rated = written(
        rated.select(
            "row", "doc_id", "source", "size", "source_size", "target", "rate", whole.alias("whole"),
            F.when((F.col("size") > 0) & (F.col("rate") < cap) & (F.col("rate") > 0), place).alias("place"))
        .withColumn("bin", F.floor("place").cast("int"))
        .withColumn("fine", F.floor((F.col("place") - F.col("bin")) * BINS).cast("int")),
        "rates",
    )
    needs = rated.groupBy("source").agg((F.first("target") - F.sum(F.col("size") * F.col("whole"))).alias("need"))
    coarse = _picked(
        rated.where("bin is not null").groupBy("source", "bin").agg(F.sum("size").alias("words")), needs, "bins")
    inner = _same_source(rated.where("bin is not null"), coarse.select("source", F.col("bin").alias("at")))
    fine = _picked(
        inner.where("bin = at").groupBy("source", F.col("fine").alias("bin")).agg(F.sum("size").alias("words")),
        coarse.select("source", "need"), "bins")
    marks = _same_source(
        coarse.select("source", F.col("bin").alias("at")),
        fine.select("source", F.col("bin").alias("fine_at")), "left")
    extra = F.when(
        (F.col("bin") < F.col("at"))
        | ((F.col("bin") == F.col("at")) & (F.col("fine") < F.col("fine_at"))), 1,
    ).otherwise(0)
    rounded = written(
        _same_source(rated, marks, "left").withColumn("copies", (F.col("whole") + extra).cast("int"))
        .select("row", "doc_id", "source", "size", "source_size", "target", "copies", "rate"),
        "rounded",
    )
    discarded(sizes, targets, rated, coarse, fine)
    return (
        _filled(rounded, cap)
        .select("doc_id", "source", "size", "source_size", "target",
                (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")
    )


def _filled(rounded: DataFrame, cap: float) -> DataFrame:
    """One copy more of a few documents: each the largest that fits what its source still lacks."""
    lacks = rounded.groupBy("source").agg(
        (F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("lack"))
    spare = rounded.where((F.col("copies") < math.floor(cap)) & (F.col("size") > 0) & (F.col("rate") > 0))
    taken = None
    for _ in range(FILLS):
        open_rows = spare if taken is None else spare.join(taken, "row", "left_anti")
        best = F.max(F.struct("size", F.xxhash64("doc_id").alias("nth"), "row")).alias("best")
        more = written(
            _same_source(open_rows, lacks).where("size <= lack").groupBy("source").agg(best)
            .select("source", "best.size", "best.row"), "fills")
        if more.isEmpty():
            break
        taken = more.select("row") if taken is None else taken.union(more.select("row"))
        lacks = written(
            _same_source(lacks, more.select("source", "size"), "left")
            .select("source", (F.col("lack") - F.coalesce("size", F.lit(0))).alias("lack")), "lacks")
    if taken is None:
        return rounded
    return rounded.join(taken.withColumn("filled", F.lit(1)), "row", "left").withColumn(
        "copies", (F.col("copies") + F.coalesce("filled", F.lit(0))).cast("int"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """`docs` with every row as often as the mix takes it; rows taken zero times are gone.

    Rows that share doc_id and source are taken equally often, as the one of them taken least."""
    copies = written(
        mix_sources(docs, **options).groupBy("doc_id", "source").agg(F.min("copies").alias("copies")), "copies")
    taken = copies.where("copies > 0").select(
        F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("copies").alias("__copies"))
    repeated = docs.join(
        taken, docs["doc_id"].cast("long").eqNullSafe(F.col("__id"))
        & docs["source"].cast("string").eqNullSafe(F.col("__source")))
    return repeated.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
