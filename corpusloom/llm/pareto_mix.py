"""Mixing sources to target word counts by Pareto order sampling, native to Spark SQL.

Each source gets a target number of words. Its documents are first taken whole
as often as the target covers all of the source; the rest of the target is a
sample in which a document's inclusion probability p is proportional to its words,
with the factor that makes the expected words those left. Documents that would
reach p = 1 are certain, and the factor is found anew for the others. Every
document gets random odds u/(1-u), divided by its inclusion odds p/(1-p), and
documents are taken in that order until the words are used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import packed, quoted, unpacked
from corpusloom.operators.positions import repeatable_hash, unit_number
from corpusloom.session import materialize

#: Steps into which the random order is cut to find where a sample ends.
STEPS = 1 << 16


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null: 0."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.char_length(F.regexp_replace(marks, r"[\x20\x09-\x0D]+", "")).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code-point order, null last, take the weights in turn. All get
    the same number of words per weight, but none more than ``most`` times its
    size; what that leaves over goes to the others by weight. A source with
    ratio cap/weight below the common level is full, so one running sum over
    sources ordered by that ratio finds the level. The windows run over one row
    per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("i", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(w).cast("double") for w in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "i")
    all_rows = Window.partitionBy()
    level = caps.select(
        "*",
        F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("full"),
        F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        (F.sum("source_size").over(all_rows) * F.lit(share)).alias("total"),
    ).withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    # The first source that the level does not fill sets it for all.
    first = F.min(F.when(F.col("cap") >= F.col("level") * F.col("w"), F.struct(F.col("cap") / F.col("w"), "i", "level"))).over(all_rows)
    return level.withColumn("top", first.getField("level")).select(
        "source", "source_size", F.coalesce(F.least(F.col("cap"), F.col("top") * F.col("w")), F.col("cap")).alias("target")
    )


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 11,
) -> DataFrame:
    """(_id, _th, source, size, source_size, target, copies), one row per row of ``df``.

    ``copies`` is the number of times the mix takes the document: the certain
    whole copies and at most one more from the sample, so never more than
    ``most``. The sample of a source ends at the document that brings it nearest
    to the words left, so a source misses its target by at most half a document.
    Draws are hashes of seed and id: reruns and retries agree, and rows that
    repeat an id and a text can only swap places. Null text has size 0, a null id
    draws like an id of its own, a null source is a source. Sources without words
    get target 0, texts without words no copy from the sample; an empty table gives
    no rows. Other columns are not read; a very long text is one row of numbers.
    """
    rows = df.select(
        quoted(id_col).cast("long").alias("_id"),
        F.xxhash64(F.coalesce(quoted(text_col), F.lit(""))).alias("_th"),
        quoted(source_col).cast("string").alias("source"),
        word_count(quoted(text_col)).alias("size"),
    )
    # Only numbers from here on: the texts are read once.
    rows = materialize(rows.withColumn("u", unit_number(repeatable_hash(seed, F.coalesce(F.col("_id").cast("string"), F.lit("null"))))), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, share, most)
    per_doc = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.withColumn("whole", F.floor(per_doc).cast("long")).withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    goal = materialize(goal, "targets")
    goal = goal.join(factors(rows, goal).withColumnRenamed("source", "_fsource"), F.col("source").eqNullSafe(F.col("_fsource")), "left")
    g = materialize(goal.select(F.col("source").alias("_source"), "source_size", "target", "whole", "left", "factor"), "factors")
    marked = rows.join(g, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    p = F.least(F.lit(1.0), F.coalesce(F.col("factor") * F.col("size"), F.lit(1.0)))
    odds = (F.col("u") / (1 - F.col("u"))) * ((1 - F.col("p")) / F.col("p"))
    drawn = marked.withColumn("p", F.when((F.col("size") > 0) & (F.col("left") > 0), p)).withColumn("q", F.when(F.col("p").isNotNull(), odds))
    # Steps in the order of q; q / (1 + q) lies between 0 and 1.
    drawn = drawn.withColumn("step", F.floor(F.col("q") / (1 + F.col("q")) * STEPS).cast("int"))

    # Words per source and step of the order, summed up to each step.
    steps = drawn.where("step is not null").groupBy("source", "step").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
    before = Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    cut = steps.where(F.col("before") < F.col("left")).groupBy("source").agg(F.max_by(F.struct("step", "before"), "step").alias("cut"))
    cut = cut.select(F.col("source").alias("_csource"), F.col("cut.step").alias("cut_step"), F.col("cut.before").alias("cut_before"))
    drawn = drawn.join(cut, F.col("source").eqNullSafe(F.col("_csource")), "left").drop("_csource")
    ends_here = F.coalesce(F.col("step") == F.col("cut_step"), F.lit(False))
    sure = drawn.where(~ends_here).withColumn("extra", F.coalesce(F.col("step") < F.col("cut_step"), F.lit(False)).cast("long"))
    # Only the one step in which a source's sample ends is ordered.
    inside = Window.partitionBy("source").orderBy("q", "_id", "_th").rowsBetween(Window.unboundedPreceding, -1)
    edge = drawn.where(ends_here).withColumn("run", F.col("cut_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    edge = edge.withColumn("extra", (F.col("run") + F.col("size") / 2 <= F.col("left")).cast("long")).drop("run")
    columns = ["_id", "_th", "source", "size", "source_size", "target", "p", (F.col("whole") + F.col("extra")).alias("copies")]
    return sure.select(*columns).union(edge.select(*columns))


def factors(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, factor): inclusion probabilities are factor * size, and 1 where that is more.

    rows: (source, size), goal: (source, left). The expected words of the sample,
    the words of the certain documents and factor * size * size of each other, are
    those left. Documents become certain from the largest down, so the factor is
    that of the largest size at which it leaves the probability at 1 or below. The
    windows run over the different sizes of a source, whose number grows at most
    with the square root of its words.
    """
    kinds = rows.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    g = goal.where("left > 0").select(F.col("source").alias("_source"), "left")
    kinds = kinds.join(g, F.col("source").eqNullSafe(F.col("_source")))
    by_size = Window.partitionBy("source").orderBy(F.desc("size"))
    larger = F.coalesce(F.sum(F.col("n") * F.col("size")).over(by_size.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    squares = F.sum((F.col("n") * F.col("size")).cast("decimal(19,0)") * F.col("size").cast("decimal(19,0)")).over(by_size.rowsBetween(0, Window.unboundedFollowing))
    tried = kinds.withColumn("factor", (F.col("left") - larger) / squares.cast("double")).where(F.col("factor") * F.col("size") <= 1)
    return tried.groupBy("source").agg(F.max_by("factor", "size").alias("factor"))


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, all columns kept."""
    taken = mix(df, id_col, text_col, source_col, **how)
    # Rows that repeat an id and a text share their copies; the first by row hash get one more.
    taken = taken.groupBy("_id", "_th").agg(F.sum("copies").alias("total"), F.count("*").alias("m")).where("total > 0")
    taken = taken.select(F.col("_id").alias("_kid"), F.col("_th").alias("_kth"), "total", "m")
    rows = packed(df, id_col, text_col).join(taken, F.col("_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")))
    once = rows.where("m = 1").select("_row", F.col("total").alias("copies"))
    place = F.row_number().over(Window.partitionBy("_kid", "_kth").orderBy(F.xxhash64("_row")))
    share = F.call_function("div", F.col("total"), F.col("m")) + (place <= F.col("total") % F.col("m")).cast("long")
    several = rows.where("m > 1").select("_row", share.alias("copies")).where("copies > 0")
    rows = once.union(several)
    return unpacked(rows.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), df.columns)
