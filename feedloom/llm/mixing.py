"""Mixing sources to target weights by entropy balancing. DataFrame operations only.

Each source has a target number of words. Among all document rates between 0 and 2 copies that meet the targets, those of
the largest entropy around one copy each are r = 2 / (1 + exp(-t * size / mean size)): the odds of a copy are tilted
exponentially by size, with one dual variable t per source. The dual is convex; Newton steps for all sources at once
solve it, each an aggregation over the (source, size) counts, kept inside a shrinking bracket. Rates become copies per
(source, size): cumulated rates, from the largest size to the smallest, are rounded and differenced, so that the words
taken miss a target by no more than about one document, and a few documents that fit into the gap then close it. Which documents of one size get the further copy is told by a hash.

Defined results: a NULL text has size 0. A NULL source is a source of its own, the last. A source without words has target
0. Rows repeated with the same doc_id and text are interchangeable: as many of them get the copy as the plan says. An empty table
gives no rows. Only doc_id, text and source are read.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import WORD, running_sum
from feedloom.scratch import materialize, scratch_path

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
#: Rounds of Newton steps alone; the rounds go on until every target is met.
PATIENCE = 20
TOLERANCE = 1e-7
CLOSED = 1e-13
REPAIRS = 3


def words_in(text: Column) -> Column:
    return F.when(text.isNull(), 0).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def source_key(source: Column) -> Column:
    """Never NULL, and in the order of the sources: by code point, NULL last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def slim_rows(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source_key(F.col("source")).alias("source"),
        words_in(text).alias("size"),
        F.xxhash64(F.col("doc_id").cast("long"), text).alias("h"),
    )


def targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to (source, source_size).

    Sharing out anew what stands above 2 times a source's size ends at min(2 * size, level * weight) with one level for
    all. Sources that are cut have the smallest size per weight, so the level is found from sums in that order. One row
    per source meets in the window.
    """
    order = Window.orderBy("source")
    picked = F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (picked + 1).cast("int"))
    weighted = sources.withColumn("weight", weight)
    everything = Window.partitionBy()
    cap = F.col("source_size") * float(MOST)
    steps = Window.orderBy(F.col("source_size") / F.col("weight"), "source")
    before = steps.rowsBetween(Window.unboundedPreceding, -1)
    onward = steps.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    levelled = weighted.withColumn("level", rest / F.sum("weight").over(onward))
    # The level is that of the first source that is not cut; all sources cut means all get their cap.
    fits = F.when(F.col("level") * F.col("weight") <= cap, F.struct(F.col("source_size") / F.col("weight"), F.col("source"), F.col("level")))
    level = F.coalesce(F.min(fits).over(everything).getField("level"), F.lit(float("inf")))
    return levelled.select("source", "source_size", F.least(cap, level * F.col("weight")).alias("target"))


def tilts(sizes: DataFrame, aims: DataFrame) -> DataFrame:
    """(source, target, t, mean): the dual variable of each source. ``sizes``: source, size, n."""
    spark = sizes.sparkSession
    mean = sizes.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = aims.join(mean, "source").select(
        "source", "target", "mean", F.lit(0.0).alias("t"), F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high"), F.lit(1.0).alias("miss")
    )
    for turn in count():
        state = materialize(state, scratch_path(spark, "mix-dual"))
        if not state.filter(F.col("miss") > TOLERANCE).limit(1).count():
            break
        rate = rate_of(F.col("size"), F.col("t"), F.col("mean"))
        sums = sizes.join(state.select("source", "t", "mean"), "source").groupBy("source").agg(
            F.sum(F.col("n") * rate * F.col("size")).alias("got"),
            F.coalesce(F.sum(F.try_divide(F.col("n") * rate * (1 - rate / MOST) * F.col("size") * F.col("size"), F.col("mean"))), F.lit(0.0)).alias("slope"),
        )
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("t")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("t")).otherwise(F.col("high"))
        joined = state.join(sums, "source").withColumns({"gap": gap, "low": low, "high": high})
        newton = F.col("t") - F.try_divide(F.col("gap"), F.col("slope"))
        far = F.greatest(F.lit(1.0), F.abs("t") * 2)
        step = F.greatest(F.col("t") - far, F.least(F.col("t") + far, newton))
        middle = (F.col("low") + F.col("high")) / 2
        # Newton steps can creep along one side; after PATIENCE rounds every other step halves the bracket or doubles t, so that the rounds end.
        newton_turn = F.lit(turn < PATIENCE or turn % 2 == 0)
        inside = newton_turn & (step > F.col("low")) & (step < F.col("high")) & ~F.isnan(step) & (F.col("slope") > 0)
        open_end = F.when(F.col("gap") < 0, F.col("t") + far).otherwise(F.col("t") - far)
        bounded = (F.col("low") > float("-inf")) & (F.col("high") < float("inf"))
        miss = F.when(F.col("target") > 0, F.abs(F.col("gap")) / F.col("target")).otherwise(0.0)
        # A target at the cap or at nothing is met in the limit; the rates are then 2 or 0 in double precision. A bracket that has closed meets
        # a target as nearly as doubles can.
        closed = bounded & (F.col("high") - F.col("low") <= CLOSED * F.greatest(F.lit(1.0), F.abs("t")))
        done = (miss <= TOLERANCE) | (F.abs("t") > 1e6) | closed
        moved = F.when(done, F.col("t")).when(inside, step).when(bounded, middle).otherwise(open_end)
        state = joined.select("source", "target", "mean", moved.alias("t"), "low", "high", F.when(done, 0.0).otherwise(miss).alias("miss"))
    # Sums of doubles depend on the order of rows in the last digits; the rounding makes reruns agree.
    return state.select("source", "target", F.round("t", 9).alias("t"), "mean")


def rate_of(size: Column, tilt: Column, mean: Column) -> Column:
    return F.when(mean > 0, float(MOST) / (1 + F.exp(-tilt * size / mean))).otherwise(1.0)


def repaired(planned: DataFrame) -> DataFrame:
    """``taken`` with what a source still misses made up by documents of the largest size that fits into the gap."""
    whole = Window.partitionBy("source")
    gap = F.col("target") - F.sum(F.col("taken") * F.col("size")).over(whole)
    gapped = planned.withColumn("gap", gap)
    room = F.when(F.col("gap") > 0, MOST * F.col("n") - F.col("taken")).otherwise(F.col("taken"))
    fits = F.when((F.col("size") > 0) & (F.col("size") <= F.abs("gap")) & (room > 0), F.col("size"))
    change = F.least(room, F.floor(F.abs("gap") / F.col("size"))) * F.signum("gap").cast("long")
    chosen = F.col("size") == F.max(fits).over(whole)
    return gapped.withColumn("taken", F.col("taken") + F.when(chosen, change).otherwise(0)).drop("gap")


def copy_plan(slim: DataFrame) -> DataFrame:
    """(source, size, source_size, target, copies, more, n): every document of the group is taken ``copies`` times, and ``more``
    of its ``n`` documents once more."""
    spark = slim.sparkSession
    sizes = materialize(slim.groupBy("source", "size").agg(F.count("*").alias("n")), scratch_path(spark, "mix-sizes"))
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aims = materialize(targets(totals), scratch_path(spark, "mix-targets"))
    state = materialize(tilts(sizes, aims), scratch_path(spark, "mix-tilts"))
    joined = sizes.join(state, "source").join(aims.select("source", "source_size"), "source")
    # The cap itself is met by two copies of each document exactly.
    full = F.col("target") >= MOST * F.col("source_size")
    rate = F.when(full, float(MOST)).otherwise(rate_of(F.col("size"), F.col("t"), F.col("mean")))
    upto = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = joined.withColumn("upto", F.floor(F.sum(F.col("n") * rate).over(upto) + 0.5))
    before = F.lag("upto", 1, 0).over(Window.partitionBy("source").orderBy(F.col("size").desc()))
    planned = summed.withColumn("taken", F.least(F.greatest(F.col("upto") - before, F.lit(0)), MOST * F.col("n")))
    for _ in range(REPAIRS):
        planned = repaired(planned)
    copies = F.floor(F.col("taken") / F.col("n"))
    return planned.select(
        "source", "size", "source_size", "target", "n", copies.cast("int").alias("copies"), (F.col("taken") - copies * F.col("n")).cast("long").alias("more")
    )


def with_copies(slim: DataFrame) -> DataFrame:
    """Each row of ``slim`` (a written table) with source_size, target and the ``copies`` to take."""
    spark = slim.sparkSession
    plan = materialize(copy_plan(slim), scratch_path(spark, "mix-plan"))
    rows = slim.join(plan, ["source", "size"])
    some = materialize(rows.filter("more > 0").drop("n"), scratch_path(spark, "mix-some"))
    ranked = running_sum(some, ["source", "size"], "h", F.lit(1), "rank", ties=("doc_id",))
    picked = ranked.withColumn("copies", F.col("copies") + (F.col("rank") < F.col("more")).cast("int")).drop("rank")
    return rows.filter("more = 0").drop("n").unionByName(picked)


def mix_sources(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and the words ``taken`` of each row."""
    slim = materialize(slim_rows(docs), scratch_path(docs.sparkSession, "mix-slim"))
    out = with_copies(slim)
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of the mix with all their columns, each as often as it is taken."""
    spark = docs.sparkSession
    slim = materialize(slim_rows(docs), scratch_path(spark, "mix-slim"))
    copies = with_copies(slim).groupBy("doc_id", "h").agg(F.sum("copies").alias("copies"), F.count("*").alias("n"))
    copies = materialize(copies, scratch_path(spark, "mix-copies")).withColumnRenamed("doc_id", "slim_id")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.col("doc_id").cast("long").alias("own_id"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("own_h"),
    )
    joined = rows.join(copies, rows.own_id.eqNullSafe(copies.slim_id) & (rows.own_h == copies.h))
    # Rows repeated with the same id and text share the copies of all of them.
    own = Window.partitionBy("own_id", "own_h").orderBy(F.lit(0))
    share = F.floor(F.col("copies") / F.col("n")) + (F.row_number().over(own) <= F.pmod("copies", "n")).cast("int")
    return joined.withColumn("times", share.cast("int")).withColumn("i", F.explode(F.array_repeat(F.lit(0), F.col("times")))).select("doc.*")
