"""Valid/quarantine split with reasons, counts, and fail-fast gates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.publish import PERIOD, WHOLE, current_table, read_periods, replace_periods

REASON = "error_reason"
QUARANTINED_AT = "quarantined_at"
REJECT_KEY = "_reject_key"
BATCHES = "_batches"
HISTORY = "rows"


class FeedQualityError(ValueError):
    """A feed has nothing usable to pass on."""


@dataclass(frozen=True)
class Rule:
    """``condition`` (SQL text) must be true. NULL counts as failing, so no row escapes both sides."""

    reason: str
    condition: str


def tag_errors(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``error_reason``: the first rule a row fails, or NULL for a valid row."""
    failed = [F.when(~F.coalesce(F.expr(r.condition), F.lit(False)), F.lit(r.reason)) for r in rules]
    return df.withColumn(REASON, F.coalesce(*failed) if failed else F.lit(None).cast("string"))


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def bad_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, bad): together exactly ``df``. Materialize ``df`` first if it is costly or both are used."""
    tagged = tag_errors(df, rules)
    return valid_rows(tagged), bad_rows(tagged)


def quality_counts(tagged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total, valid and bad rows and the bad share, in one aggregate, overall or per group."""
    bad = F.count_if(F.col(REASON).isNotNull())
    rows = F.count(F.lit(1))
    counted = tagged.groupBy(*by).agg(rows.alias("total_rows"), bad.alias("bad_rows"))
    return counted.select(
        *by,
        "total_rows",
        (F.col("total_rows") - F.col("bad_rows")).alias("valid_rows"),
        "bad_rows",
        F.try_divide(F.col("bad_rows"), F.col("total_rows")).alias("bad_share"),
    )


def shares_above(tagged: DataFrame, by: Sequence[str], threshold: float = 0.05) -> DataFrame:
    """Groups (such as load dates) whose bad share exceeds ``threshold``."""
    return quality_counts(tagged, by).filter(F.col("bad_share") > threshold)


def require_rows(n: int, feed: str) -> None:
    if n == 0:
        raise FeedQualityError(f"{feed}: no rows after shaping")


def require_survivors(n: int, feed: str) -> None:
    if n == 0:
        raise FeedQualityError(f"{feed}: no valid rows left after quarantine")


def write_quarantine(bad: DataFrame, root: str, batch_id: str) -> None:
    """Merge a batch's bad rows into the feed's history: each bad row once, with the batches that saw it.

    A row is known by its content and its snapshot. A re-run of a batch replaces what that batch said: a row that it no longer
    finds loses the batch, and goes if no other one saw it, so that a repaired re-run leaves nothing stale behind.
    """
    spark = bad.sparkSession
    identity = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in bad.columns]), {"ignoreNullFields": "false"}), 256)
    seen = bad.distinct().withColumn(REJECT_KEY, identity)
    version, history = read_periods(spark, root, HISTORY, [WHOLE])
    stamped = seen.withColumns({QUARANTINED_AT: F.current_timestamp(), BATCHES: F.array(F.lit(batch_id))})
    if history is None:
        merged = stamped.withColumn(PERIOD, F.lit(WHOLE))
    else:
        here = seen.select(REJECT_KEY, F.lit(True).alias("_here"))
        known = F.array_contains(BATCHES, batch_id)
        with_it = F.when(known, F.col(BATCHES)).otherwise(F.array_append(BATCHES, batch_id))
        batches = F.when(F.col("_here"), with_it).otherwise(F.array_remove(BATCHES, batch_id))
        old = history.join(here, REJECT_KEY, "left").withColumn(BATCHES, batches).drop("_here")
        new = stamped.join(history.select(REJECT_KEY), REJECT_KEY, "left_anti").withColumn(PERIOD, F.lit(WHOLE))
        merged = old.filter(F.size(BATCHES) > 0).unionByName(new)
    replace_periods(spark, root, {HISTORY: (merged, [WHOLE])}, version)


def quarantined(spark: SparkSession, root: str) -> DataFrame | None:
    """A feed's bad rows with the first and the last batch that saw each, or ``None`` before the first batch."""
    history = current_table(spark, root, HISTORY)
    if history is None:
        return None
    first, last = F.element_at(BATCHES, 1), F.element_at(BATCHES, -1)
    return history.withColumns({"first_batch": first, "last_batch": last}).drop(BATCHES, REJECT_KEY)
