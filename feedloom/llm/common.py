"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The characters that separate words.
SPACES = r"\x20\x09-\x0D"
WORD = f"[^{SPACES}]+"
#: Rows per Arrow batch where a row is a whole document: very long texts would make larger batches huge.
DOCS_PER_BATCH = 10_000


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes, empty where it is NULL: Python code then skips a decode it does not need."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def bucket_of(hashed: Column, bits: int) -> Column:
    """The upper bits of a 64-bit hash. Buckets follow the hash in unsigned order."""
    return F.shiftrightunsigned(hashed, 64 - bits).cast("int")


def running_sum(
    rows: DataFrame, by: list[str], hashed: str, value: Column, out: str, *, bits: int = 10, ties: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same group that come before this one in hash order.

    With ``value`` = 1 it is a rank from 0. A group is cut into 2**bits buckets by the hash, summed per bucket before
    the shuffle, and only rows of one bucket meet in a task, so that a group with a third of all rows is no hot spot.
    ``rows`` is read twice; ``by`` must not be NULL. Rows equal in hash and ``ties`` are interchangeable.
    """
    bucketed = rows.withColumn("__bucket", bucket_of(F.col(hashed), bits))
    sums = bucketed.groupBy(*by, "__bucket").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by, "__bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    # Shifted so that signed order is unsigned order within a bucket.
    order = [F.col(hashed).bitwiseXOR(F.lit(-(2**63))), *ties]
    within = Window.partitionBy(*by, "__bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.join(starts, [*by, "__bucket"])
        .withColumn(out, F.col("__start") + F.coalesce(F.sum(value).over(within), F.lit(0)))
        .drop("__bucket", "__start")
    )


def repeat_rows(rows: DataFrame, count: str, out: str) -> DataFrame:
    """Each row ``count`` times, numbered from 0 in ``out``. Made in two steps, so that no long array is built."""
    step = 10_000
    blocks = rows.withColumn("__block", F.explode(F.sequence(F.lit(0), F.expr(f"int((`{count}` - 1) div {step})"))))
    last = F.least(F.lit(step), F.col(count) - F.col("__block") * step) - 1
    numbered = blocks.withColumn("__i", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    return numbered.withColumn(out, F.col("__block") * step + F.col("__i")).drop("__block", "__i")
