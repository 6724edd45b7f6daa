"""Parquet tables, required or optional, and date-range scans over them."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.scratch import path_exists

log = logging.getLogger(__name__)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or ``None`` with a warning when nothing is there."""
    if not path_exists(spark, path):
        log.warning("nothing at %s, skipping", path)
        return None
    return spark.read.parquet(path)


def date_range(df: DataFrame, day: str, first: str, last: str) -> DataFrame:
    """Rows from ``first`` to ``last``, both included.

    The bounds are cast to the column's own type, not the column to theirs, so that the comparison
    reaches the Parquet reader and skips row groups. For timestamps ``last`` covers its whole day.
    """
    kind = df.schema[day].dataType
    low = F.lit(first).cast(kind)
    after = F.date_add(F.lit(last).cast("date"), 1).cast(kind)
    return df.filter((F.col(day) >= low) & (F.col(day) < after))
