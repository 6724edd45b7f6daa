"""Tolerant parsing: bad text becomes NULL for the quality rules to find, it never stops the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_day(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")


def parse_month(text: Column) -> Column:
    """``yyyy-MM`` as the first day of that month."""
    return F.try_to_date(F.concat(text, F.lit("-01")), "yyyy-MM-dd")


def parse_number(text: Column) -> Column:
    return text.try_cast("double")
