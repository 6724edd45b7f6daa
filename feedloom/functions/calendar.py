"""Calendar keys that line up feeds with different reporting days and frequencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEEK_KEY = ["week_year", "week_no"]
MONTH_KEY = "month_start"


def week_year(day: Column, mode: str = "iso") -> Column:
    """The year half of a week key.

    ``iso`` pairs the ISO week with the ISO year, so every date of one Monday-to-Sunday week gets
    one key. ``calendar`` pairs it with the calendar year, which tears the week around New Year
    apart and lets 30 December meet the first week of the *same* year; it is there for parity.
    """
    if mode == "iso":
        return F.extract(F.lit("YEAROFWEEK"), day).cast("int")
    if mode == "calendar":
        return F.year(day)
    raise ValueError(f"week key mode must be 'iso' or 'calendar', not {mode!r}")


def with_week_key(df: DataFrame, day: str, mode: str = "iso") -> DataFrame:
    d = F.col(day)
    return df.withColumns({"week_year": week_year(d, mode), "week_no": F.weekofyear(d)})


def week_start(day: Column) -> Column:
    """Monday of the ISO week: the same partition of dates as (ISO year, ISO week), in one column."""
    return F.trunc(day, "week")


def month_start(day: Column) -> Column:
    """First of the month. Joins and groupings use this date; text is made only for display."""
    return F.trunc(day, "month")


def month_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_attributes(day: Column) -> dict[str, Column]:
    """The calendar dimension's attributes, in table order. ``day_of_week`` counts from Sunday = 1."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "quarter": F.quarter(day),
        "week_of_year": F.weekofyear(day),
        "day_of_week": F.dayofweek(day),
    }
