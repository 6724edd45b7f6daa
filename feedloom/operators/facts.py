"""Fact assembly: sum feeds to a period, line them up on calendar keys, swap names for keys.

A long feed should meet a short sum without being shuffled by week or month, since a few hundred such
keys would make a few hundred, uneven, reducers. Two ways give that, both safe at any size:

* a sum kept per period only has at most one row per week or month that a four-digit year can name, some
  530,000 weeks of a few bytes, however much was summed. ``add_weekly_total`` and ``add_monthly_total``
  make that sum themselves, so the bound holds by construction, and broadcast it;
* a sum with more grouping columns has no such bound. Write it with ``scratch.materialize`` first: the
  planner then knows its size, broadcasts it if that is under the session's threshold, and otherwise
  shuffles both sides, where adaptive execution splits the weeks that are too big.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.calendar import MONTH_KEY, WEEK_KEY, month_start, with_week_key
from feedloom.functions.exact_sums import exact_sum
from feedloom.functions.sums import total

#: As a ``scale``: the exact sum of the doubles themselves, of any size, instead of the decimals they stand for.
EXACT = "exact"
Scale = int | str | None


def sum_by(df: DataFrame, by: Sequence[str], value: str, out: str, scale: Scale = None) -> DataFrame:
    if scale == EXACT:
        return exact_sum(df, by, value, out)
    return df.groupBy(*by).agg(total(F.col(value), scale).alias(out))


def weekly_sum(
    df: DataFrame, day: str, value: str, out: str, by: Sequence[str] = (), mode: str = "iso", scale: Scale = None
) -> DataFrame:
    return sum_by(with_week_key(df, day, mode), [*WEEK_KEY, *by], value, out, scale)


def monthly_sum(
    df: DataFrame, day: str, value: str, out: str, by: Sequence[str] = (), scale: Scale = None
) -> DataFrame:
    return sum_by(df.withColumn(MONTH_KEY, month_start(F.col(day))), [MONTH_KEY, *by], value, out, scale)


def join_on_week(left: DataFrame, weekly: DataFrame, day: str, mode: str = "iso") -> DataFrame:
    """Rows of ``left`` that have a matching week, once per row ``weekly`` holds for it.

    If ``weekly`` is kept per area, a row meets every area of its week: area is not part of the key.
    """
    return with_week_key(left, day, mode).join(weekly, WEEK_KEY, "inner").drop(*WEEK_KEY)


def add_weekly_total(
    left: DataFrame,
    day: str,
    feed: DataFrame,
    feed_day: str,
    value: str,
    out: str,
    mode: str = "iso",
    scale: Scale = None,
) -> DataFrame:
    """Rows of ``left`` whose week occurs in ``feed``, with that week's total."""
    weekly = weekly_sum(feed, feed_day, value, out, mode=mode, scale=scale)
    return join_on_week(left, F.broadcast(weekly), day, mode)


def attach_month(
    left: DataFrame,
    monthly: DataFrame,
    day: str,
    value: str,
    fill: float | None = 0.0,
    found: str | None = None,
) -> DataFrame:
    """Carry a monthly value onto every row of its month.

    Months without a value get ``fill`` (``None`` leaves NULL). ``found`` names an optional flag that
    tells a filled zero from a reported one.
    """
    marked = monthly.withColumn("_found", F.lit(True))
    joined = left.withColumn(MONTH_KEY, month_start(F.col(day))).join(marked, MONTH_KEY, "left")
    columns = {}
    if fill is not None:
        columns[value] = F.coalesce(F.col(value), F.lit(fill))
    if found is not None:
        columns[found] = F.coalesce(F.col("_found"), F.lit(False))
    return joined.withColumns(columns).drop("_found", MONTH_KEY) if columns else joined.drop("_found", MONTH_KEY)


def add_monthly_total(
    left: DataFrame,
    day: str,
    feed: DataFrame,
    feed_day: str,
    value: str,
    out: str,
    fill: float | None = 0.0,
    found: str | None = None,
    scale: Scale = None,
) -> DataFrame:
    """Every row of ``left`` with its month's total from ``feed``."""
    monthly = monthly_sum(feed, feed_day, value, out, scale=scale)
    return attach_month(left, F.broadcast(monthly), day, out, fill, found)


def lookup_key(df: DataFrame, dim: DataFrame, name: str, dim_name: str, key: str) -> DataFrame:
    """Replace nothing, add ``key`` from the dimension row whose name matches; NULL without a match."""
    members = dim.select(F.col(dim_name).alias("_member"), F.col(key))
    return df.join(members, F.col(name) == F.col("_member"), "left").drop("_member")


def round_to(column: str, digits: int) -> Column:
    """Half-up rounding on the value's decimal form."""
    return F.round(F.col(column), digits)
