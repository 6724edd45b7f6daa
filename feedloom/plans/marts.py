"""Questions asked of the star and of the series behind it.

Every window here runs over rows already summed to one per series and period. Such a partition is
bounded by the calendar, so a series that owns a third of the raw rows is no bigger than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions.calendar import MONTH_KEY, month_start, week_start
from feedloom.functions.sums import mean, total


def weekly_mart(
    fact: DataFrame,
    dates: DataFrame,
    products: DataFrame,
    areas: DataFrame,
    year: int | None = None,
    category: str | None = None,
    price: str = "price_usd_per_gal",
    stock: str = "total_stock_k_barrels",
    scale: int | None = None,
) -> DataFrame:
    """Average price and total stock by year, week, product category and area, in that order."""
    if year is not None:
        dates = dates.filter(F.col("year") == year)
    if category is not None:
        products = products.filter(F.col("product_category") == category)
    by = ["year", "week_of_year", "product_category", "area_name"]
    return (
        fact.join(dates.select("date", "year", "week_of_year"), "date")
        .join(products.select("product_id", "product_category"), "product_id")
        .join(areas.select("area_id", "area_name"), "area_id")
        .groupBy(*by)
        .agg(mean(F.col(price), scale).alias("avg_price"), total(F.col(stock), scale).alias("total_inv"))
        .orderBy(*by)
    )


def missing_weeks(df: DataFrame, day: str, series: Sequence[str] = (), until: date | None = None) -> DataFrame:
    """Mondays of weeks without a row, from each series' first week to the week of ``until``.

    ``until`` is the latest date over all series if it is not given, so that a series that stopped shows its gap. Each present
    week looks at the next one and lists what lies between, so only the gaps are ever generated; a full spine to
    anti-join against would be mostly weeks that are there.
    """
    weeks = df.select(*series, week_start(F.col(day)).alias("week_start")).distinct()
    end = F.lit(until or df.agg(F.max(F.col(day).cast("date"))).first()[0]).cast("date")
    after = F.lead("week_start").over(Window.partitionBy(*series).orderBy("week_start"))
    next_week = F.coalesce(after, F.date_add(week_start(end), 7))
    gaps = weeks.withColumn("next_week", next_week).filter(F.datediff("next_week", "week_start") > 7)
    listed = F.sequence(F.date_add("week_start", 7), F.date_sub("next_week", 7), F.expr("INTERVAL 7 DAYS"))
    return gaps.select(*series, F.explode(listed).alias("week_start"))


def lag_correlation(
    left: DataFrame,
    left_value: str,
    right: DataFrame,
    right_value: str,
    series: Sequence[str] = (),
    lags: Sequence[int] = (1, 2),
) -> DataFrame:
    """Correlation of ``left`` with ``right`` some weeks earlier; both hold one row per ``week_start``.

    The lag moves the date, not the row: a missing week stays missing instead of lending its place to
    the week before, and the match is an ordinary equi-join. ``series`` are columns of ``left``.
    """
    lagged = right.select(
        "week_start",
        F.col(right_value).alias("_right"),
        F.explode(F.array(*[F.lit(n) for n in lags])).alias("lag_weeks"),
    ).withColumn("week_start", F.expr("date_add(week_start, 7 * lag_weeks)"))
    return (
        left.join(lagged, "week_start")
        .groupBy(*series, "lag_weeks")
        .agg(F.count(F.lit(1)).alias("n_weeks"), F.corr(left_value, "_right").alias("correlation"))
    )


def month_over_month(df: DataFrame, day: str, value: str, series: Sequence[str], scale: int | None = None) -> DataFrame:
    """Monthly totals with their change from the month before, NULL where that month has no rows."""
    monthly = df.groupBy(*series, month_start(F.col(day)).alias("month_start")).agg(
        total(F.col(value), scale).alias("total")
    )
    window = Window.partitionBy(*series).orderBy("month_start")
    adjacent = F.lag("month_start").over(window) == F.add_months("month_start", -1)
    previous = F.when(adjacent, F.lag("total").over(window))
    return monthly.withColumn("previous", previous).withColumns(
        {
            "change": F.col("total") - F.col("previous"),
            "change_share": F.try_divide(F.col("total") - F.col("previous"), F.col("previous")),
        }
    )


def annual_rollup(df: DataFrame, day: str, value: str, scale: int | None = None) -> DataFrame:
    """Totals by quarter, year and overall; ``level`` tells a total's NULLs from missing dates.

    Rows are summed to quarters first, so that the rollup copies a few quarters and not every row.
    """
    d = F.col(day)
    quarters = df.groupBy(F.year(d).alias("year"), F.quarter(d).alias("quarter")).agg(
        F.count(F.lit(1)).alias("_rows"), total(F.col(value), scale).alias("_total")
    )
    return quarters.rollup("year", "quarter").agg(
        F.grouping_id().alias("level"),
        F.sum("_rows").alias("n_rows"),
        total(F.col("_total"), scale).alias("total"),
    )


def season_profile(df: DataFrame, day: str, value: str, scale: int | None = None) -> DataFrame:
    """Totals and averages by quarter and day of week (Sunday = 1)."""
    d = F.col(day)
    return df.groupBy(F.quarter(d).alias("quarter"), F.dayofweek(d).alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        total(F.col(value), scale).alias("total"),
        mean(F.col(value), scale).alias("average"),
    )


def carry_forward(df: DataFrame, day: str, value: str, series: Sequence[str]) -> DataFrame:
    """Fill each NULL ``value`` with the series' last known one.

    ``df`` holds one row per series and day. To carry a monthly value onto rows of a sparser or denser series use
    ``latest_monthly``, which also knows the months in which the series has no row.
    """
    window = Window.partitionBy(*series).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, ignorenulls=True).over(window))


def latest_monthly(df: DataFrame, day: str, monthly: DataFrame, value: str) -> DataFrame:
    """Every row of ``df`` with the monthly ``value`` of the latest month that has one, up to the row's own month.

    ``monthly`` has one row per ``month_start``. The carrying is done over the months of both sides, of which the calendar
    bounds the number, and not over the rows.
    """
    own = df.select(month_start(F.col(day)).alias(MONTH_KEY)).distinct()
    known = monthly.select(MONTH_KEY, value)
    months = known.unionByName(own.withColumn(value, F.lit(None).cast(monthly.schema[value].dataType)))
    months = months.groupBy(MONTH_KEY).agg(F.max(value).alias(value)).filter(F.col(MONTH_KEY).isNotNull())
    upto = Window.orderBy(MONTH_KEY).rowsBetween(Window.unboundedPreceding, 0)
    carried = months.select(MONTH_KEY, F.last(value, ignorenulls=True).over(upto).alias(value))
    return df.withColumn(MONTH_KEY, month_start(F.col(day))).join(F.broadcast(carried), MONTH_KEY, "left").drop(MONTH_KEY)
