"""Build the star schema from the three cleaned feeds: three dimensions and one market fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.classify import AREA_CLASSES, AREA_OTHERWISE, PRODUCT_CLASSES, PRODUCT_OTHERWISE
from feedloom.functions.keys import surrogate_key
from feedloom.operators.dims import date_dimension, named_dimension, require_unique_keys
from feedloom.operators.facts import Scale, attach_month, join_on_week, monthly_sum, round_to, weekly_sum
from feedloom.operators.sinks import replace_table
from feedloom.scratch import at_once, drop_path, materialize, scratch_path
from feedloom.sources.feeds import MOVEMENTS, PRICES, STOCKS

# The names that select the market's series, and the gold tables' names.
PRICE_PRODUCT = "No 2 Diesel"
STOCK_PRODUCT = "Distillate Fuel Oil"
STOCK_PROCESS = "Ending Stocks"
NATION = "U.S."
FLOW = "Net Imports"
DIM_DATE = "dim_date"
DIM_PRODUCT = "dim_product"
DIM_AREA = "dim_area"
FACT = "fact_diesel_market"
STOCK_TOTAL = "total_stock_k_barrels"
FLOW_TOTAL = "monthly_net_imports_k_bpd"


@dataclass(frozen=True)
class StarOptions:
    """``week_key='calendar'`` matches weeks by calendar year and ISO week number.

    ``has_macro`` names a column that tells a month without a report from a reported zero.
    ``value_scale`` makes the sums exact for volumes with at most that many decimals, which cleaned feeds have; ``"exact"``
    makes them those of the doubles themselves, whatever their size; ``None`` gives plain double sums, whose last digit depends on
    the order of the rows.
    """

    week_key: str = "iso"
    key_method: str = "crc32"
    has_macro: str | None = None
    value_scale: Scale = 6


def dim_date(prices: DataFrame, stocks: DataFrame) -> DataFrame:
    return date_dimension((prices, "date"), (stocks, "date"))


def dim_product(prices: DataFrame, stocks: DataFrame, movements: DataFrame, key_method: str = "crc32") -> DataFrame:
    feeds = [(df, "product_name") for df in (prices, stocks, movements)]
    return named_dimension(
        "product", "product_category", PRODUCT_CLASSES, PRODUCT_OTHERWISE, *feeds, key_method=key_method
    )


def dim_area(stocks: DataFrame, movements: DataFrame, key_method: str = "crc32") -> DataFrame:
    return named_dimension(
        "area",
        "area_type",
        AREA_CLASSES,
        AREA_OTHERWISE,
        (stocks, "area"),
        (movements, "country_code"),
        key_method=key_method,
    )


def market_prices(prices: DataFrame) -> DataFrame:
    return prices.filter(F.col("product_name").contains(PRICE_PRODUCT)).select("date", "product_name", "price_usd_per_gal")


def market_stocks(stocks: DataFrame) -> DataFrame:
    name = F.col("product_name")
    return stocks.filter(
        (F.col("process_name") == STOCK_PROCESS) & (F.col("area") == NATION) & name.contains(STOCK_PRODUCT)
    )


def market_flows(movements: DataFrame) -> DataFrame:
    name = F.col("product_name")
    return movements.filter(
        (F.col("country_code") == NATION) & name.contains(STOCK_PRODUCT) & F.col("description").contains(FLOW)
    )


def market_fact(
    prices: DataFrame, stocks: DataFrame, movements: DataFrame, options: StarOptions = StarOptions()
) -> DataFrame:
    """One row per price date, price product and area, with that week's stock and that month's flow.

    Stock and flow cover one area, so a total per week, with its area, is all there is to join.
    """
    weekly = weekly_sum(
        market_stocks(stocks), "date", "volume_k_barrels", STOCK_TOTAL, ("area",), options.week_key, options.value_scale
    )
    monthly = monthly_sum(
        market_flows(movements), "month_date", "volume_k_barrels_per_day", FLOW_TOTAL, scale=options.value_scale
    )
    return assemble_fact(market_prices(prices), weekly, monthly, options)


def assemble_fact(
    price: DataFrame, weekly: DataFrame, monthly: DataFrame, options: StarOptions = StarOptions()
) -> DataFrame:
    """The fact's rows from the market's prices and the two totals, of which the calendar bounds the size.

    The product is the price's own; stock and flow are those of the distillate total. Both names come
    from the feeds the dimensions are built from and a key is a hash of its name, so the keys are
    computed in place; joining the dimensions to fetch them would shuffle to learn nothing. The area's key is a hash of the
    stock's own column: a hash of a constant would be folded, and joins on it would lose their key.
    """
    rows = join_on_week(price, F.broadcast(weekly), "date", options.week_key)
    rows = attach_month(rows, F.broadcast(monthly), "date", FLOW_TOTAL, found=options.has_macro)
    flag = [options.has_macro] if options.has_macro else []
    return rows.select(
        "date",
        surrogate_key(F.col("product_name"), options.key_method).alias("product_id"),
        surrogate_key(F.col("area"), options.key_method).alias("area_id"),
        round_to("price_usd_per_gal", 3).alias("price_usd_per_gal"),
        STOCK_TOTAL,
        round_to(FLOW_TOTAL, 2).alias(FLOW_TOTAL),
        *flag,
    )


def build_star(spark: SparkSession, silver: str, gold: str, options: StarOptions = StarOptions()) -> None:
    """Read the silver tables and replace the four gold tables, but none of them if keys collide."""
    prices, stocks, movements = (spark.read.parquet(f"{silver}/{s.name}") for s in (PRICES, STOCKS, MOVEMENTS))
    built = {
        DIM_DATE: dim_date(prices, stocks),
        DIM_PRODUCT: dim_product(prices, stocks, movements, options.key_method),
        DIM_AREA: dim_area(stocks, movements, options.key_method),
        FACT: market_fact(prices, stocks, movements, options),
    }
    work = scratch_path(spark, "star")
    try:
        written = at_once([lambda n=name, d=df: materialize(d, f"{work}/{n}") for name, df in built.items()])
        stored = dict(zip(built, written))
        require_unique_keys(stored[DIM_PRODUCT], "product_id", "product_name")
        require_unique_keys(stored[DIM_AREA], "area_id", "area_name")
        for name, df in stored.items():
            replace_table(df, f"{gold}/{name}", sort_by=("date",) if name == FACT else ())
    finally:
        drop_path(spark, work)
