"""The test tables cast as feeds: orders as prices, line items as stocks and monthly movements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.calendar import month_start
from feedloom.operators.dedup import keep_one


STOCK_AREA = "O"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderpriority").alias("product"),
        F.col("o_totalprice").alias("price"),
        "o_orderkey",
    )


def first_prices(prices: DataFrame) -> DataFrame:
    """One price per date and product: that of the lowest order key."""
    return keep_one(prices, ["date", "product"], [F.col("o_orderkey").asc()]).drop("o_orderkey")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def stock_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == STOCK_AREA)
    return lines(spark, sf_dir).filter(kept).select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_linestatus").alias("area"),
    )


def booked(shipped: str) -> Column:
    """Movements are booked a year after shipping, so that the first year's orders meet none."""
    return F.add_months(F.col(shipped).cast("date"), 12)


def movement_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    return lines(spark, sf_dir).filter(kept).select(booked("l_shipdate").alias("date"), F.col("l_extendedprice").alias("amount"))


def _pick(column: str, choices: dict[str, str], otherwise: Column) -> Column:
    picked = [F.when(F.col(column) == k, F.lit(v)) for k, v in choices.items()]
    return F.coalesce(*picked, otherwise)


def silver_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_silver(first_prices(order_prices(spark, sf_dir)))


def price_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For dimensions: dedup on date and product removes no date and no product, so it is left out."""
    return _as_silver(order_prices(spark, sf_dir))


def _as_silver(prices: DataFrame) -> DataFrame:
    names = _pick(
        "product",
        {"5-LOW": "Regular Gasoline", "4-NOT SPECIFIED": "Crude Oil"},
        F.concat("product", F.lit(" No 2 Diesel")),
    )
    return prices.select(
        "date", F.col("price").alias("price_usd_per_gal"), names.alias("product_name")
    )


def silver_stocks(spark: SparkSession, sf_dir: str, *besides: str) -> DataFrame:
    process = F.when(F.col("l_discount") > 0.02, "Ending Stocks").otherwise("Refinery Inputs")
    return lines(spark, sf_dir).select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_quantity").alias("volume_k_barrels"),
        _pick("l_returnflag", {"N": "Distillate Fuel Oil", "A": "Crude Oil"}, F.lit("Finished Motor Blend")).alias(
            "product_name"
        ),
        process.alias("process_name"),
        _pick("l_linestatus", {"O": "U.S."}, F.lit("PADD 1")).alias("area"),
        *besides,
    )


def silver_movements(spark: SparkSession, sf_dir: str, *besides: str) -> DataFrame:
    return lines(spark, sf_dir).select(
        month_start(booked("l_shipdate")).alias("month_date"),
        F.col("l_extendedprice").alias("volume_k_barrels_per_day"),
        _pick("l_returnflag", {"N": "Distillate Fuel Oil"}, F.lit("Residual Fuel Oil")).alias("product_name"),
        _pick("l_linestatus", {"O": "U.S."}, F.lit("X")).alias("country_code"),
        F.when(F.col("l_tax") <= 0.04, "Net Imports").otherwise("Exports").alias("description"),
        *besides,
    )


# Documents are made after the shuffle that spreads their rows by snapshot: rows are narrower than text.


def _document(records: Column) -> Column:
    return F.to_json(F.struct(F.struct(records.alias("data")).alias("response")))


def _record(period: Column, value: Column, **names: Column) -> Column:
    fields = [column.alias(name.replace("_", "-")) for name, column in names.items()]
    return F.struct(period.alias("period"), value.alias("value"), *fields)


def price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per order; pending orders have no price yet and arrive in the latest snapshot; credits are negative."""
    status = F.col("o_orderstatus")
    years_later = F.when(status == "F", 1).when(status == "O", 2).otherwise(3)
    record = _record(
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.when(status != "P", F.when(F.col("o_custkey") % 40 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))),
        product_name=F.col("o_orderpriority"),
        process_name=status,
    )
    return table(spark, sf_dir, "orders").hint("rebalance", "o_orderstatus").select(
        _document(F.array(record)).alias("document"),
        F.make_date(F.year("o_orderdate") + years_later, F.lit(1), F.lit(1)).alias("snapshot"),
    )


def stock_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per line item with four records; stock is the quantity above a reserve of five.

    Highly taxed lines do not say what process their stock is of.
    """
    period = F.date_format("l_shipdate", "yyyy-MM-dd")
    measures = {
        "Ending Stocks": F.col("l_quantity") - 5,
        "Net Imports": F.col("l_extendedprice"),
        "Refinery Inputs": F.col("l_discount"),
        "Exports": F.col("l_tax"),
    }
    records = [
        _record(
            period,
            value,
            product_name=F.col("l_returnflag"),
            process_name=F.when((F.col("l_tax") <= 0.07) | F.lit(process != "Ending Stocks"), process),
            area_name=F.col("l_linestatus"),
        )
        for process, value in measures.items()
    ]
    return lines(spark, sf_dir).hint("rebalance", "l_linenumber").select(
        _document(F.array(*records)).alias("document"), F.col("l_linenumber").alias("snapshot")
    )


def movement_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per line item, broken into lines; an undiscounted line has no value."""
    record = _record(
        F.date_format("l_shipdate", "yyyy-MM"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice")),
        product_name=F.col("l_returnflag"),
        area_name=F.col("l_linestatus"),
        series_description=F.concat(F.lit("Net Imports "), F.col("l_tax")),
    )
    indented = F.replace(_document(F.array(record)), F.lit("{"), F.lit("{\n  "))
    return lines(spark, sf_dir).hint("rebalance", "l_linenumber").select(
        indented.alias("document"), F.col("l_linenumber").alias("snapshot")
    )


def market_documents(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three feeds of the star as documents of one record each, in snapshots 1 to 3."""
    date = F.date_format("date", "yyyy-MM-dd")
    of_line = (F.col("l_linenumber") % 3 + 1).alias("snapshot")
    prices = silver_prices(spark, sf_dir).withColumn("snapshot", F.dayofmonth("date") % 3 + 1)
    stocks = silver_stocks(spark, sf_dir, "l_linenumber")
    flows = silver_movements(spark, sf_dir, "l_linenumber")
    product = F.col("product_name")
    records = {
        "petroleum_prices": (prices, _record(date, F.col("price_usd_per_gal"), product_name=product, process_name=F.lit("Retail")), F.col("snapshot")),
        "supply_estimates": (
            stocks,
            _record(date, F.col("volume_k_barrels"), product_name=product, process_name=F.col("process_name"), area_name=F.col("area")),
            of_line,
        ),
        "logistics_movements": (
            flows,
            _record(
                F.date_format("month_date", "yyyy-MM"),
                F.col("volume_k_barrels_per_day"),
                product_name=product,
                area_name=F.col("country_code"),
                series_description=F.col("description"),
            ),
            of_line,
        ),
    }
    return {feed: df.select(_document(F.array(record)).alias("document"), snapshot.alias("snapshot")) for feed, (df, record, snapshot) in records.items()}
