"""Load the gold tables into serving: staged first, then upserted and published together."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dims import require_unique_keys
from feedloom.operators.publish import ServedTable, current_table, publish
from feedloom.operators.sinks import stage_jdbc
from feedloom.plans.star import DIM_AREA, DIM_DATE, DIM_PRODUCT, FACT
from feedloom.scratch import drop_path, materialize, scratch_path
from feedloom.sources.tables import read_optional

# Each table's key; dimensions come before the fact that refers to them.
SERVED = (
    ServedTable(DIM_DATE, ("date",)),
    ServedTable(DIM_PRODUCT, ("product_id",)),
    ServedTable(DIM_AREA, ("area_id",)),
    ServedTable(FACT, ("date", "product_id", "area_id"), period="year(date)"),
)
# Fixed value: the serving type of a price.
PRICE_TYPE = "decimal(10,3)"


def serving_rows(spark: SparkSession, gold: str, table: ServedTable) -> DataFrame | None:
    """A gold table as it is served, or ``None`` if it was not built."""
    df = read_optional(spark, f"{gold}/{table.name}")
    return None if df is None else as_served(df, table)


def as_served(df: DataFrame, table: ServedTable) -> DataFrame:
    """Members without a name have no key and cannot be served; they stay in gold."""
    if table.name in (DIM_PRODUCT, DIM_AREA):
        return df.filter(F.col(table.keys[0]).isNotNull())
    if table.name == FACT:
        return df.withColumn("price_usd_per_gal", F.col("price_usd_per_gal").cast(PRICE_TYPE))
    return df


def load_star(spark: SparkSession, gold: str, serving: str) -> int | None:
    """Stage what exists, upsert exactly that, drop the staging. Returns the published version."""
    work = scratch_path(spark, "staging")
    staged = {}
    try:
        for table in SERVED:
            df = serving_rows(spark, gold, table)
            if df is not None:
                # The fact is files already, and large; the members are filtered once for several reads.
                staged[table.name] = df if table.name == FACT else materialize(df, f"{work}/{table.name}")
        if not staged:
            return None
        for name, prefix in ((DIM_PRODUCT, "product"), (DIM_AREA, "area")):
            if name in staged:
                require_unique_keys(staged[name], f"{prefix}_id", f"{prefix}_name")
        return publish(spark, serving, staged, SERVED)
    finally:
        drop_path(spark, work)


def register_served(spark: SparkSession, serving: str) -> list[str]:
    """Make the published tables queryable by name in SQL; the names registered.

    A view stays on the version it was registered at, so a long query never sees half a publish.
    """
    names = []
    for table in SERVED:
        df = current_table(spark, serving, table.name)
        if df is not None:
            df.createOrReplaceTempView(table.name)
            names.append(table.name)
    return names


def stage_star(spark: SparkSession, gold: str, url: str, properties: Mapping[str, str]) -> list[str]:
    """Stage the gold tables that exist in a database; the names of the tables written."""
    rows = {table.name: serving_rows(spark, gold, table) for table in SERVED}
    return [stage_jdbc(df, url, name, properties) for name, df in rows.items() if df is not None]
