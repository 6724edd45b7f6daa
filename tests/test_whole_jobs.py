"""Registered queries on small tables of their own, against the same SQL as the given ones."""

import datetime as dt

import duckdb
import pytest

from pyspark.sql import functions as F

from checks import spark_queries
from checks.compare import canonical
from checks.oracles import ORACLES
from checks.spark_queries import QUERIES
from feedloom.operators.sinks import land_snapshot
from feedloom.scratch import materialize
from feedloom.sources.feeds import PRICES, STOCKS
from feedloom.streaming import incremental
from tests.conftest import price, rows

ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def order(key, status, price=10.0, customer=1, day=1, priority="1-URGENT"):
    return (key, customer, status, price, dt.datetime(1998, 3, day), priority)


def matches_sql(spark, folder, name, table, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    found = QUERIES[name](spark, str(folder)).toPandas()
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
        theirs = connection.sql(ORACLES[name]).df()
    assert canonical(found) == canonical(theirs)
    return found


@pytest.mark.parametrize(
    ("orders", "n_valid", "n_bad"),
    [
        ([order(1, "F"), order(2, "P"), order(3, "P", day=2), order(4, "O", day=2)], 0, 2),
        ([order(1, "F"), order(2, "O"), order(3, "F", day=2)], 2, 0),
        ([order(1, "F"), order(2, "O", customer=40), order(3, "F", day=2)], 1, 1),
        ([], 0, 0),
    ],
    ids=["no price is valid", "no price is bad", "both", "no rows"],
)
def test_price_feed_returns_what_its_gates_leave(spark, tmp_path, orders, n_valid, n_bad):
    found = matches_sql(spark, tmp_path, "clean_price_feed", "orders", orders, ORDERS)
    assert (found["error_reason"].isna().sum(), found["error_reason"].notna().sum()) == (n_valid, n_bad)


def stock_lines(spark, folder, n=4000):
    number = F.col("id")
    lines = spark.range(n).select(
        number.alias("l_orderkey"), (number % 7).cast("int").alias("l_linenumber"), (number % 50).cast("double").alias("l_quantity"),
        (number * 1.25).alias("l_extendedprice"), (number % 10 / 100).alias("l_discount"), (number % 9 / 100).alias("l_tax"),
        F.element_at(F.array(*map(F.lit, "ANR")), (number % 3 + 1).cast("int")).alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.expr("timestamp(date_add(DATE'1998-01-01', cast(id % 300 as int)))").alias("l_shipdate"),
    )
    materialize(lines.coalesce(2), f"{folder}/lineitem.parquet")


def test_landed_documents_are_compressed_and_their_files_bounded(spark, tmp_path, monkeypatch):
    """A compressed file is read by one task; the plain text of the documents is several times as large."""
    stock_lines(spark, tmp_path)
    monkeypatch.setattr(spark_queries, "DOCUMENTS_PER_FILE", 100)
    documents = spark_queries.roles.stock_documents(spark, str(tmp_path))
    spark_queries._land(documents, f"{tmp_path}/landed")
    land_snapshot(documents, f"{tmp_path}/plain", "snapshot", fmt="text", rebalance=False)
    files = list((tmp_path / "landed").glob("*/part-*"))
    plain = sum(f.stat().st_size for f in (tmp_path / "plain").glob("*/part-*"))
    assert sum(f.stat().st_size for f in files) * 3 < plain
    landed = spark.read.text(f"{tmp_path}/landed")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, spark.read.text(f"{tmp_path}/plain").collect()))
    per_file = landed.groupBy(F.col("_metadata.file_path")).count().collect()
    assert max(r["count"] for r in per_file) <= 100 and sum(r["count"] for r in per_file) == 4000


@pytest.mark.parametrize("name", ["explode_nested", "clean_stock_feed"])
def test_queries_land_compressed(spark, tmp_path, monkeypatch, name):
    stock_lines(spark, tmp_path)
    paths = []
    work_path = spark_queries._work_path
    monkeypatch.setattr(spark_queries, "_work_path", lambda *args: paths.append(work_path(*args)) or paths[-1])
    found = QUERIES[name](spark, str(tmp_path))
    assert paths and all(f.endswith(".snappy") for f in spark.read.text(paths[0]).inputFiles())
    assert found.count() > 0 and set(STOCKS.texts) <= set(found.columns)


def test_arrivals_are_written_once(spark, land, tmp_path, monkeypatch):
    """New rows go straight to the folders that are published, and rows that stay join them there."""
    stored = []
    monkeypatch.setattr(incremental, "materialize", lambda df, path: stored.append(path.rsplit("/", 1)[1]) or materialize(df, path))
    store, source = str(tmp_path / "store"), f"{land.folder}/*.json"
    land("prices_20240101.json", [price("2023-05-01", "1.5"), price("2022-05-01", "2.5")])
    assert incremental.merge_arrivals(spark, PRICES, source, store) == 1
    land("prices_20240102.json", [price("2023-05-02", "3.5"), price("no date", "4.5")])
    assert incremental.merge_arrivals(spark, PRICES, source, store) == 1
    land("prices_20240102.json", [price("2023-05-03", "55.5"), price("2023-05-01", "6.5")])
    assert incremental.merge_arrivals(spark, PRICES, source, store) == 1
    land("prices_20240103.json", [])
    assert incremental.merge_arrivals(spark, PRICES, source, store) == 1
    assert stored == ["listing", "gone"] * 4
    found = incremental.arrived_feed(spark, PRICES, store).select("date", "price_usd_per_gal", "error_reason")
    assert rows(found) == [(dt.date(2022, 5, 1), 2.5, None), (dt.date(2023, 5, 1), 6.5, None), (dt.date(2023, 5, 3), 55.5, None)]
    (tmp_path / "bronze" / "prices_20240102.json").unlink()
    assert incremental.merge_arrivals(spark, PRICES, source, store) == 0
    found = incremental.arrived_feed(spark, PRICES, store).select("date", "price_usd_per_gal")
    assert rows(found) == [(dt.date(2022, 5, 1), 2.5), (dt.date(2023, 5, 1), 1.5)]
