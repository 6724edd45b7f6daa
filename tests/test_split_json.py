"""Large indented documents read by many tasks give what the plain reader gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from feedloom.plans.clean import clean_files
from feedloom.sources.feeds import PRICES, STOCKS, read_documents, unnest
from feedloom.sources.split_json import lines_of, read_records
from tests.conftest import price, rows, stock

ODD = ["plain", 'a "quoted" {brace]', "back\\slash\\", "line\nbreak\ttab", "[", "}", "ünïcode", "", ":,", "data"]


def documents():
    rng = random.Random(4)
    records = [{**stock(f"2024-05-{i % 28 + 1:02}", rng.choice([i, f"{i}.50", None, 1e-7]), product=rng.choice(ODD)), "more": {"deep": [{"a": [1, {"}": 2}]}]}} for i in range(400)]
    whole = {"response": {"total": 400, "other": [{"period": "not a record"}], "data": records, "data2": [{"period": "x"}]}, "data": [{"period": "y"}]}
    yield "indented", json.dumps(whole, indent=2)
    yield "wide", json.dumps(whole, indent=7, ensure_ascii=False)
    yield "one line", json.dumps(whole)
    yield "key on a line of its own", json.dumps(whole, indent=1).replace('"data": [', '"data"\n\n:\n\n[').replace('"response": {', '"response":\n{')
    yield "empty", json.dumps({"response": {"data": []}}, indent=1)
    yield "no list", json.dumps({"response": {"data": None}}, indent=1)
    yield "another shape", json.dumps([1, {"response": 2}], indent=1)


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def same(spark, path):
    plain = unnest(read_documents(spark, STOCKS, path))
    fields = [F.col(f"record.`{name}`") for name in STOCKS.record_fields if name != STOCKS.value_field]
    told = lambda df: df.select(F.col("record").isNull(), F.col("record.value").try_cast("double"), *fields, *df.columns[1:])
    found = rows(told(read_records(spark, STOCKS, path)))
    assert found == rows(told(plain)) and len(found) > 500


def test_records_equal_the_plain_reader(spark, land, small_blocks):
    for n, (_, text) in enumerate(documents()):
        land(f"supply_{n}.json", text)
    path = f"{land.folder}/supply_*.json"
    assert lines_of(spark, path).select("file", "block").distinct().count() > 30
    same(spark, path)


def test_broken_documents_go_to_quarantine_whole(spark, land, small_blocks):
    text = dict(documents())["indented"]
    middle = text.index('"period": "2024-05-09"')
    land("supply_0.json", text)
    land("supply_1.json", text[: len(text) // 2])
    land("supply_2.json", text[:middle] + "nonsense " + text[middle:])
    land("supply_3.json", text.replace("    },\n      {", "    }\n      {", 1))
    land("supply_4.json", text.replace("    },\n      {", "    },,\n      {", 1))
    land("supply_5.json", text[:middle] + '"open\n' + text[middle:])
    land("supply_6.json", text + "}")
    same(spark, f"{land.folder}/supply_*.json")


def test_cleaning_with_split_documents(spark, land, tmp_path, small_blocks):
    land("prices_1.json", json.dumps({"response": {"data": [price(f"2024-05-{d:02}", d - 3) for d in range(1, 29)] * 20}}, indent=2))
    counts = [clean_files(spark, PRICES, f"{land.folder}/prices_*.json", str(tmp_path / f"s{x}"), str(tmp_path / f"q{x}"), "1", split=x) for x in (False, True)]
    assert counts[0] == counts[1] and counts[0].total == 28
    assert rows(spark.read.parquet(str(tmp_path / "sTrue/petroleum_prices"))) == rows(spark.read.parquet(str(tmp_path / "sFalse/petroleum_prices")))
