"""Whole jobs on small hand-made feeds."""

import datetime as dt
import json
import os
import time
from dataclasses import replace
from decimal import Decimal

import pytest

from feedloom.operators.dims import KeyCollisionError
from feedloom.operators.publish import current_table
from feedloom.operators.quality import FeedQualityError
from feedloom.plans.clean import tagged_feed
from feedloom.__main__ import main
from feedloom.plans.load import load_star, register_served, stage_star
from feedloom.plans.pipeline import Paths, run
from feedloom.plans.star import StarOptions, build_star, market_fact
from feedloom.sources.feeds import PRICES, STOCKS, read_documents
from feedloom.streaming.incremental import arrived_feed, merge_arrivals
from tests.conftest import movement, price, rows, stock

DIESEL, NATION = 429045491, 2718189630


@pytest.fixture
def paths(tmp_path, land):
    land(
        "prices_20240513.json",
        [price("2024-05-06", 3.1234), price("2024-05-13", "3.2"), price("2024-06-03", 9), price("2024-05-06", 2, "Gasoline")],
    )
    land("supply_20240506.json", [stock("2024-05-10", 100)])
    land(
        "supply_20240513.json",
        [
            stock("2024-05-10", 110),
            stock("2024-05-10", 7, "Distillate Fuel Oil, Low Sulfur"),
            stock("2024-05-17", 120),
            stock("2024-05-17", 999, area="PADD 1"),
            stock("2024-05-17", 999, product="Crude Oil"),
            stock("2024-05-17", -3, product="Propane"),
        ],
    )
    land(
        "movements_20240513.json",
        [movement("2024-05", -425.555), movement("2024-05", 1, description="Exports"), movement("2024-04", 5, area="X")],
    )
    return Paths.under(str(tmp_path))


def test_pipeline(spark, paths):
    counts = run(spark, paths, "20240513")
    assert {k: (c.total, c.valid, c.bad) for k, c in counts.items()} == {
        "petroleum_prices": (4, 4, 0),
        "supply_estimates": (6, 5, 1),
        "logistics_movements": (3, 3, 0),
    }
    fact = spark.read.parquet(f"{paths.gold}/fact_diesel_market")
    assert fact.dtypes == [
        ("date", "date"),
        ("product_id", "bigint"),
        ("area_id", "bigint"),
        ("price_usd_per_gal", "double"),
        ("total_stock_k_barrels", "double"),
        ("monthly_net_imports_k_bpd", "double"),
    ]
    assert rows(fact) == [
        (dt.date(2024, 5, 6), DIESEL, NATION, 3.123, 117.0, -425.56),
        (dt.date(2024, 5, 13), DIESEL, NATION, 3.2, 120.0, -425.56),
    ]
    assert rows(spark.read.parquet(f"{paths.gold}/dim_area"), "area_name", "area_type") == [
        ("PADD 1", "PADD District"),
        ("U.S.", "Country"),
        ("X", "Other/Unknown"),
    ]
    dates = spark.read.parquet(f"{paths.gold}/dim_date")
    assert rows(dates, "date", "week_of_year") == [
        (dt.date(2024, 5, 6), 19),
        (dt.date(2024, 5, 10), 19),
        (dt.date(2024, 5, 13), 20),
        (dt.date(2024, 5, 17), 20),
        (dt.date(2024, 6, 3), 23),
    ]
    served = current_table(spark, paths.serving, "fact_diesel_market")
    assert rows(served, "price_usd_per_gal") == [(Decimal("3.123"),), (Decimal("3.200"),)]


def tables(spark, paths):
    names = ("dim_date", "dim_product", "dim_area", "fact_diesel_market")
    return {n: rows(current_table(spark, paths.serving, n)) for n in names}


def test_rerun_changes_nothing_and_new_weeks_add(spark, paths, land):
    run(spark, paths, "1")
    before = tables(spark, paths)
    run(spark, paths, "1")
    assert tables(spark, paths) == before
    land("prices_20240520.json", [price("2024-05-20", 3.3), price("2024-05-13", 3.9)])
    land("supply_20240520.json", [stock("2024-05-24", 130)])
    run(spark, paths, "2")
    after = tables(spark, paths)["fact_diesel_market"]
    assert [str(r[3]) for r in after] == ["3.123", "3.900", "3.300"]


def test_gone_from_bronze_survives_in_serving(spark, paths, land):
    """The serving tables are upserted, never emptied."""
    run(spark, paths, "1")
    land("prices_20240513.json", [price("2024-05-13", 4)])
    run(spark, paths, "2")
    facts = tables(spark, paths)["fact_diesel_market"]
    assert [(r[0].day, str(r[3])) for r in facts] == [(6, "3.123"), (13, "4.000")]


def test_gate_stops_the_run(spark, paths, land):
    run(spark, paths, "1")
    before = tables(spark, paths)
    land("movements_20240513.json", [])
    with pytest.raises(FeedQualityError, match="logistics_movements"):
        run(spark, paths, "2")
    assert tables(spark, paths) == before


def test_load_merges_only_what_exists(spark, paths, tmp_path):
    run(spark, paths, "1")
    partial = str(tmp_path / "partial")
    spark.read.parquet(f"{paths.gold}/dim_area").write.parquet(f"{partial}/dim_area")
    serving = str(tmp_path / "other")
    assert load_star(spark, str(tmp_path / "none"), serving) is None
    assert load_star(spark, partial, serving) == 1
    assert current_table(spark, serving, "dim_area").count() == 3
    assert current_table(spark, serving, "dim_date") is None


def test_nameless_members_stay_in_gold(spark, paths, land):
    land("supply_20240514.json", [{**stock("2024-05-17", 1), "area-name": None}])
    run(spark, paths, "1")
    assert spark.read.parquet(f"{paths.gold}/dim_area").filter("area_id IS NULL").count() == 1
    assert current_table(spark, paths.serving, "dim_area").filter("area_id IS NULL").count() == 0


def test_colliding_products_stop_the_build(spark, paths, land):
    land("prices_20240514.json", [price("2024-05-06", 1, "plumless"), price("2024-05-06", 1, "buckeroo")])
    with pytest.raises(KeyCollisionError):
        run(spark, paths, "1")
    run(spark, paths, "1", StarOptions(key_method="xxhash64"))
    assert current_table(spark, paths.serving, "dim_product").count() == 7


def test_served_tables_answer_sql(spark, paths):
    run(spark, paths, "1")
    assert len(register_served(spark, paths.serving)) == 4
    got = spark.sql("""
        SELECT d.week_of_year, p.product_category, a.area_name, avg(f.price_usd_per_gal), sum(f.total_stock_k_barrels)
        FROM fact_diesel_market f
        JOIN dim_date d ON f.date = d.date
        JOIN dim_product p ON f.product_id = p.product_id
        JOIN dim_area a ON f.area_id = a.area_id
        WHERE d.year = 2024 AND p.product_category = 'Distillate Fuel'
        GROUP BY ALL ORDER BY 1""").collect()
    assert [(r[0], r[1], r[2], float(r[3]), r[4]) for r in got] == [
        (19, "Distillate Fuel", "U.S.", 3.123, 117.0),
        (20, "Distillate Fuel", "U.S.", 3.2, 120.0),
    ]


def test_command_line(spark, paths, tmp_path):
    main(["run", "--root", str(tmp_path), "--batch-id", "7"])
    assert current_table(spark, paths.serving, "fact_diesel_market").count() == 2
    with pytest.raises(SystemExit):
        main(["run"])
    with pytest.raises(SystemExit):
        main(["run", "--root", str(tmp_path)])


def test_stage_star_names(spark, paths, monkeypatch):
    run(spark, paths, "1")
    staged = []
    monkeypatch.setattr("feedloom.plans.load.stage_jdbc", lambda df, url, name, p: staged.append((name, dict(df.dtypes))) or name)
    names = stage_star(spark, paths.gold, "jdbc:x", {})
    assert names == ["dim_date", "dim_product", "dim_area", "fact_diesel_market"]
    assert staged[-1][1]["price_usd_per_gal"] == "decimal(10,3)"


def silver(spark, prices, stocks, flows=()):
    day = dt.date.fromisoformat
    return (
        spark.createDataFrame(
            [(day(d), v, "No 2 Diesel", "Retail") for d, v in prices],
            "date date, price_usd_per_gal double, product_name string, process_name string",
        ),
        spark.createDataFrame(
            [(day(d), v, "Distillate Fuel Oil", "Ending Stocks", "U.S.") for d, v in stocks],
            "date date, volume_k_barrels double, product_name string, process_name string, area string",
        ),
        spark.createDataFrame(
            [(day(d), v, "Distillate Fuel Oil", "U.S.", "Net Imports") for d, v in flows],
            "month_date date, volume_k_barrels_per_day double, product_name string, country_code string, description string",
        ),
    )


def test_fact_week_key_options(spark):
    frames = silver(spark, [("2024-12-30", 3.0)], [("2025-01-03", 10.0), ("2024-01-05", 99.0)])
    assert rows(market_fact(*frames), "total_stock_k_barrels") == [(10.0,)]
    assert rows(market_fact(*frames, StarOptions(week_key="calendar")), "total_stock_k_barrels") == [(99.0,)]


def test_fact_macro_flag(spark):
    frames = silver(spark, [("2024-05-06", 3.0), ("2024-06-03", 3.0)], [("2024-05-10", 1.0), ("2024-06-07", 1.0)], [("2024-05-01", 0.0)])
    fact = market_fact(*frames, StarOptions(has_macro="has_macro"))
    assert rows(fact, "date", "monthly_net_imports_k_bpd", "has_macro") == [
        (dt.date(2024, 5, 6), 0.0, True),
        (dt.date(2024, 6, 3), 0.0, False),
    ]


def test_build_star_keys_equal_dimension_lookup(spark, paths):
    run(spark, paths, "1")
    build_star(spark, paths.silver, paths.gold)
    fact = spark.read.parquet(f"{paths.gold}/fact_diesel_market")
    products = spark.read.parquet(f"{paths.gold}/dim_product")
    areas = spark.read.parquet(f"{paths.gold}/dim_area")
    assert fact.join(products, "product_id").join(areas, "area_id").count() == fact.count() == 2


@pytest.mark.parametrize("arrival", [("1", "2", "3"), ("3", "1", "2")])
def test_incremental_equals_batch(spark, tmp_path, land, arrival):
    """Snapshots in any order, one run each, plus a run with nothing new."""
    snapshots = {
        "1": [stock("2023-12-29", 5), stock("2024-05-03", 6), stock("2024-13-01", 1), stock("2024-05-03", 1, process="Other")],
        "2": [stock("2024-05-03", 7), stock("2024-05-10", -1)],
        "3": [stock("2024-05-10", 8), stock("2023-12-29", None)],
    }
    store = str(tmp_path / "store")
    source = f"{land.folder}/supply_*.json"
    for n in arrival:
        land(f"supply_2024060{n}.json", snapshots[n])
        assert merge_arrivals(spark, STOCKS, source, store) == 1
    assert merge_arrivals(spark, STOCKS, source, store) == 0
    columns = [*STOCKS.columns, "error_reason"]
    batch = tagged_feed(read_documents(spark, STOCKS, source), STOCKS)
    got = arrived_feed(spark, STOCKS, store)
    assert rows(got, *columns) == rows(batch, *columns)
    assert got.count() == 4


@pytest.mark.parametrize("incremental", [False, True])
def test_landed_documents_give_the_same_result(spark, paths, land, tmp_path, incremental):
    """Landed from indented files, with one of them truncated."""
    text = json.dumps({"response": {"data": [price("2024-05-13", 3.1), price("2024-05-20", "x")]}}, indent=2)
    land("prices_20240521.json", text)
    land("prices_20240522.json", text[:-9])
    landed = replace(Paths.under(str(tmp_path / "other")), bronze=paths.bronze)
    counts = run(spark, landed, "1", incremental=incremental, landed=True)
    assert counts == run(spark, paths, "1")
    for layer in ("silver/petroleum_prices", "gold/fact_diesel_market"):
        got, want = (spark.read.parquet(f"{root}/{layer}") for root in (tmp_path / "other", tmp_path))
        assert rows(got) == rows(want)


def test_facets_and_look_back_of_a_feed(spark, land):
    spec = replace(PRICES, facets={"process_name": ["Retail", "it's"]}, latest=2, series=("product_name",))
    land("prices_20240601.json", [price(f"2024-05-{d:02}", d, product=p) for p in "ab" for d in (6, 13, 20)])
    land("prices_20240602.json", [price("2024-05-27", 9, process="Other"), price("2024-05-27", 8, process=None), price("no date", 1)])
    tagged = tagged_feed(read_documents(spark, spec, f"{land.folder}/prices_*.json"), spec)
    found = rows(tagged, "product_name", "price_usd_per_gal", "error_reason")
    assert [r for r in found if r[2] is None] == [("a", 13.0, None), ("a", 20.0, None), ("b", 13.0, None), ("b", 20.0, None)]
    assert sorted(r[2] for r in found if r[2]) == ["Undecided Filter", "Unparsable Date"]


def test_values_too_fine_for_exact_sums_are_quarantined(spark, land):
    land("prices_20240601.json", [price("2024-05-06", "3.1234567"), price("2024-05-13", "3.123456"), price("2024-05-20", 1e9)])
    tagged = tagged_feed(read_documents(spark, PRICES, f"{land.folder}/prices_*.json"), PRICES)
    assert rows(tagged, "error_reason") == [(None,), (None,), ("Too Many Decimals",)]


def test_late_replaced_and_withdrawn_snapshots(spark, tmp_path, land):
    """After each change the store says what the batch job would."""
    store, source = str(tmp_path / "store"), f"{land.folder}/supply_*.json"
    columns = [*STOCKS.columns, "error_reason"]

    def agree(read):
        assert merge_arrivals(spark, STOCKS, source, store) == read
        batch = tagged_feed(read_documents(spark, STOCKS, source), STOCKS)
        assert rows(arrived_feed(spark, STOCKS, store), *columns) == rows(batch, *columns)

    land("supply_20240603.json", [stock("2024-05-03", 5), stock("2022-05-03", 9), stock("2024-05-10", 6)])
    agree(1)
    land("supply_20240601.json", [stock("2024-05-03", 4), stock("2023-01-06", 1)])
    ten_days_ago = time.time() - 10 * 86400
    os.utime(f"{land.folder}/supply_20240601.json", (ten_days_ago, ten_days_ago))
    agree(1)
    kept = json.loads((tmp_path / "store" / "_published" / "2.json").read_text())["supply_estimates"]
    # The same day fetched again: another value, and a year and a date that are gone.
    land("supply_20240603.json", [stock("2024-05-03", 4.5), stock("2024-05-17", None)])
    agree(1)
    now = json.loads((tmp_path / "store" / "_published" / "3.json").read_text())["supply_estimates"]
    assert now["2023"] == kept["2023"] and now["2024"] != kept["2024"] and "2022" not in now
    os.remove(f"{land.folder}/supply_20240601.json")
    agree(0)


def test_incremental_pipeline_equals_batch(spark, paths, land, tmp_path):
    """Two incremental runs over growing bronze serve what one batch run over all of it serves."""
    run(spark, paths, "1", incremental=True)
    land("prices_20240520.json", [price("2024-05-20", 3.3), price("2024-05-13", -1), price("2024-05-06", 3.5)])
    land("supply_20240520.json", [stock("2024-05-24", 130)])
    counts = run(spark, paths, "2", incremental=True)
    batch = replace(Paths.under(str(tmp_path / "batch")), bronze=paths.bronze)
    assert counts == run(spark, batch, "2")
    for layer in ("silver/petroleum_prices", "silver/supply_estimates", "gold/fact_diesel_market", "gold/dim_date"):
        got, want = (spark.read.parquet(f"{root}/{layer}") for root in (tmp_path, tmp_path / "batch"))
        assert rows(got) == rows(want)


def test_nothing_arrived(spark, tmp_path):
    assert arrived_feed(spark, PRICES, str(tmp_path / "store")) is None
