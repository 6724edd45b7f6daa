import datetime as dt
from dataclasses import replace

import pytest

from feedloom.operators.quality import FeedQualityError, quality_counts, quarantined
from feedloom.plans.clean import clean_files, materialize_counted, tagged_feed, valid_feed
from feedloom.scratch import materialize
from feedloom.sources.feeds import FEED_FILES, MOVEMENTS, PRICES, STOCKS, keep_facets, read_documents, unnest
from tests.conftest import movement, price, rows, stock

DAY = dt.date(2024, 5, 6)


def clean(spark, tmp_path, spec, folder, batch="1"):
    return clean_files(
        spark, spec, f"{folder}/{FEED_FILES[spec.name]}", str(tmp_path / "silver"), str(tmp_path / "bad"), batch
    )


def silver(spark, tmp_path, spec):
    return spark.read.parquet(str(tmp_path / "silver" / spec.name))


def quarantine(spark, tmp_path, spec):
    return quarantined(spark, str(tmp_path / "bad" / spec.name))


def test_prices(spark, tmp_path, land):
    land("prices_20240506.json", [price("2024-05-06", 3.5), price("2024-04-29", "3.4")])
    counts = clean(spark, tmp_path, PRICES, land.folder)
    assert (counts.total, counts.valid, counts.bad) == (2, 2, 0)
    df = silver(spark, tmp_path, PRICES)
    assert df.dtypes == [
        ("date", "date"),
        ("price_usd_per_gal", "double"),
        ("product_name", "string"),
        ("process_name", "string"),
    ]
    assert rows(df, "date", "price_usd_per_gal") == [(dt.date(2024, 4, 29), 3.4), (DAY, 3.5)]


@pytest.mark.parametrize("value", [None, "null", "", "1,000", -1, 0, "NaN", "Infinity", "-Infinity", {"a": 1}])
def test_bad_prices_are_quarantined(spark, tmp_path, land, value):
    land("prices_20240506.json", [price("2024-05-06", value), price("2024-05-13", 3.5)])
    counts = clean(spark, tmp_path, PRICES, land.folder)
    assert (counts.total, counts.valid, counts.bad) == (2, 1, 1)
    bad = quarantine(spark, tmp_path, PRICES)
    assert rows(bad, "date", "error_reason") == [(DAY, "Invalid or Null Price")]
    assert bad.filter("quarantined_at IS NULL").count() == 0


def test_quarantine_keeps_the_text_that_did_not_parse(spark, tmp_path, land):
    land("prices_20240506.json", [price("2024-05-06", "1,000"), price("2024-13-01", 2), price("2024-05-13", 3.5)])
    clean(spark, tmp_path, PRICES, land.folder)
    bad = quarantine(spark, tmp_path, PRICES)
    assert rows(bad, "raw_period", "raw_value", "snapshot") == [
        (None, "1,000", "prices_20240506.json"),
        ("2024-13-01", None, "prices_20240506.json"),
    ]


def test_unparsable_dates_stay_apart(spark, land):
    """Two bad periods of one product are two rejects; the same one in two snapshots is one."""
    land("prices_20240506.json", [price("2024-13-01", 3.5), price("2024-5-1", 3.5)])
    land("prices_20240507.json", [price("2024-13-01", 3.6)])
    tagged = tagged_feed(read_documents(spark, PRICES, f"{land.folder}/prices_*.json"), PRICES)
    assert rows(tagged, "_reject_id", "price_usd_per_gal", "error_reason") == [
        ("2024-13-01", 3.6, "Unparsable Date"),
        ("2024-5-1", 3.5, "Unparsable Date"),
    ]


@pytest.mark.parametrize("value, valid", [(None, 0), (-5, 0), ("NaN", 0), (0, 1), (12.5, 1)])
def test_stock_rule_decides_null_too(spark, tmp_path, land, value, valid):
    land("supply_20240506.json", [stock("2024-05-03", value), stock("2024-04-26", 7)])
    counts = clean(spark, tmp_path, STOCKS, land.folder)
    assert (counts.total, counts.valid, counts.bad) == (2, 1 + valid, 1 - valid)
    if not valid:
        reasons = quarantine(spark, tmp_path, STOCKS)
        assert rows(reasons, "error_reason") == [("Negative Volume in Ending Stocks",)]


def test_other_processes_are_filtered_not_quarantined(spark, tmp_path, land):
    land("supply_20240506.json", [stock("2024-05-03", 5), stock("2024-05-03", -9, process="Net Imports")])
    counts = clean(spark, tmp_path, STOCKS, land.folder)
    assert (counts.total, counts.bad) == (1, 0)


def test_overlapping_snapshots_count_once_and_newest_wins(spark, tmp_path, land):
    land("supply_20240503.json", [stock("2024-05-03", 5), stock("2024-04-26", 7)])
    land("supply_20240510.json", [stock("2024-05-03", 6), stock("2024-05-10", 8)])
    clean(spark, tmp_path, STOCKS, land.folder)
    values = rows(silver(spark, tmp_path, STOCKS), "date", "volume_k_barrels")
    assert [v for _, v in values] == [7.0, 6.0, 8.0]


def test_without_dedup_every_snapshot_counts(spark, land):
    land("supply_20240503.json", [stock("2024-05-03", 5)])
    land("supply_20240510.json", [stock("2024-05-03", 5)])
    documents = read_documents(spark, STOCKS, f"{land.folder}/supply_*.json")
    assert valid_feed(documents, STOCKS, dedup=False).count() == 2
    assert valid_feed(documents, STOCKS).count() == 1


def test_survivor_ignores_order_inside_a_file(spark, tmp_path, land):
    for records in ([price("2024-05-06", 3), price("2024-05-06", 4)], [price("2024-05-06", 4), price("2024-05-06", 3)]):
        land("prices_20240506.json", records)
        clean(spark, tmp_path, PRICES, land.folder)
        assert rows(silver(spark, tmp_path, PRICES), "price_usd_per_gal") == [(4.0,)]


def test_movements_may_be_negative(spark, tmp_path, land):
    land("movements_20240506.json", [movement("2024-05", -425.5), movement("2024-04", None), movement("2024-4", 1)])
    counts = clean(spark, tmp_path, MOVEMENTS, land.folder)
    assert (counts.total, counts.valid, counts.bad) == (3, 1, 2)
    df = silver(spark, tmp_path, MOVEMENTS)
    assert df.columns == ["month_date", "volume_k_barrels_per_day", "product_name", "country_code", "description"]
    assert rows(df, "month_date", "volume_k_barrels_per_day") == [(dt.date(2024, 5, 1), -425.5)]
    reasons = rows(quarantine(spark, tmp_path, MOVEMENTS), "error_reason")
    assert reasons == [("Null Volume Detected",), ("Unparsable Date",)]


def test_empty_documents_fail_the_gate(spark, tmp_path, land):
    land("prices_20240506.json", [])
    with pytest.raises(FeedQualityError, match="no rows"):
        clean(spark, tmp_path, PRICES, land.folder)


def test_truncated_document_is_quarantined_whole(spark, tmp_path, land):
    text = '{"response": {"data": [{"period": "2024-05'
    land("prices_20240505.json", text)
    land("prices_20240506.json", [price("2024-05-06", 3.5)])
    land("prices_20240507.json", [])
    counts = clean(spark, tmp_path, PRICES, land.folder)
    assert (counts.total, counts.valid, counts.bad) == (2, 1, 1)
    bad = quarantine(spark, tmp_path, PRICES)
    assert rows(bad, "error_reason", "raw_document") == [("Unreadable Document", text)]


def test_null_record_is_a_row(spark, tmp_path, land):
    land("prices_20240506.json", [price("2024-05-06", 3.5), None])
    counts = clean(spark, tmp_path, PRICES, land.folder)
    assert (counts.valid, counts.bad) == (1, 1)


def test_all_bad_leaves_quarantine_then_fails(spark, tmp_path, land):
    land("prices_20240506.json", [price("2024-05-06", -1)])
    with pytest.raises(FeedQualityError, match="no valid rows"):
        clean(spark, tmp_path, PRICES, land.folder)
    assert quarantine(spark, tmp_path, PRICES).count() == 1


def test_quarantine_holds_each_bad_row_once(spark, tmp_path, land):
    land("prices_20240506.json", [price("2024-05-06", -1), price("2024-05-13", 2)])
    for batch in ("1", "1", "2", "2"):
        clean(spark, tmp_path, PRICES, land.folder, batch)
    assert rows(quarantine(spark, tmp_path, PRICES), "first_batch", "last_batch") == [("1", "2")]
    land("prices_20240506.json", [price("2024-05-06", 1), price("2024-05-13", -2), price("2024-05-20", 2)])
    clean(spark, tmp_path, PRICES, land.folder, "2")
    found = rows(quarantine(spark, tmp_path, PRICES), "price_usd_per_gal", "first_batch", "last_batch")
    assert found == [(-1.0, "1", "1"), (-2.0, "2", "2")]
    land("prices_20240506.json", [price("2024-05-13", 2)])
    clean(spark, tmp_path, PRICES, land.folder, "2")
    assert rows(quarantine(spark, tmp_path, PRICES), "price_usd_per_gal") == [(-1.0,)]


def test_valid_and_bad_make_up_the_input(spark, land):
    values = [1, 0, -1, None, "x", "NaN", 5]
    land("prices_20240506.json", [price(f"2024-05-{i + 1:02}", v) for i, v in enumerate(values)])
    tagged = tagged_feed(read_documents(spark, PRICES, f"{land.folder}/prices_*.json"), PRICES)
    assert tagged.filter("error_reason IS NULL").count() == 2
    assert tagged.filter("error_reason IS NOT NULL").count() == 5


def test_facets(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "s string, n int")
    assert rows(keep_facets(df, {"s": ["a"], "n": [1, 3]})) == [("a", 1)]


def test_filter_takes_records_out_of_the_array(spark, land):
    """The feed's filter and facets, in the document's own names; records it cannot decide on stay for quarantine."""
    spec = replace(STOCKS, facets={"area": ["U.S.", "it's area"]})
    assert spec.record_filter == "(_r.`process-name` = 'Ending Stocks') AND _r.`area-name` IN ('U.S.', 'it\\'s area')"
    assert PRICES.record_filter is None and replace(STOCKS, keep="date > '2024-01-01'").record_filter is None
    land("supply_1.json", [stock("2024-05-10", 1), stock("2024-05-10", 2, process="Other"), stock("2024-05-10", 3, process=None), stock("2024-05-10", 4, area="X")])
    documents = read_documents(spark, spec, f"{land.folder}/supply_*.json")
    assert rows(unnest(documents, spec).select("record.value")) == [("1",), ("3",)]
    assert unnest(documents).count() == 4


def test_counts_come_from_the_write(spark, land, tmp_path):
    """Cleaning reads its documents once and the rows it wrote for its outputs only."""
    land("prices_1.json", [price("2024-05-06", 1), price("2024-05-13", -1), price("x", 1), price("2024-05-20", None)])
    tagged = tagged_feed(read_documents(spark, PRICES, f"{land.folder}/prices_*.json"), PRICES)
    reasons = [rule.reason for rule in PRICES.all_rules]
    spark.sparkContext.setJobGroup("counted", "")
    _, n = materialize_counted(tagged, reasons, str(tmp_path / "out"))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("plain", "")
    quality_counts(materialize(tagged, str(tmp_path / "plain"))).first()
    assert jobs < len(spark.sparkContext.statusTracker().getJobIdsForGroup("plain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert (n.total, n.valid, n.bad) == (4, 1, 3)
    assert {r: c for r, c in n.by_rule.items() if c} == {"Unparsable Date": 1, "Invalid or Null Price": 2}
    assert n.shares()["Unparsable Date"] == 0.25
