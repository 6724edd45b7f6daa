import datetime as dt

import pytest
from pyspark.sql import functions as F

from feedloom.functions.calendar import date_attributes, month_start, month_text, week_start, with_week_key
from feedloom.functions.classify import AREA_CLASSES, AREA_OTHERWISE, PRODUCT_CLASSES, PRODUCT_OTHERWISE, classify
from feedloom.functions.keys import colliding_keys, key_summary, surrogate_key
from feedloom.functions.parsing import parse_day, parse_month, parse_number
from feedloom.functions.sums import mean, total
from tests.conftest import rows


def days(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("date").alias("d"))


@pytest.mark.parametrize(
    "day, iso, calendar",
    [
        ("2024-12-30", (2025, 1), (2024, 1)),
        ("2025-01-03", (2025, 1), (2025, 1)),
        ("2024-01-05", (2024, 1), (2024, 1)),
        ("2026-12-28", (2026, 53), (2026, 53)),
        ("2027-01-01", (2026, 53), (2027, 53)),
        ("2026-05-18", (2026, 21), (2026, 21)),
    ],
)
def test_week_keys(spark, day, iso, calendar):
    for mode, want in (("iso", iso), ("calendar", calendar)):
        assert rows(with_week_key(days(spark, day), "d", mode), "week_year", "week_no") == [want]


def test_week_key_agrees_with_python_over_twenty_years(spark):
    span = spark.sql("SELECT explode(sequence(date'2009-12-01', date'2030-02-01')) AS d")
    got = with_week_key(span, "d").withColumn("monday", week_start(F.col("d"))).collect()
    assert len(got) > 7000
    for r in got:
        assert (r.week_year, r.week_no) == tuple(r.d.isocalendar())[:2]
        assert r.monday == r.d - dt.timedelta(days=r.d.weekday())


def test_unknown_week_mode(spark):
    with pytest.raises(ValueError, match="iso"):
        with_week_key(days(spark, "2024-01-01"), "d", "fiscal")


def test_month_keys_and_attributes(spark):
    d = F.col("d")
    df = days(spark, "2024-02-29")
    assert rows(df.select(month_text(d), month_start(d))) == [("2024-02", dt.date(2024, 2, 1))]
    attributes = df.withColumns(date_attributes(d)).drop("d")
    assert attributes.columns == ["year", "month", "quarter", "week_of_year", "day_of_week"]
    assert rows(attributes) == [(2024, 2, 1, 9, 5)]


def test_bad_text_parses_to_null(spark):
    text = F.col("t")
    df = spark.createDataFrame([(t,) for t in ("3.5", "null", "", "1,000", None)], "t string")
    assert [r[0] for r in df.select(parse_number(text)).collect()] == [3.5, None, None, None, None]
    df = spark.createDataFrame([(t,) for t in ("2024-05-01", "2024-13-01", "2024-5-1", "")], "t string")
    assert [r[0] for r in df.select(parse_day(text)).collect()] == [dt.date(2024, 5, 1), None, None, None]
    df = spark.createDataFrame([(t,) for t in ("2024-05", "2024-13", None)], "t string")
    assert [r[0] for r in df.select(parse_month(text)).collect()] == [dt.date(2024, 5, 1), None, None]


@pytest.mark.parametrize(
    "name, label",
    [
        ("Crude Diesel Blend", "Crude Oil"),
        ("U.S. No 2 Diesel", "Distillate Fuel"),
        ("Distillate Fuel Oil", "Distillate Fuel"),
        ("Motor Blend", "Gasoline"),
        ("Gasoline Diesel", "Distillate Fuel"),
        ("crude", "Other Petroleum Product"),
        (None, "Other Petroleum Product"),
    ],
)
def test_product_classes(spark, name, label):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(classify(F.col("n"), PRODUCT_CLASSES, PRODUCT_OTHERWISE)).first()[0] == label


@pytest.mark.parametrize(
    "name, label",
    [("U.S.", "Country"), ("PADD 1", "PADD District"), ("X PADD", "Other/Unknown"), (None, "Other/Unknown")],
)
def test_area_classes(spark, name, label):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(classify(F.col("n"), AREA_CLASSES, AREA_OTHERWISE)).first()[0] == label


def test_surrogate_keys(spark):
    df = spark.createDataFrame([("U.S.",), ("U.S. No 2 Diesel",), (None,)], "n string")
    assert [r[0] for r in df.select(surrogate_key(F.col("n"))).collect()] == [2718189630, 429045491, None]
    wide = [r[0] for r in df.select(surrogate_key(F.col("n"), "xxhash64")).collect()]
    assert wide[2] is None and len(set(wide)) == 3
    with pytest.raises(ValueError, match="crc32"):
        surrogate_key(F.col("n"), "md5")


def test_colliding_keys(spark):
    # Two words with one CRC-32.
    dim = spark.createDataFrame([("plumless",), ("buckeroo",), ("other",)], "n string")
    dim = dim.withColumn("id", surrogate_key(F.col("n")))
    assert rows(colliding_keys(dim, "id", "n"), "first_name", "last_name") == [("buckeroo", "plumless")]
    assert rows(key_summary(dim, "id", "n")) == [(3, 2, 1)]


def test_exact_sums_do_not_depend_on_order(spark):
    values = [0.1] * 10 + [1e9, -1e9, 0.35]
    want = 1.35
    for parts in (1, 3, 13):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        got = df.agg(total(F.col("v"), 2).alias("s"), mean(F.col("v"), 2).alias("m")).first()
        assert got.s == want and got.m == want / len(values)
    assert df.agg(total(F.col("v"))).first()[0] == pytest.approx(want)
