import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedloom.functions.calendar import week_start
from feedloom.plans import marts
from tests.conftest import rows


@pytest.fixture(scope="module")
def sales(spark):
    """A hot series with a third of the rows, gaps, and dates across a year end."""
    rng = random.Random(7)
    data = []
    for _ in range(600):
        series = "hot" if rng.random() < 0.35 else rng.choice("abcd")
        date = dt.date(2023, 10, 2) + dt.timedelta(days=rng.choice((0, 7, 21, 35, 70, 91, 140, 300)) + rng.randrange(7))
        data.append((series, date, rng.randrange(1, 10_000) / 100))
    return spark.createDataFrame(data, "s string, d date, v double").cache(), data


def monday(d):
    return d - dt.timedelta(days=d.weekday())


def test_missing_weeks(sales):
    df, data = sales
    want = []
    for s in {r[0] for r in data}:
        weeks = {monday(d) for t, d, _ in data if t == s}
        w = min(weeks)
        while w <= monday(max(d for _, d, _ in data)):
            if w not in weeks:
                want.append((s, w))
            w += dt.timedelta(days=7)
    assert rows(marts.missing_weeks(df, "d", ["s"])) == sorted(want)


def test_missing_weeks_overall(sales):
    df, data = sales
    weeks = {monday(d) for _, d, _ in data}
    span = range(0, (max(weeks) - min(weeks)).days, 7)
    want = {min(weeks) + dt.timedelta(days=n) for n in span} - weeks
    assert [r[0] for r in rows(marts.missing_weeks(df, "d"))] == sorted(want)


def test_missing_weeks_ignores_rows_without_a_date(spark):
    df = spark.sql("SELECT date'2024-01-01' AS d UNION ALL SELECT NULL UNION ALL SELECT date'2024-01-15'")
    assert rows(marts.missing_weeks(df, "d")) == [(dt.date(2024, 1, 8),)]


def test_missing_weeks_of_a_series_that_stopped(spark):
    df = spark.sql("SELECT 'a' AS s, date'2024-01-01' AS d UNION ALL SELECT 'b', date'2024-01-17'")
    assert rows(marts.missing_weeks(df, "d", ["s"])) == [("a", dt.date(2024, 1, 8)), ("a", dt.date(2024, 1, 15))]
    assert rows(marts.missing_weeks(df, "d", ["s"], dt.date(2024, 1, 28))) == [
        ("a", dt.date(2024, 1, 8)),
        ("a", dt.date(2024, 1, 15)),
        ("a", dt.date(2024, 1, 22)),
        ("b", dt.date(2024, 1, 22)),
    ]


def test_latest_monthly_knows_months_without_rows(spark):
    df = spark.sql("SELECT date'2024-01-05' AS d UNION ALL SELECT date'2024-03-09' UNION ALL SELECT date'2023-12-31' UNION ALL SELECT NULL")
    monthly = spark.sql("SELECT date'2024-01-01' AS month_start, 1.0 AS v UNION ALL SELECT date'2024-02-01', 2.0 UNION ALL SELECT date'2024-05-01', 9.0")
    found = marts.latest_monthly(df, "d", monthly, "v")
    assert rows(found) == [(None, None), (dt.date(2023, 12, 31), None), (dt.date(2024, 1, 5), 1), (dt.date(2024, 3, 9), 2)]


def test_month_over_month(sales):
    df, data = sales
    cents = {}
    for s, d, v in data:
        key = (s, d.replace(day=1))
        cents[key] = cents.get(key, 0) + round(v * 100)
    got = {(r.s, r.month_start): r for r in marts.month_over_month(df, "d", "v", ["s"], 2).collect()}
    assert set(got) == set(cents)
    for (s, m), total in cents.items():
        before = cents.get((s, (m - dt.timedelta(days=1)).replace(day=1)))
        row = got[s, m]
        assert row.total == total / 100
        assert row.previous == (None if before is None else before / 100)
        assert (row.change is None) == (before is None)


def test_annual_rollup(sales):
    df, data = sales
    got = {(r.level, r.year, r.quarter): (r.n_rows, r.total) for r in marts.annual_rollup(df, "d", "v", 2).collect()}
    assert got[3, None, None] == (600, sum(round(v * 100) for *_, v in data) / 100)
    q4 = [v for _, d, v in data if d.year == 2023]
    assert got[0, 2023, 4] == got[1, 2023, None] == (len(q4), sum(round(v * 100) for v in q4) / 100)


def test_season_profile(sales):
    df, data = sales
    mondays = [v for _, d, v in data if d.month <= 3 and d.weekday() == 0]
    row = marts.season_profile(df, "d", "v", 2).filter("quarter = 1 AND day_of_week = 2").first()
    assert (row.n_rows, row.total) == (len(mondays), sum(round(v * 100) for v in mondays) / 100)
    assert row.average == pytest.approx(row.total / row.n_rows)


def test_lag_moves_dates_not_rows(spark):
    """The right side lacks a week; a row lag would pair its neighbours wrongly."""
    weeks = [dt.date(2024, 1, 1) + dt.timedelta(days=7 * n) for n in range(6)]
    right = spark.createDataFrame([(w, float(n * n)) for n, w in enumerate(weeks) if n != 2], "week_start date, r double")
    left = spark.createDataFrame([(w, float((n - 1) ** 2)) for n, w in enumerate(weeks)], "week_start date, l double")
    got = rows(marts.lag_correlation(left, "l", right, "r", lags=(1, 2)), "lag_weeks", "n_weeks", "correlation")
    assert got[0] == (1, 4, pytest.approx(1.0))
    assert got[1][:2] == (2, 3)


def test_carry_forward(spark):
    data = [("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("a", 4, 0.0), ("a", 5, None), ("b", 1, None)]
    df = spark.createDataFrame(data, "s string, d int, v double").repartition(3)
    assert rows(marts.carry_forward(df, "d", "v", ["s"])) == [
        ("a", 1, None),
        ("a", 2, 5.0),
        ("a", 3, 5.0),
        ("a", 4, 0.0),
        ("a", 5, 0.0),
        ("b", 1, None),
    ]


def test_weekly_mart(spark):
    d1, d2 = dt.date(2024, 5, 6), dt.date(2023, 5, 8)
    fact = spark.createDataFrame(
        [(d1, 1, 9, 3.0, 10.0), (d1, 2, 9, 4.0, 10.0), (d1, 3, 9, 9.0, 10.0), (d2, 1, 9, 1.0, 1.0), (d1, 1, 8, 1.0, 1.0)],
        "date date, product_id long, area_id long, price_usd_per_gal double, total_stock_k_barrels double",
    )
    dates = spark.createDataFrame([(d1, 2024, 19), (d2, 2023, 19)], "date date, year int, week_of_year int")
    products = spark.createDataFrame([(1, "D"), (2, "D"), (3, "C")], "product_id long, product_category string")
    areas = spark.createDataFrame([(9, "U.S.")], "area_id long, area_name string")
    got = marts.weekly_mart(fact, dates, products, areas, 2024, "D").collect()
    assert [tuple(r) for r in got] == [(2024, 19, "D", "U.S.", 3.5, 20.0)]
    years = [r.year for r in marts.weekly_mart(fact, dates, products, areas).collect()]
    assert years == sorted(years)


def test_week_start_is_monday(sales):
    df, data = sales
    assert {r[0] for r in df.select(week_start(F.col("d"))).collect()} == {monday(d) for _, d, _ in data}
