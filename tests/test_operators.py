import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators.dedup import keep_latest, keep_one, latest_n, latest_n_per_series
from feedloom.operators.dims import KeyCollisionError, conform, named_dimension, require_unique_keys
from feedloom.operators.facts import (
    add_monthly_total,
    add_weekly_total,
    attach_month,
    join_on_week,
    lookup_key,
    monthly_sum,
    weekly_sum,
)
from feedloom.operators.merge import upsert
from feedloom.operators.quality import Rule, bad_rows, quality_counts, shares_above, split_valid, tag_errors
from feedloom.operators.sinks import land_snapshot, replace_table, stage_jdbc
from feedloom.scratch import scratch_root
from feedloom.sources.tables import date_range, read_optional
from tests.conftest import rows


def day(text):
    return dt.date.fromisoformat(text)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(3))
def test_survivor_is_the_same_for_any_order_and_partitioning(spark, seed):
    rng = random.Random(seed)
    data = [(rng.randrange(5), rng.choice("abc"), rng.randrange(3), rng.choice([None, 1.5, 2.5])) for _ in range(200)]
    best = {}
    for k, s, t, v in data:
        rank = (s, t, v is not None, v or 0)
        best[k] = max(best.get(k, rank), rank)
    want = sorted((k, s, t, v if known else None) for k, (s, t, known, v) in best.items())
    for parts in (1, 4):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k int, s string, t int, v double").repartition(parts)
        assert rows(keep_latest(df, ["k"], "s")) == want


def test_keep_one_of_pure_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert rows(keep_one(df, ["k"])) == [(None,), (1,)]


def test_dedup_prunes_before_its_shuffle(spark):
    """A hot key must not be gathered whole: the group limit runs on the map side."""
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(keep_latest(df, ["k"], "id"))
    partial = [line for line in text.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert partial and text.index("Exchange") < text.index(partial[0])


@pytest.mark.parametrize("n", [2, 1500])
def test_latest_n_per_series_matches_brute_force(spark, n):
    df = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("s"), "id"
    )
    data = df.collect()
    want = []
    for s in {r.s for r in data}:
        want += sorted(((r.s, r.id) for r in data if r.s == s), key=lambda t: -t[1])[:n]
    got = latest_n_per_series(df, n, ["s"], [F.col("id").desc()], salts=4)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_latest_n(spark):
    df = spark.range(100)
    top = latest_n(df, 3, [F.col("id").desc()])
    assert [r.id for r in top.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in plan(top)


RULES = [Rule("low", "v >= 0"), Rule("high", "v < 10")]


def test_split_is_complete_and_names_the_first_failure(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (11.0,), (None,), (float("nan"),)], "v double")
    valid, bad = split_valid(df, RULES)
    assert rows(valid) == [(1.0,)]
    assert [r[1] for r in rows(bad)] == ["low", "low", "high", "high"]
    counts = quality_counts(tag_errors(df, RULES)).first()
    assert (counts.total_rows, counts.valid_rows, counts.bad_rows, counts.bad_share) == (5, 1, 4, 0.8)


def test_counts_of_nothing(spark):
    counts = quality_counts(tag_errors(spark.createDataFrame([], "v double"), RULES)).first()
    assert (counts.total_rows, counts.bad_rows, counts.bad_share) == (0, 0, None)


def test_no_rules_means_valid(spark):
    df = spark.range(3)
    assert bad_rows(tag_errors(df, [])).count() == 0


def test_shares_above_threshold(spark):
    data = [("a", 1.0)] * 19 + [("a", -1.0)] + [("b", 1.0)] * 9 + [("b", -1.0)]
    tagged = tag_errors(spark.createDataFrame(data, "g string, v double"), RULES)
    assert rows(shares_above(tagged, ["g"], 0.05), "g", "bad_share") == [("b", 0.1)]


def test_conform_and_named_dimension(spark):
    a = spark.createDataFrame([("x",), ("PADD 1",), (None,)], "area string")
    b = spark.createDataFrame([("x",), ("U.S.",)], "country_code string")
    assert rows(conform("n", (a, "area"), (b, "country_code"))) == [(None,), ("PADD 1",), ("U.S.",), ("x",)]
    dim = named_dimension("area", "area_type", [], "Other", (a, "area"), (b, "country_code"))
    assert dim.columns == ["area_name", "area_id", "area_type"]


def test_colliding_names_stop_the_load(spark):
    a = spark.createDataFrame([("plumless",), ("buckeroo",)], "n string")
    with pytest.raises(KeyCollisionError, match="buckeroo"):
        require_unique_keys(named_dimension("x", "t", [], "o", (a, "n")), "x_id", "x_name")
    require_unique_keys(named_dimension("x", "t", [], "o", (a, "n"), key_method="xxhash64"), "x_id", "x_name")


def feed(spark, *pairs):
    return spark.createDataFrame([(day(d), float(v)) for d, v in pairs], "date date, v double")


def test_week_join_at_year_end(spark):
    price = feed(spark, ("2024-12-30", 3))
    for mode, date, joins in (
        ("iso", "2025-01-03", True),
        ("calendar", "2025-01-03", False),
        ("iso", "2024-01-05", False),
        ("calendar", "2024-01-05", True),
    ):
        stock = feed(spark, (date, 10))
        weekly = weekly_sum(stock, "date", "v", "stock", mode=mode)
        for joined in (
            join_on_week(price, weekly, "date", mode),
            add_weekly_total(price, "date", stock, "date", "v", "stock", mode),
        ):
            assert (joined.count() == 1) is joins


def test_week_join_fans_out_over_areas(spark):
    stock = feed(spark, ("2024-05-03", 1), ("2024-05-03", 2)).withColumn("area", F.expr("'a' || int(v)"))
    weekly = weekly_sum(stock, "date", "v", "stock", by=("area",))
    joined = join_on_week(feed(spark, ("2024-04-29", 9)), weekly, "date")
    assert rows(joined, "area", "stock") == [("a1", 1.0), ("a2", 2.0)]


def test_missing_month_is_zero_with_a_flag(spark):
    flow = feed(spark, ("2024-05-01", 0), ("2024-06-01", -4))
    monthly = monthly_sum(flow, "date", "v", "flow")
    left = feed(spark, ("2024-05-06", 1), ("2024-06-03", 1), ("2024-07-01", 1)).drop("v")
    got = rows(add_monthly_total(left, "date", flow, "date", "v", "flow", found="has_macro"))
    assert got == rows(attach_month(left, monthly, "date", "flow", found="has_macro"))
    assert [r[1:] for r in got] == [(0.0, True), (-4.0, True), (0.0, False)]
    assert [r[1] for r in rows(attach_month(left, monthly, "date", "flow", fill=None))] == [0.0, -4.0, None]


def test_lookup_keeps_rows_without_a_member(spark):
    dim = spark.createDataFrame([("a", 1)], "name string, id long")
    df = spark.createDataFrame([("a",), ("b",), (None,)], "n string")
    assert rows(lookup_key(df, dim, "n", "name", "id")) == [(None, None), ("a", 1), ("b", None)]


def test_upsert_cases(spark):
    target = spark.createDataFrame([(1, "old"), (2, "same"), (3, "kept"), (None, "old")], "k int, v string")
    staged = spark.createDataFrame([(1, "new"), (2, "same"), (4, "added"), (None, "new")], "k int, v string")
    want = [(None, "new"), (1, "new"), (2, "same"), (3, "kept"), (4, "added")]
    once = upsert(target, staged, ["k"])
    assert rows(once) == want
    assert rows(upsert(once, staged, ["k"])) == want
    assert rows(upsert(None, staged, ["k"])) == rows(staged)


def test_upsert_reduces_staged_duplicates(spark):
    target = spark.createDataFrame([(1, 0)], "k int, v int")
    staged = spark.createDataFrame([(1, 5), (1, 7), (1, 6)], "k int, v int")
    assert rows(upsert(target, staged, ["k"])) == [(1, 7)]
    assert rows(upsert(target, staged, ["k"], [F.col("v").asc()])) == [(1, 5)]


def test_landing_replaces_a_date_and_adds_another(spark, tmp_path):
    path = str(tmp_path / "landing")

    def snapshot(date, v):
        return spark.createDataFrame([(v, day(date))], "v int, load_date date")

    land_snapshot(snapshot("2024-05-06", 1), path)
    land_snapshot(snapshot("2024-05-06", 2), path)
    land_snapshot(snapshot("2024-05-07", 3), path)
    assert rows(spark.read.parquet(path), "v") == [(2,), (3,)]


def test_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path, sort_by=("id",))
    replace_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(Exception, match="lost"):
        replace_table(spark.range(9).select(F.raise_error(F.lit("lost")).cast("string").alias("id")), path)
    assert spark.read.parquet(path).count() == 2
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_indented_documents_land_whole(spark, tmp_path):
    path = str(tmp_path / "landed")
    documents = spark.createDataFrame([('{\n  "a": [1,\r\n 2]\n}', 1)], "document string, stamp int")
    land_snapshot(documents, path, "stamp", fmt="text")
    assert spark.read.schema("a array<int>").json(path).first()["a"] == [1, 2]


def test_optional_source(spark, tmp_path, caplog):
    assert read_optional(spark, str(tmp_path / "absent")) is None
    assert "absent" in caplog.text
    spark.range(2).write.parquet(str(tmp_path / "there"))
    assert read_optional(spark, str(tmp_path / "there")).count() == 2


def test_jdbc_staging_options():
    """The writer's arguments only: a database is not started for a test."""
    calls = []

    class Frame:
        class write:
            @staticmethod
            def jdbc(**arguments):
                calls.append(arguments)

    name = stage_jdbc(Frame, "jdbc:x", "dim_date", {"user": "u"}, connections=4)
    assert name == "dim_date_staging"
    assert calls == [
        {
            "url": "jdbc:x",
            "table": "dim_date_staging",
            "mode": "overwrite",
            "properties": {"user": "u", "numPartitions": "4", "batchsize": "10000"},
        }
    ]


def test_date_range_is_inclusive_and_pushed(spark, tmp_path):
    path = str(tmp_path / "t")
    feed(spark, *((f"2024-05-{d:02}", d) for d in range(1, 11))).write.parquet(path)
    df = date_range(spark.read.parquet(path), "date", "2024-05-03", "2024-05-05")
    assert [r[1] for r in rows(df)] == [3.0, 4.0, 5.0]
    pushed = plan(df).split("PushedFilters: ")[1].split("]")[0]
    assert "GreaterThanOrEqual(date,2024-05-03)" in pushed and "LessThan(date,2024-05-06)" in pushed
    stamped = spark.sql("SELECT timestamp_ntz'2024-05-05 23:59:59' AS t UNION ALL SELECT timestamp_ntz'2024-05-06'")
    assert date_range(stamped, "t", "2024-05-05", "2024-05-05").count() == 1


class OtherSession:
    """The session under another master, with the scratch setting given."""

    def __init__(self, spark, root, master):
        self._spark = spark
        self.conf = {"spark.checkpoint.dir": root}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": master})
        self._jvm, self._jsc = spark._jvm, spark._jsc


def test_scratch_follows_the_session(spark):
    assert scratch_root(OtherSession(spark, "hdfs://shared/scratch/", "yarn")) == "hdfs://shared/scratch"
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            scratch_root(OtherSession(spark, None, master))
    own = scratch_root(OtherSession(spark, None, "local[2]"))
    assert own == scratch_root(OtherSession(spark, None, "local[2]")) and own.startswith("file:")
