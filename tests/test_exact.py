"""Exact sums, stored states, as-of joins, the registry and quarantine segments on small hand-made data."""

import datetime as dt
import math
import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from feedloom.functions import exact_sums
from feedloom.functions.exact_sums import exact_sum, merged, negated, sum_states, totals, without_empty
from feedloom.functions.sums import total
from feedloom.operators import registry, segments, states
from feedloom.operators.asof import as_of
from feedloom.operators.clustered import Between, files_for, rank_of, scan_clustered, write_clustered
from feedloom.operators.publish import drop_old_versions, read_periods
from feedloom.operators.states import StateTable, WithdrawnTwiceError, coarser, read_states, summary, update_states
from feedloom.scratch import materialize
from tests.conftest import rows

HUGE = 1.7976931348623157e308


def true_sum(values):
    if any(map(math.isnan, values)) or {math.inf, -math.inf} <= set(values):
        return math.nan
    endless = [v for v in values if math.isinf(v)]
    if endless:
        return endless[0]
    exact = sum(map(Fraction, values))
    try:
        return float(exact)
    except OverflowError:
        return math.inf if exact > 0 else -math.inf


def doubles(rng, kind):
    return {
        0: lambda: rng.uniform(-1, 1) * 10 ** rng.uniform(-6, 15),
        1: lambda: rng.uniform(-1, 1) * 2.0 ** rng.randint(-1073, 1023),
        2: lambda: rng.choice([5e-324, -5e-324, 1e-310, 2.2250738585072014e-308, 0.0, -0.0]),
        3: lambda: rng.choice([1e308, -1e308, HUGE, 1.0]),
        4: lambda: rng.choice([2.0**53, 1.0, 2.0**53 + 2, -1.0, 0.25, 2.0**-60, -1e16, 1e16]),
        5: lambda: rng.choice([-1, 1]) * 2.0 ** rng.randint(-1074, 1023),
        6: lambda: rng.choice([math.nan, math.inf, -math.inf, 1.0, 2.0, 3.0, 4.0]),
    }[kind]()


@pytest.mark.parametrize("partitions", [1, 5])
def test_sums_of_any_doubles_are_rounded_once(spark, partitions):
    rng = random.Random(partitions)
    groups = {g: [doubles(rng, g % 7) for _ in range(rng.randint(1, 12))] for g in range(210)}
    data = [(g, v) for g, values in groups.items() for v in values] + [(1000, None), (1001, None), (1001, 2.5)]
    df = spark.createDataFrame(data, "g long, v double").repartition(partitions)
    found = {r.g: (r.t, r.n) for r in exact_sum(df, ["g"], "v", "t", "n").collect()}
    assert found.pop(1000) == (None, 0) and found.pop(1001) == (2.5, 1)
    for g, values in groups.items():
        assert repr(found[g]) == repr((true_sum(values) + 0.0, len(values))), values


def test_sum_of_nothing(spark):
    none = spark.createDataFrame([], "g long, v double")
    assert exact_sum(none, ["g"], "v", "t").collect() == []
    assert exact_sum(none, [], "v", "t").collect()[0].t is None


def test_withdrawn_values_leave_nothing(spark):
    """However large they were, as a plain running sum could not do."""
    kept = spark.createDataFrame([("a", 0.1), ("a", 0.2)], "g string, v double")
    gone = spark.createDataFrame([("a", 1e300), ("a", math.nan), ("b", -1.5), ("b", None)], "g string, v double")
    states = sum_states(kept.unionByName(gone), ["g"], "v").unionByName(negated(sum_states(gone, ["g"], "v")))
    left = without_empty(merged(states, ["g"]))
    assert rows(totals(left, ["g"], "t")) == [("a", 0.1 + 0.2)]


def test_totals_with_a_scale_do_not_overflow(spark):
    df = spark.createDataFrame([(5e12,), (5e12,), (4e18,), (-4e18,), (0.1,), (0.2,), (-7.25,)], "v double")
    assert df.agg(total(F.col("v"), 6)).first()[0] == 9999999999993.05
    many = spark.range(5000).select(F.lit(4e18).alias("v"))
    assert many.agg(total(F.col("v"), 6)).first()[0] == 2e22
    assert df.filter("v > 1e300").agg(total(F.col("v"), 6)).first()[0] is None


SALES = StateTable("sales", ("day", "shop"), "amount", period="year(day)", extremes=True)


def sales(spark, *data):
    return spark.createDataFrame([(dt.date.fromisoformat(d), s, a) for d, s, a in data], "day date, shop string, amount double")


def test_states_equal_a_recompute_without_reading_old_detail(spark, tmp_path):
    root = str(tmp_path)
    first = sales(spark, ("2023-05-01", "a", 1.5), ("2023-05-01", "a", 9.0), ("2024-05-01", "a", 2.0), ("2024-05-01", None, None))
    assert update_states(spark, root, SALES, added=first) == ["2023", "2024"]
    late = sales(spark, ("2024-05-01", "a", 0.1), ("2024-06-01", "b", -3.0))
    gone = sales(spark, ("2024-05-01", "a", 2.0))
    files = {p for p in read_periods(spark, root, "sales", ["2023"])[1].inputFiles()}
    assert update_states(spark, root, SALES, added=late, withdrawn=gone) == ["2024"]
    assert {p for p in read_periods(spark, root, "sales", ["2023"])[1].inputFiles()} == files
    day = dt.date
    assert rows(summary(spark, root, SALES)) == [
        (day(2023, 5, 1), "a", 10.5, 2, 5.25, 1.5, 9.0),
        (day(2024, 5, 1), None, None, 0, None, None, None),
        (day(2024, 5, 1), "a", 0.1, 1, 0.1, 0.1, 0.1),
        (day(2024, 6, 1), "b", -3.0, 1, -3.0, -3.0, -3.0),
    ]
    by_year = coarser(read_states(spark, root, SALES), {"year": F.year("day")})
    assert rows(totals(by_year, ["year"], "t", "n")) == [(2023, 10.5, 2), (2024, -2.9, 2)]
    assert rows(summary(spark, root, SALES, periods=["2023"]), "total") == [(10.5,)]
    # A whole year withdrawn is a period less.
    assert update_states(spark, root, SALES, withdrawn=sales(spark, ("2023-05-01", "a", 1.5), ("2023-05-01", "a", 9.0))) == ["2023"]
    assert rows(summary(spark, root, SALES).select("day").distinct()) == [(day(2024, 5, 1),), (day(2024, 6, 1),)]
    with pytest.raises(WithdrawnTwiceError):
        update_states(spark, root, SALES, withdrawn=gone)
    assert update_states(spark, root, SALES) == []


def prices(spark, *data):
    return spark.createDataFrame([(s, d and dt.date.fromisoformat(d), i) for s, d, i in data], "s string, d date, i int")


def test_as_of_join(spark):
    left = prices(spark, ("a", "2024-01-01", 1), ("a", "2024-01-31", 2), ("a", "2024-05-01", 3), ("a", "2026-01-01", 4), ("b", "2024-01-01", 5), (None, "2024-03-01", 6), ("a", None, 7), ("c", "2024-03-01", 8))
    right = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 10, "x"), ("a", dt.date(2024, 1, 1), 9, "y"), ("a", dt.date(2024, 2, 5), None, "z"), ("b", dt.date(2024, 1, 2), 1, "w"), (None, dt.date(2024, 1, 1), 5, "n"), ("c", None, 5, "n"), ("c", dt.date(2023, 3, 1), 6, "o")],
        "s string, t date, v int, i string",
    )
    want = {1: (10, dt.date(2024, 1, 1)), 2: (10, dt.date(2024, 1, 1)), 3: (None, dt.date(2024, 2, 5)), 4: (None, dt.date(2024, 2, 5)), 8: (6, dt.date(2023, 3, 1))}
    for unit in ("day", "month", "year"):
        found = as_of(left, right.select("s", "t", "v"), ["s"], "d", "t", ["v"], unit=unit, matched="at")
        assert found.columns == ["s", "d", "i", "v", "at"]
        assert {r.i: (r.v, r["at"]) for r in found.collect()} == {i: want.get(i, (None, None)) for i in range(1, 9)}
    fresh = as_of(left, right.select("s", "t", "v"), ["s"], "d", "t", ["v"], matched="at", within=F.expr("INTERVAL 90 DAYS"))
    assert {r.i for r in fresh.collect() if r["at"]} == {1, 2, 3}


def test_as_of_join_splits_a_hot_series(spark):
    """One series, 48 months: its rows are shuffled by range, and only one row a range is ordered by series alone."""
    days = spark.range(20_000).select(F.lit("hot").alias("s"), F.expr("date_add(DATE'2020-01-01', cast(id % 1400 as int))").alias("d"), "id")
    known = days.filter("id % 7 = 0").select("s", "d", F.col("id").alias("v"))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = as_of(days, known, ["s"], "d", "d", ["v"], unit="month")
        assert len(found.groupBy(F.spark_partition_id()).agg(F.sum("v")).collect()) >= 6
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
        # The window over a whole series has nothing but an aggregate by series and range below it.
        by_series = re.search(r"Window [^\n]*\[_key0#\d+\], \[_range#\d+[^\]]*\]\n[^\n]*?(\w+) \[_key0#\d+, _range#\d+\]", plan)
        assert by_series and by_series[1] == "Aggregate"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    last = found.agg(F.count_if(F.col("v").isNull()), F.max("v")).first()
    assert tuple(last) == (0, 19999 // 7 * 7)


@pytest.mark.parametrize("order", [("buckeroo", "plumless", "x"), ("plumless", "buckeroo", "x"), ("x", "plumless", "buckeroo")])
def test_colliding_names_get_two_keys_in_any_order(spark, tmp_path, order):
    """These two names have one CRC-32. Whichever comes first, each ends up with the same key of its own."""
    root, moved = str(tmp_path), []
    for name in order:
        batch = spark.createDataFrame([(name,), (None,), (order[0],)], "n string")
        moved += registry.register(spark, root, batch).collect()
    found = {r["name"]: r["key"] for r in registry.registered(spark, root).collect()}
    assert found["buckeroo"] == 1306201125 and found["plumless"] > 2**32 and len(set(found.values())) == 3
    displaced = order.index("plumless") < order.index("buckeroo")
    assert [tuple(r) for r in moved] == ([("plumless", 1306201125, found["plumless"])] if displaced else [])
    assert registry.register(spark, root, spark.createDataFrame([("x",)], "n string")).count() == 0


def test_segments_cost_what_a_batch_finds(spark, tmp_path):
    root = str(tmp_path)
    bad = [spark.createDataFrame([(i, "r")], "i int, error_reason string") for i in range(4)]
    for n in range(4):
        segments.write_batch(spark, root, str(n), bad[n].unionByName(bad[0]))
    names = segments.segment_names(spark, root)
    assert len(names) == 4

    def said():
        return rows(segments.history(spark, root), "i", "first_batch", "last_batch")

    assert said() == [(0, "0", "3"), (1, "1", "1"), (2, "2", "2"), (3, "3", "3")]
    # Batch 1 runs again and finds one row less: one tombstone, and the other segments stay as they are.
    segments.write_batch(spark, root, "1", bad[0])
    assert set(names) < set(segments.segment_names(spark, root)) and len(segments.segment_names(spark, root)) == 5
    after = [(0, "0", "3"), (2, "2", "2"), (3, "3", "3")]
    assert said() == after
    assert segments.merge_segments(spark, root) == 5 and segments.merge_segments(spark, root) == 0
    assert said() == after and len(segments.segment_names(spark, root)) == 1
    assert len(drop_old_versions(spark, root)) == 5 and said() == after
    # A large old segment is left alone by a small new one.
    segments.write_batch(spark, root, "9", bad[1])
    assert segments.merge_segments(spark, root, ratio=1, least=1) == 0
    segments.write_batch(spark, root, "9", bad[1].limit(0))
    assert said() == after


def test_clustered_table_reads_few_files(spark, tmp_path):
    """A quarter of some products: the folder of its year, and in it the files whose ranges meet both conditions."""
    root, columns = str(tmp_path), ["date", "product"]
    df = spark.range(24_000).select(
        F.expr("date_add(DATE'2022-01-01', cast(id * 7919 % 1096 as int))").alias("date"), F.concat(F.lit("p"), F.col("id") * 31 % 97).alias("product"), "id"
    )
    odd = spark.createDataFrame([(None, "p1", -1), (dt.date(2023, 5, 1), None, -2)], "date date, product string, id long")
    df = df.unionByName(odd)
    write_clustered(df, root, columns, F.year("date"), rows_per_file=500)
    wanted = {"date": Between(dt.date(2023, 4, 1), dt.date(2023, 6, 30)), "product": Between("p2", "p3")}
    everything = spark.read.parquet(f"{root}/rows").inputFiles()
    chosen = files_for(spark, root, columns, wanted)
    assert len(everything) >= 48 and 0 < len(chosen) <= 8 and all("period=2023" in f for f in chosen)
    found = scan_clustered(spark, root, columns, wanted)
    assert {f.rsplit("/", 1)[1] for f in found.inputFiles()} == {f.rsplit("/", 1)[1] for f in chosen}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2023-04-01)" in plan
    assert rows(found) == rows(df.filter("date BETWEEN '2023-04-01' AND '2023-06-30' AND product BETWEEN 'p2' AND 'p3'"))
    assert scan_clustered(spark, root, columns, {"date": Between(dt.date(2030, 1, 1))}).count() == 0
    assert spark.read.parquet(f"{root}/rows").count() == 24_002


def test_small_files_of_a_clustered_table_need_no_task_each(spark, tmp_path):
    """1,000 files of 40 rows at most, written by as many tasks as there are cores: each task's files have numbers of their own."""
    df = spark.range(40_000).select(F.expr("date_add(DATE'2022-01-01', cast(id * 7919 % 1096 as int))").alias("date"), "id")
    write_clustered(df, str(tmp_path), ["date", "id"], F.year("date"), rows_per_file=40)
    stats = spark.read.parquet(f"{tmp_path}/_files").collect()
    assert len(stats) >= 1000 and max(s.n_rows for s in stats) <= 40 and sum(s.n_rows for s in stats) == 40_000
    tasks = {re.search(r"part-(\d+)-", s.file)[1] for s in stats}
    assert len(tasks) <= spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 254, 255])
def test_rank_among_cuts_is_their_number_up_to_the_value(spark, n):
    cuts = [3 * i for i in range(n)]
    df = spark.createDataFrame([(v,) for v in (None, *range(-2, 3 * n + 3))], "v long")
    found = df.select("v", rank_of(F.col("v"), cuts, df.schema["v"].dataType).alias("rank")).collect()
    assert all(r.rank == (0 if r.v is None else sum(c <= r.v for c in cuts)) for r in found)


def test_an_update_writes_each_table_of_states_once(spark, tmp_path, monkeypatch):
    """The new states go straight to the folders that are published; those of an update that is refused are removed."""
    stored = []
    monkeypatch.setattr(states, "materialize", lambda df, path: stored.append(path.rsplit("/", 1)[1]) or materialize(df, path))
    root, table = str(tmp_path), StateTable("t", ("day", "g"), "v", period="year(day)", extremes=True)
    day = dt.date(2023, 5, 1)
    one = spark.createDataFrame([(day, "a", 1.5), (day, "a", 1e300), (day, "b", -2.0)], "day date, g string, v double")
    two = spark.createDataFrame([(day, "a", 1e300), (day, "b", -2.0)], "day date, g string, v double")
    assert update_states(spark, root, table, added=one) == ["2023"]
    assert update_states(spark, root, table, added=two.filter("g = 'b'"), withdrawn=two) == ["2023"]
    assert stored == ["t-change", "t-change"]
    found = summary(spark, root, table).select("g", "n_values", "total", "least", "greatest")
    assert rows(found) == [("a", 1, 1.5, 1.5, 1.5), ("b", 1, -2.0, -2.0, -2.0)]
    folders = sorted(p.name for name in ("t", "t_values") for p in (tmp_path / name).iterdir())
    with pytest.raises(WithdrawnTwiceError):
        update_states(spark, root, table, withdrawn=one)
    assert folders == sorted(p.name for name in ("t", "t_values") for p in (tmp_path / name).iterdir()) and len(folders) == 4


def test_totals_carry_only_through_the_bins_in_use(spark):
    rng = random.Random(6)
    powers = [-1074, -1050, -1022, -600, -3, 0, 40, 600, 960]
    groups = {g: [rng.choice([-1, 1]) * rng.randint(1, 2**20) * 2.0 ** max(-1074, p + rng.randint(-30, 30)) for _ in range(8)] for g, p in enumerate(powers)}
    groups |= {100: [2.0**60, -(2.0**60), 2.0**-1074], 101: [0.0, -0.0], 102: [2.0**32 * 2.0**-1074, 2.0**-1074], 103: [-(2.0**20)] * 9}
    df = spark.createDataFrame([(g, v) for g, values in groups.items() for v in values], "g long, v double")
    found = {r.g: r.t for r in exact_sum(df, ["g"], "v", "t").collect()}
    assert {g: repr(t) for g, t in found.items()} == {g: repr(true_sum(values) + 0.0) for g, values in groups.items()}
    steps = {name: text for step in exact_sums._carry_steps() for name, text in step.items()}
    lengths = totals(sum_states(df, ["g"], "v"), ["g"], "t")._jdf.queryExecution().optimizedPlan().toString()
    assert steps["_spread"].startswith("transform(sequence(_low, _high") and "sequence(0, 69" not in lengths
