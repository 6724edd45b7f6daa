from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from feedloom.operators.dedup import keep_latest
from feedloom.operators.survivors import SurvivorStore, key_digest
from feedloom.scratch import scratch_path

SCHEMA = "area string, product string, day int, value double"


def rows_of(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "a", "b", None, ""]), rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None]), float(rng.randint(0, 5))) for _ in range(n)]


def new_store(spark, buckets=4):
    schema = spark.createDataFrame([], SCHEMA).schema
    return SurvivorStore(spark, scratch_path(spark, "test-survivors"), schema, ["area", "product"], "day", buckets)


def frame(spark, files: dict[str, list[tuple]]):
    return spark.createDataFrame([(*r, f) for f, rows in files.items() for r in rows], f"{SCHEMA}, file string")


def found(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def at_once(spark, files):
    return found(keep_latest(frame(spark, files).drop("file"), ["area", "product"], "day"))


def test_survivors_equal_dedup_at_once(spark):
    """Late, repeated, replaced and withdrawn files; then the store opened anew, and merged into more buckets."""
    store = new_store(spark)
    here = {f"f{i}": rows_of(i, 40) for i in range(3)}
    store.add(frame(spark, here), F.col("file"), 1)
    assert found(store.survivors()) == at_once(spark, here)
    late = {"f3": rows_of(3, 60), "f4": []}
    for _ in range(2):
        store.add(frame(spark, late), F.col("file"), 2)
    here |= late
    assert found(store.survivors()) == at_once(spark, here)
    here["f1"] = rows_of(11, 5)
    for _ in range(2):
        store.withdraw(spark.createDataFrame([("f1",), ("f0",), ("unknown",)], "file string"), 3)
        store.add(frame(spark, {"f1": here["f1"]}), F.col("file"), 3)
    del here["f0"]
    expected = at_once(spark, here)
    assert found(store.survivors()) == expected
    store.close()
    again = SurvivorStore(spark, store.path, store.schema, store.key, store.newest, buckets=7)
    assert again.buckets == 4 and found(again.survivors()) == expected
    merged = again.merged(scratch_path(spark, "test-merged"), 6)
    assert merged.buckets == 6 and found(merged.survivors()) == expected
    assert merged.events().count() < again.events().count() and not merged.events().filter("_gone").count()
    wanted = spark.createDataFrame([("a", "x"), (None, None), ("zz", "x")], "area string, product string")
    some = [r for r in again.survivors(wanted).collect()]
    assert sorted(map(str, map(tuple, some))) == [r for r in expected if r.startswith(("('a', 'x'", "(None, None"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_is_stored_is_not_shuffled(spark):
    """Rows of one hot key and many others in two turns: no exchange to read the survivors, one on the side of the keys asked for."""
    store = new_store(spark)
    hot = [("a", "x", i % 50, float(i)) for i in range(600)]
    store.add(frame(spark, {"f0": hot + rows_of(1, 300)}), F.col("file"), 1)
    store.add(frame(spark, {"f1": hot + rows_of(2, 300)}), F.col("file"), 2)
    assert store.events().filter("area = 'a' AND product = 'x'").count() == 2
    assert "Exchange" not in plan(store.survivors()) and "Bucketed: true" in plan(store.survivors())
    asked = spark.createDataFrame([("a", "x")], "area string, product string")
    text = plan(store.survivors(asked))
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    # Every exchange is below the side of the keys asked for, which the join has second.
    stored, wanted = text.index("FileScan"), [i for i in range(len(text)) if text.startswith("Exchange", i)]
    assert wanted and all(i > stored for i in wanted)


def test_nothing_stored(spark):
    store = new_store(spark)
    store.withdraw(spark.createDataFrame([("f0",)], "file string"), 1)
    store.add(frame(spark, {}), F.col("file"), 1)
    assert store.survivors().collect() == [] and store.merged(scratch_path(spark, "test-merged")).events().count() == 0


def test_keys_are_told_apart(spark):
    rows = [("a", None), (None, "a"), ("", "a"), ("a", ""), ("1:a", ""), ("-", None), (None, "-"), ("", "1:a"), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(key_digest(["a", "b"]).alias("k")).distinct().count() == len(rows)


def test_clashing_columns_and_lost_marks_are_refused(spark):
    schema = spark.createDataFrame([], "area string, day int, _turn int").schema
    with pytest.raises(ValueError, match="_turn"):
        SurvivorStore(spark, scratch_path(spark, "test-survivors"), schema, ["area"], "day")
    path = scratch_path(spark, "test-survivors")
    frame(spark, {"f0": rows_of(1, 3)}).write.parquet(path)
    with pytest.raises(ValueError, match="bucket count"):
        SurvivorStore(spark, path, spark.createDataFrame([], SCHEMA).schema, ["area"], "day")
