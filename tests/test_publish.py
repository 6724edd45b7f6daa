import json

import pytest
from pyspark.sql import functions as F

from feedloom.operators import publish as publishing
from feedloom.operators.merge import MissingKeyError
from feedloom.operators.publish import ServedTable, current_table, drop_old_versions, publish
from tests.conftest import rows

PLAIN = ServedTable("plain", ("k",))
CUT = ServedTable("cut", ("d", "k"), period="year(d)")
TABLES = (PLAIN, CUT)


def plain(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, v string")


def cut(spark, *triples):
    return spark.createDataFrame(list(triples), "d string, k int, v string").withColumn("d", F.col("d").cast("date"))


def values(spark, root, table):
    return [r[-1] for r in rows(current_table(spark, root, table))]


@pytest.mark.parametrize("period", ["d", "year(other)", "k % 7"])
def test_periods_are_bounded_by_the_calendar(period):
    with pytest.raises(ValueError, match="no year"):
        ServedTable("t", ("d", "k"), period=period)


def test_insert_update_keep(spark, tmp_path):
    root = str(tmp_path)
    assert current_table(spark, root, "plain") is None
    publish(spark, root, {"plain": plain(spark, (1, "a"), (2, "b"))}, TABLES)
    publish(spark, root, {"plain": plain(spark, (2, "B"), (3, "C"))}, TABLES)
    assert rows(current_table(spark, root, "plain")) == [(1, "a"), (2, "B"), (3, "C")]


def test_only_touched_periods_are_rewritten(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, {"cut": cut(spark, ("2023-05-01", 1, "a"), ("2024-05-01", 1, "b"))}, TABLES)
    staged = cut(spark, ("2024-05-01", 1, "B"), ("2025-01-01", 1, "C"))
    for _ in range(2):
        publish(spark, root, {"cut": staged}, TABLES)
        assert values(spark, root, "cut") == ["a", "B", "C"]
    assert current_table(spark, root, "cut").columns == ["d", "k", "v"]
    pointer = json.loads((tmp_path / "_published" / "3.json").read_text())
    assert {p: int(v.split("-")[0]) for p, v in pointer["cut"].items()} == {"2023": 1, "2024": 2, "2025": 2}
    second = [f for f in (tmp_path / "cut").iterdir() if f.name.startswith("version=2-")]
    assert [f.name for f in second[0].glob("period=*")] and not (second[0] / "period=2023").exists()


def test_unchanged_periods_keep_their_files(spark, tmp_path):
    root = str(tmp_path)
    first = cut(spark, ("2023-05-01", 1, "a"), ("2023-05-02", 2, "b"), ("2024-05-01", 1, "c"))
    publish(spark, root, {"cut": first}, TABLES)
    before = {r[0] for r in current_table(spark, root, "cut").select("_metadata.file_path").collect()}
    publish(spark, root, {"cut": first.withColumn("v", F.when(F.year("d") == 2024, F.lit("C")).otherwise(F.col("v")))}, TABLES)
    after = {r[0] for r in current_table(spark, root, "cut").select("_metadata.file_path").collect()}
    assert {p for p in before if "period=2023" in p} <= after
    assert not {p for p in before if "period=2024" in p} & after
    assert values(spark, root, "cut") == ["a", "b", "C"]


def test_tables_not_staged_stay(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, {"plain": plain(spark, (1, "a")), "cut": cut(spark, ("2024-01-01", 1, "x"))}, TABLES)
    publish(spark, root, {"plain": plain(spark, (1, "b"))}, TABLES)
    assert values(spark, root, "plain") == ["b"] and values(spark, root, "cut") == ["x"]


def test_failure_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    staged = {"plain": plain(spark, (1, "a")), "cut": cut(spark, ("2024-01-01", 1, "x"))}
    publish(spark, root, staged, TABLES)
    bad = {"plain": plain(spark, (1, "b")), "cut": cut(spark, (None, 1, "y"))}
    with pytest.raises(MissingKeyError, match="cut"):
        publish(spark, root, bad, TABLES)
    assert values(spark, root, "plain") == ["a"]

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(publishing, "_switch", crash)
        with pytest.raises(RuntimeError, match="lost"):
            publish(spark, root, {"plain": plain(spark, (1, "c"))}, TABLES)
    assert values(spark, root, "plain") == ["a"]
    publish(spark, root, {"plain": plain(spark, (1, "d"))}, TABLES)
    assert values(spark, root, "plain") == ["d"]


def test_loser_of_two_publishers_changes_nothing(spark, tmp_path, monkeypatch):
    """The loser writes its rows and tries to switch after the winner has."""
    root = str(tmp_path)
    publish(spark, root, {"plain": plain(spark, (1, "a"))}, TABLES)
    switch = publishing._switch

    def late(*arguments):
        with monkeypatch.context() as patched:
            patched.setattr(publishing, "_switch", switch)
            publish(spark, root, {"plain": plain(spark, (1, "winner"))}, TABLES)
        return switch(*arguments)

    with monkeypatch.context() as patched:
        patched.setattr(publishing, "_switch", late)
        with pytest.raises(RuntimeError, match="someone else"):
            publish(spark, root, {"plain": plain(spark, (1, "loser"))}, TABLES)
    assert values(spark, root, "plain") == ["winner"]


def test_pointer_is_never_overwritten(spark, tmp_path, monkeypatch):
    """Two publishers that both saw no newer pointer: the file system lets one create it."""
    root = str(tmp_path)
    publish(spark, root, {"plain": plain(spark, (1, "a"))}, TABLES)
    publish(spark, root, {"plain": plain(spark, (1, "b"))}, TABLES)
    monkeypatch.setattr(publishing, "_latest", lambda *_: (1, {}))
    monkeypatch.setattr(publishing, "_versions", lambda *_: [1])
    with pytest.raises(RuntimeError, match="someone else"):
        publishing._switch(spark, root, 1, {})
    monkeypatch.undo()
    assert values(spark, root, "plain") == ["b"]


def test_incomplete_pointer_is_passed_over(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, {"plain": plain(spark, (1, "a"))}, TABLES)
    (tmp_path / "_published" / "2.json").write_text('{"plain": {"al')
    assert values(spark, root, "plain") == ["a"]
    assert publish(spark, root, {"plain": plain(spark, (2, "b"))}, TABLES) == 3
    assert values(spark, root, "plain") == ["a", "b"]


def test_old_versions_are_dropped(spark, tmp_path):
    root = str(tmp_path)
    for v in "abc":
        publish(spark, root, {"plain": plain(spark, (1, v)), "cut": cut(spark, (f"202{ord(v) - 94}-01-01", 1, v))}, TABLES)
    assert drop_old_versions(spark, root)
    assert values(spark, root, "plain") == ["c"] and values(spark, root, "cut") == ["a", "b", "c"]
    assert len(list((tmp_path / "plain").iterdir())) == 1 and len(list((tmp_path / "cut").iterdir())) == 3
    publish(spark, root, {"plain": plain(spark, (2, "d"))}, TABLES)
    assert values(spark, root, "plain") == ["c", "d"]


def test_newest_wins_whatever_arrives_last(spark, tmp_path):
    root = str(tmp_path)
    table = ServedTable("t", ("k",), newest="s")
    first = spark.createDataFrame([(1, "2024-02", "new"), (None, "2024-01", "n")], "k int, s string, v string")
    late = spark.createDataFrame([(1, "2024-01", "old"), (2, "2024-01", "x")], "k int, s string, v string")
    for staged in (first, late, late):
        publish(spark, root, {"t": staged}, [table])
    assert values(spark, root, "t") == ["n", "new", "x"]


def test_nothing_staged_in_a_table(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, {"cut": cut(spark, ("2024-01-01", 1, "x"))}, TABLES)
    publish(spark, root, {"cut": cut(spark, ("2024-01-01", 1, "y")).limit(0)}, TABLES)
    assert values(spark, root, "cut") == ["x"]
