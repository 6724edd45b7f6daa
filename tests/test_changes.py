"""The job over changes: its outcome is the batch job's, and it touches no more than the years that changed."""

import json
import os
from dataclasses import replace
from pathlib import Path

import pytest

from feedloom.__main__ import main
from feedloom.operators import segments
from feedloom.operators.publish import current_table
from feedloom.operators.quality import FeedQualityError
from feedloom.plans.pipeline import Paths, prune, run, run_changed
from feedloom.plans.star import DIM_AREA, DIM_DATE, DIM_PRODUCT, FACT, StarOptions
from tests.conftest import movement, price, rows, stock

TABLES = (DIM_DATE, DIM_PRODUCT, DIM_AREA, FACT)


@pytest.fixture
def paths(tmp_path, land):
    land("prices_20240513.json", [price("2023-12-28", 2.9), price("2024-05-06", 3.1234), price("2022-05-13", "3.2"), price("2024-06-03", 9)])
    land("supply_20240513.json", [stock("2023-12-29", 50), stock("2024-05-10", 1e13), stock("2022-05-12", 0.1), stock("2024-05-17", -3)])
    land("movements_20240513.json", [movement("2024-05", -425.555), movement("2022-05", 1), movement("2024-04", 5, area="X")])
    return Paths.under(str(tmp_path))


def pointers(root):
    """The files that each period of each table is made of."""
    found = {}
    for pointer in sorted(Path(root).glob("_published/*.json"), key=lambda p: int(p.stem)):
        found |= {(t, p): v for t, parts in json.loads(pointer.read_text()).items() for p, v in parts.items()}
    return found


def agree(spark, paths, tmp_path, name):
    """Gold equals that of the batch job over the same files."""
    batch = replace(Paths.under(str(tmp_path / name)), bronze=paths.bronze)
    counts = run(spark, batch, "b", StarOptions(value_scale="exact"))
    for table in TABLES:
        got, want = current_table(spark, f"{paths.changes}/gold", table), spark.read.parquet(f"{batch.gold}/{table}")
        assert rows(got, *want.columns) == rows(want), table
    return counts


def test_changes_equal_batch_and_touch_one_year(spark, paths, land, tmp_path):
    counts = run_changed(spark, paths, "1")
    assert counts == agree(spark, paths, tmp_path, "b1")
    stores = [f"{paths.changes}/petroleum_prices", f"{paths.changes}/supply_estimates", f"{paths.changes}/gold", paths.serving]
    before = [pointers(s) for s in stores]
    # One new week: another price, a stock of its own, and 5e12 twice in that week.
    land("prices_20240520.json", [price("2024-05-20", 3.3)])
    land("supply_20240520.json", [stock("2024-05-24", 5e12), stock("2024-05-23", 5e12)])
    counts = run_changed(spark, paths, "2")
    for old, new in zip(before, [pointers(s) for s in stores]):
        changed = {key for key in new if new[key] != old.get(key)}
        assert {p for t, p in changed if t not in (DIM_PRODUCT, DIM_AREA, "applied")} <= {"2024", "all"}
        assert all(old[key] == new[key] for key in old if key[1] in ("2022", "2023"))
    served = rows(current_table(spark, paths.serving, FACT), "date", "total_stock_k_barrels")
    assert [str(r[0]) for r in served] == ["2022-05-13", "2023-12-28", "2024-05-06", "2024-05-20"]
    assert served[-1][1] == 1e13
    # A late week of two years, a replaced snapshot, and one withdrawn: a year, a product and an area go with it.
    land("supply_20240521.json", [stock("2024-01-05", 7), stock("2024-01-01", 2), stock("2022-05-12", 0.2)])
    land("prices_20240521.json", [price("2023-12-31", 4), price("2024-01-03", 5), price("2023-12-28", None)])
    land("supply_20240513.json", [stock("2023-12-29", 51), stock("2024-05-10", 1e13), stock("2024-05-17", 3)])
    os.remove(f"{land.folder}/movements_20240513.json")
    land("movements_20240520.json", [movement("2024-05", 3)])
    counts = run_changed(spark, paths, "3")
    assert counts == agree(spark, paths, tmp_path, "b3")
    # Nothing changed: nothing is written.
    before = [pointers(s) for s in stores]
    assert run_changed(spark, paths, "4") == counts
    assert [pointers(s) for s in stores] == before
    bad = segments.history(spark, f"{paths.quarantine}_events/supply_estimates")
    assert rows(bad, "volume_k_barrels", "first_batch", "last_batch") == [(-3.0, "1", "1")]
    assert segments.still_bad(spark, f"{paths.quarantine}_events/supply_estimates").count() == 0
    main(["prune", "--root", str(tmp_path)])
    assert prune(spark, paths) == []
    land("prices_20240527.json", [price("2024-05-24", 3.5)])
    run_changed(spark, paths, "5")
    assert current_table(spark, paths.serving, FACT).filter("date = '2024-05-24' AND price_usd_per_gal = 3.5").count() == 1


def test_a_run_that_dies_is_taken_up(spark, paths, land, tmp_path, monkeypatch):
    """Whatever was not carried on is carried on by the next run, and nothing is counted twice."""
    run_changed(spark, paths, "1")
    land("supply_20240520.json", [stock("2024-05-09", 4, "Distillate Fuel Oil, Low Sulfur"), stock("2022-05-10", 9, "Distillate Fuel Oil, Low Sulfur")])

    def die(*_):
        raise RuntimeError("died")

    for step in ("gold_changes", "serve_changes"):
        with monkeypatch.context() as patch:
            patch.setattr(f"feedloom.plans.changes.{step}", die)
            with pytest.raises(RuntimeError, match="died"):
                run_changed(spark, paths, "2")
    run_changed(spark, paths, "2")
    agree(spark, paths, tmp_path, "batch")
    served = rows(current_table(spark, paths.serving, FACT), "date", "total_stock_k_barrels")
    assert [r[1] for r in served] == [9.1, 50.0, 1e13 + 4]


def test_gate_stops_before_silver(spark, paths, land):
    run_changed(spark, paths, "1")
    before = pointers(f"{paths.changes}/gold")
    land("movements_20240513.json", [movement("2024-05", None)])
    with pytest.raises(FeedQualityError, match="no valid rows"):
        run_changed(spark, paths, "2")
    assert pointers(f"{paths.changes}/gold") == before
