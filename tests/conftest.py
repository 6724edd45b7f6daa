from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    """Many tiny plans: compiling them and spreading them over partitions would be most of the time."""
    session = local_session(4, memory="4g")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture
def land(tmp_path):
    """Write one feed document per file into a bronze folder."""
    folder = tmp_path / "bronze"
    folder.mkdir()

    def write(name: str, records: list[dict] | str) -> str:
        text = records if isinstance(records, str) else json.dumps({"response": {"data": records}})
        (folder / name).write_text(text)
        return str(folder)

    write.folder = str(folder)
    return write


def price(period, value, product="U.S. No 2 Diesel", process="Retail"):
    return {"period": period, "value": value, "product-name": product, "process-name": process}


def stock(period, value, product="Distillate Fuel Oil", process="Ending Stocks", area="U.S."):
    return {**price(period, value, product, process), "area-name": area}


def movement(period, value, product="Distillate Fuel Oil", area="U.S.", description="Net Imports of Distillate"):
    return {
        "period": period,
        "value": value,
        "product-name": product,
        "area-name": area,
        "series-description": description,
    }


def rows(df, *columns):
    """Sorted tuples; NULL sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
