"""Conformed dimensions: one row per distinct member found in any of several feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.calendar import date_attributes
from feedloom.functions.classify import NameClass, classify
from feedloom.functions.keys import colliding_keys, surrogate_key


class KeyCollisionError(ValueError):
    """Two names hash to one surrogate key."""


def conform(name: str, *sources: tuple[DataFrame, str]) -> DataFrame:
    """Distinct values of differently named columns under one name.

    Each scan reads its one column, and the distinct runs inside each task before the shuffle, so
    repeated values never travel.
    """
    columns = [df.select(F.col(f"`{column}`").alias(name)) for df, column in sources]
    return reduce(DataFrame.unionByName, columns).distinct()


def date_dimension(*sources: tuple[DataFrame, str]) -> DataFrame:
    return conform("date", *sources).withColumns(date_attributes(F.col("date")))


def named_dimension(
    prefix: str,
    attribute: str,
    classes: Sequence[NameClass],
    otherwise: str,
    *sources: tuple[DataFrame, str],
    key_method: str = "crc32",
) -> DataFrame:
    """``<prefix>_name``, its surrogate ``<prefix>_id``, and its class under ``attribute``."""
    name = F.col(f"{prefix}_name")
    return conform(f"{prefix}_name", *sources).withColumns(
        {
            f"{prefix}_id": surrogate_key(name, key_method),
            attribute: classify(name, list(classes), otherwise),
        }
    )


def require_unique_keys(dim: DataFrame, key: str, name: str) -> None:
    """Stop a load that would silently drop a member. Brings at most five rows to the driver."""
    clashes = colliding_keys(dim, key, name).take(5)
    if clashes:
        shown = "; ".join(f"{c[key]}: {c.first_name!r} / {c.last_name!r}" for c in clashes)
        raise KeyCollisionError(f"names share a surrogate key ({shown}); use key_method='xxhash64'")
