"""Keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.dedup import keep_one


class MissingKeyError(ValueError):
    """A staged row lacks part of its key."""


def upsert(
    target: DataFrame | None, staged: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """``target`` with each staged row inserted, or put in place of the row that has its key.

    Staged duplicates are first reduced to one row per key under ``order``. Rows of ``target`` that
    are not staged survive. The anti join reads only the staged key columns. It leaves the target's
    rows where they lie when those keys are small enough to broadcast, and otherwise shuffles both
    sides on the key once; keys are unique on both sides, so neither can be skewed. NULL keys match
    each other, so re-running stays harmless.
    """
    one = keep_one(staged, keys, order)
    if target is None:
        return one
    new = staged.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return target.join(new, same, "left_anti").unionByName(one)


def null_key(keys: Sequence[str]) -> Column:
    """True for a row that lacks part of its key, which no table with a primary key accepts."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
