"""Hashed surrogate keys. A key is a function of the name alone, so it can be computed anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def surrogate_key(name: Column, method: str = "crc32") -> Column:
    """``crc32`` is 0 .. 2**32-1 and NULL for NULL; ``xxhash64`` suits catalogs too big for 32 bits."""
    if method == "crc32":
        return F.crc32(name.cast("binary"))
    if method == "xxhash64":
        return F.when(name.isNotNull(), F.xxhash64(name))
    raise ValueError(f"surrogate key method must be 'crc32' or 'xxhash64', not {method!r}")


def colliding_keys(dim: DataFrame, key: str, name: str) -> DataFrame:
    """Keys shared by different names, with the first and last such name."""
    return (
        dim.groupBy(key)
        .agg(F.min(name).alias("first_name"), F.max(name).alias("last_name"))
        .filter("first_name <> last_name")
    )


def key_summary(dim: DataFrame, key: str, name: str) -> DataFrame:
    """How many names and keys a dimension has, and how many keys are shared; one row."""
    per_key = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(name).alias("_names"))
    return per_key.agg(
        F.coalesce(F.sum("_names"), F.lit(0)).alias("n_names"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("_names") > 1).alias("n_shared_keys"),
    )
