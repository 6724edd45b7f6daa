"""A persistent registry of member names and their keys, in which two names never share one.

A name's key is a checksum of it, as in ``functions.keys``. Where several names have the same checksum, the first of them in byte order keeps it
and the others get a second, longer hash above the checksums' range. So keys are a function of the set of names, whatever the
order in which they arrived. A name that arrives later and sorts before the present holder of its checksum takes it over; ``register``
returns the holder's old and new key, for whoever stored it.

The table is cut into buckets by the checksum, so that names that could collide are in one bucket. New names are told by an anti join with the
buckets they fall into, and only buckets that gain a name are rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.operators.publish import PERIOD, current_table, read_periods, replace_periods
from feedloom.scratch import drop_path, materialize, scratch_path

NAME, KEY = "name", "key"
MEMBERS = "members"


def first_hash(name: Column, bits: int) -> Column:
    return F.crc32(name.cast("binary")) % (1 << bits)


def second_hash(name: Column, bits: int) -> Column:
    """60 bits of MD5 above the range of the first hash."""
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long") + (1 << bits)


def with_keys(names: DataFrame, bits: int = 32) -> DataFrame:
    """Distinct ``name`` with its ``key``. Only names of one checksum meet, and of those there are few."""
    first = first_hash(F.col(NAME), bits)
    holder = Window.partitionBy(first).orderBy(F.col(NAME).cast("binary"))
    key = F.when(F.row_number().over(holder) == 1, first).otherwise(second_hash(F.col(NAME), bits))
    return names.withColumn(KEY, key)


def register(spark: SparkSession, root: str, names: DataFrame, bits: int = 32, buckets: int = 64) -> DataFrame:
    """Add the names (one column) that are not there yet; NULL has no key. Returns name, old key and new key of holders displaced.

    ``bits`` and ``buckets`` belong to the registry: use the same ones every time.
    """
    given = names.select(F.col(names.columns[0]).cast("string").alias(NAME)).dropna().distinct()
    bucket = (first_hash(F.col(NAME), bits) % buckets).cast("string")
    schema = f"{NAME} string, old_key long, new_key long"
    work = scratch_path(spark, "registry")
    try:
        given = materialize(given.withColumn(PERIOD, bucket), f"{work}/given")
        asked = sorted(r[0] for r in given.select(PERIOD).distinct().collect())
        version, known = read_periods(spark, root, MEMBERS, asked)
        new = given if known is None else given.join(known.select(NAME), NAME, "left_anti").select(*given.columns)
        touched = sorted(r[0] for r in new.select(PERIOD).distinct().collect())
        if not touched:
            return spark.createDataFrame([], schema)
        held = None if known is None else known.filter(F.col(PERIOD).isin(touched))
        everyone = new if held is None else new.unionByName(held.select(*new.columns))
        keyed = materialize(with_keys(everyone, bits), f"{work}/keyed")
        clashes = keyed.groupBy(KEY).count().filter("count > 1").limit(1).collect()
        if clashes:
            raise ValueError(f"two names share both hashes: {clashes[0][KEY]}")
        moved = spark.createDataFrame([], schema)
        if held is not None:
            old = held.select(NAME, F.col(KEY).alias("old_key"))
            moved = keyed.join(old, NAME).filter(F.col(KEY) != F.col("old_key")).select(NAME, "old_key", F.col(KEY).alias("new_key"))
            moved = materialize(moved, scratch_path(spark, "registry-moved"))
        replace_periods(spark, root, {MEMBERS: (keyed, touched)}, version)
        return moved
    finally:
        drop_path(spark, work)


def registered(spark: SparkSession, root: str) -> DataFrame | None:
    members = current_table(spark, root, MEMBERS)
    return None if members is None else members.select(NAME, KEY)
