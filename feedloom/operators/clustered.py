"""Tables clustered by several columns at once, with a table of what each file holds, so that a range scan reads few files.

Rows lie in folders by period and, within one, along a curve that interleaves the bits of every column's rank: each column's range is cut
at quantiles, and a file covers a small range of all of them instead of a small range of the first only. The ranks only place rows; they
never decide what is read. What is read is decided by the least and greatest value of each file, taken from the files themselves after they
are written: a scan names the files whose ranges meet its conditions, and Parquet's own statistics skip row groups within these.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.operators.publish import PERIOD

FILES = "_files"
#: Cuts of a column's range; a power of two.
CUTS = 256
BITS = CUTS.bit_length() - 1
#: Rows that the cuts of a column that has no numbers are taken from.
SAMPLE = 20_000
#: Rows that one task sorts and writes.
TASK_ROWS = 500_000


@dataclass(frozen=True)
class Between:
    """``low`` and ``high`` included; ``None`` is open."""

    low: object = None
    high: object = None

    def of(self, least: Column, greatest: Column) -> Column:
        """Whether values from ``least`` to ``greatest`` may be within."""
        meets = F.lit(True)
        if self.low is not None:
            meets = meets & (greatest >= F.lit(self.low))
        if self.high is not None:
            meets = meets & (least <= F.lit(self.high))
        return meets


def cuts_of(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, list], int]:
    """Of each column up to ``CUTS - 1`` values that cut it into parts of about equal size, and the number of rows; they come to the driver.

    From all rows, in one pass, where quantiles can be estimated, and from a bounded sample elsewhere: a bad cut makes a file's range
    wider and changes no result.
    """
    shares = [i / CUTS for i in range(1, CUTS)]
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, (T.NumericType, T.DateType, T.TimestampType))]
    n_rows, *quantiles = df.agg(F.count(F.lit(1)), *[F.percentile_approx(F.col(f"`{c}`"), shares, 10_000) for c in numbers]).first()
    found = dict(zip(numbers, quantiles))
    for c in columns:
        if c not in found:
            some = df.select(f"`{c}`").dropna().sample(min(1.0, SAMPLE / max(n_rows, 1)), seed=1).limit(2 * SAMPLE)
            values = sorted(r[0] for r in some.collect())
            found[c] = [values[int(s * len(values))] for s in shares] if values else []
    return {c: sorted(set(found[c] or [])) for c in columns}, n_rows


def rank_of(value: Column, cuts: Sequence, kind: T.DataType) -> Column:
    """How many of the sorted cuts are not above the value, found by halving: no row meets every cut. 0 for NULL."""
    if not cuts:
        return F.lit(0)
    edges = F.array(*[F.lit(v).cast(kind) for v in cuts])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(BITS))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(edges, at + step - 1) <= value, at + step).otherwise(at))


def with_place(df: DataFrame, columns: Sequence[str], cuts: Mapping[str, list]) -> DataFrame:
    """Add ``_place`` on the curve: the bits of the columns' ranks in turn, highest first. A rank is made once and used bit by bit."""
    ranks = {}
    for i, c in enumerate(columns):
        ranks[f"_rank{i}"] = rank_of(F.col(f"`{c}`"), cuts[c], df.schema[c].dataType)
    out = F.lit(0).cast("long")
    for bit in reversed(range(BITS)):
        for rank in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(F.col(rank), bit).bitwiseAND(F.lit(1)).cast("long"))
    return df.withColumns(ranks).withColumn("_place", out).drop(*ranks)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], period: Column, rows_per_file: int = 1_000_000) -> None:
    """Replace the table at ``path``; ``period`` names each row's folder. NULLs come first on the curve.

    A task writes many files one after the other, so that small files cost no more tasks or pieces of a shuffle than large ones.
    """
    spark = df.sparkSession
    cuts, n_rows = cuts_of(df, columns)
    placed = with_place(df, columns, cuts).withColumn(PERIOD, period.cast("string"))
    # Ranges of (period, place) hold about as many rows each, so that a large period has several files and small ones share a task.
    files = max(1, -(-n_rows // rows_per_file))
    tasks = min(files, max(spark.sparkContext.defaultParallelism, -(-n_rows // TASK_ROWS)))
    ranged = placed.repartitionByRange(tasks, PERIOD, "_place").sortWithinPartitions(PERIOD, "_place", *columns)
    bounded = ranged.drop("_place").write.option("maxRecordsPerFile", rows_per_file)
    bounded.mode("overwrite").partitionBy(PERIOD).parquet(f"{path}/rows")
    written = spark.read.schema(df.schema.add(PERIOD, T.StringType())).parquet(f"{path}/rows")
    ends = [f(F.col(f"`{c}`")).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in (("least", F.min), ("most", F.max))]
    stats = written.groupBy(PERIOD, F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"), *ends)
    stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/{FILES}")


def files_for(spark: SparkSession, path: str, columns: Sequence[str], wanted: Mapping[str, Between]) -> list[str]:
    """The files that may hold rows within all ranges; one short row a file is read for it."""
    stats = spark.read.parquet(f"{path}/{FILES}")
    for c, between in wanted.items():
        i = list(columns).index(c)
        stats = stats.filter(between.of(F.col(f"least_{i}"), F.col(f"most_{i}")))
    return [r[0] for r in stats.select("file").collect()]


def scan_clustered(spark: SparkSession, path: str, columns: Sequence[str], wanted: Mapping[str, Between]) -> DataFrame:
    """The rows whose columns are within the given ranges, read from the files that may hold them."""
    schema = spark.read.parquet(f"{path}/rows").schema
    files = files_for(spark, path, columns, wanted)
    rows = spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*files) if files else spark.createDataFrame([], schema)
    for c, between in wanted.items():
        rows = rows.filter(between.of(F.col(f"`{c}`"), F.col(f"`{c}`")))
    return rows.drop(PERIOD)
