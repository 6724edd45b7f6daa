"""One defined survivor per key, and top-N rows.

``row_number() <= n`` is written as a window on purpose: Spark turns it into a group limit that runs
before the shuffle, so each map task sends at most ``n`` rows per key. A key that owns a third of the
table therefore reaches its reducer as a handful of rows per map task, not as a third of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW = "_row"
_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The first row of each key under ``order``, ties broken by every remaining column, descending.

    The order is total up to identical rows, so the survivor does not depend on file order, on
    partitioning, or on how often the plan is evaluated.
    """
    return _first_rows(df, keys, [*order, *_descending(df, keys)], 1)


def keep_latest(df: DataFrame, keys: Sequence[str], newest: str) -> DataFrame:
    """Per key, the row with the greatest ``newest``, ties broken as in ``keep_one``."""
    return _first_rows(df, keys, [F.col(newest).desc_nulls_last(), *_descending(df, [*keys, newest])], 1)


def latest_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows overall: every task keeps its own top ``n``, and only those meet."""
    return df.orderBy(*order).limit(n)


def latest_n_per_series(
    df: DataFrame, n: int, series: Sequence[str], order: Sequence[Column], salts: int = 64
) -> DataFrame:
    """The first ``n`` rows of each series under ``order``, which should be total.

    Beyond the session's group-limit threshold a hot series would be sorted whole in one task, so the series is
    first cut into salted slices; the overall top ``n`` is within the union of the slices' top ``n``. The second step then
    has at most ``salts * n`` rows of a series in one task.
    """
    if n > int(df.sparkSession.conf.get(_GROUP_LIMIT, "1000")):
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(salts))
        df = _first_rows(df.withColumn("_salt", salt), [*series, "_salt"], order, n).drop("_salt")
    return _first_rows(df, series, order, n)


def _descending(df: DataFrame, besides: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`").desc_nulls_last() for c in df.columns if c not in besides]


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    # A row that is nothing but its key has no order of its own; any constant will do.
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn(_ROW, F.row_number().over(window)).filter(F.col(_ROW) <= n).drop(_ROW)
