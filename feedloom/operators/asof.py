"""As-of join per series: every left row with the latest right row of its series that is not after it.

Both sides are cut into ranges of time, and (series, range) is what is shuffled and sorted, so that a series with a third of all rows is
spread over its ranges instead of meeting in one task. What a range cannot see, the last right row before it, is found beforehand:
the right side is reduced to one row per series and range, in partial aggregates before the shuffle, and carried forward over these few
rows, whose number per series the calendar bounds. Each range then begins with the row carried into it. Nothing is joined: both sides and the carried rows
are put together and one running window reads the last right row so far.

Choose ``unit`` so that one series' rows of one unit fit a task; it changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANGE, _TIME, _SIDE, _SEEN, _ROW = "_range", "_time", "_side", "_seen", "_row"
CARRIED, RIGHT, LEFT = range(3)


def as_of(
    left: DataFrame,
    right: DataFrame,
    series: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    unit: str = "month",
    matched: str | None = None,
    within: Column | None = None,
) -> DataFrame:
    """``left`` with ``values`` of the latest row of ``right`` up to and including its own time.

    Of right rows of one series and time the one with the greatest values counts, in the order given. A NULL in a series column or a time
    matches nothing; such left rows stay, as do those before their series begins, with NULLs. ``matched`` names a column for the time of
    the row found. ``within`` is an interval: older rows than that do not count.
    """
    times = left.schema[left_time].dataType, right.schema[right_time].dataType
    wide = "timestamp" if any(t.typeName() != "date" for t in times) else "date"
    keys = [f"_key{i}" for i in range(len(series))]

    def placed(df: DataFrame, time: str) -> DataFrame:
        at = F.col(f"`{time}`").cast(wide)
        named = {k: F.col(f"`{c}`") for k, c in zip(keys, series)}
        return df.withColumns({**named, _TIME: at, _RANGE: F.date_trunc(unit, at)})

    known = placed(right, right_time).dropna(subset=[*keys, _TIME])
    seen = F.struct(F.col(_TIME), *[F.col(f"`{v}`") for v in values])
    known = known.select(*keys, _RANGE, _TIME, seen.alias(_SEEN))
    mine = placed(left, left_time)
    usable = mine.filter(_all_known([*keys, _TIME]))

    # The last right row of each range, and the ranges of left rows, which may have none of their own.
    lasts = known.groupBy(*keys, _RANGE).agg(F.max(_SEEN).alias(_SEEN))
    asked = usable.select(*keys, _RANGE).distinct().withColumn(_SEEN, F.lit(None).cast(known.schema[_SEEN].dataType))
    per_range = lasts.unionByName(asked).groupBy(*keys, _RANGE).agg(F.max(_SEEN).alias(_SEEN))
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_range.withColumn(_SEEN, F.last(_SEEN, ignorenulls=True).over(before)).filter(F.col(_SEEN).isNotNull())

    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    no_row = F.lit(None).cast(mine.select(row.alias("r")).schema["r"].dataType)
    no_seen = F.lit(None).cast(known.schema[_SEEN].dataType)
    parts = [
        carried.select(*keys, _RANGE, F.col(_RANGE).cast(wide).alias(_TIME), F.lit(CARRIED).alias(_SIDE), _SEEN, no_row.alias(_ROW)),
        known.select(*keys, _RANGE, _TIME, F.lit(RIGHT).alias(_SIDE), _SEEN, no_row.alias(_ROW)),
        usable.select(*keys, _RANGE, _TIME, F.lit(LEFT).alias(_SIDE), no_seen.alias(_SEEN), row.alias(_ROW)),
    ]
    upto = Window.partitionBy(*keys, _RANGE).orderBy(_TIME, _SIDE, _SEEN).rowsBetween(Window.unboundedPreceding, 0)
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    found = together.withColumn(_SEEN, F.last(_SEEN, ignorenulls=True).over(upto)).filter(F.col(_SIDE) == LEFT)
    if within is not None:
        fresh = F.col(f"{_SEEN}.{_TIME}") >= F.col(_TIME) - within
        found = found.withColumn(_SEEN, F.when(fresh, F.col(_SEEN)))
    rest = mine.filter(~_all_known([*keys, _TIME])).select(row.alias(_ROW), no_seen.alias(_SEEN))
    everything = found.select(_ROW, _SEEN).unionByName(rest)
    at = [F.col(f"{_SEEN}.{_TIME}").cast(times[1]).alias(matched)] if matched else []
    return everything.select(f"{_ROW}.*", *[F.col(f"{_SEEN}.`{v}`").alias(v) for v in values], *at)


def _all_known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known
