"""A history of bad rows that costs what a batch finds: segments of events, merged now and then.

Each batch appends one segment: rows it *found*, and rows that are *gone* (repaired, replaced or withdrawn), known by a key over
their content. Nothing older is rewritten. What holds now is read by folding events in the order of their segments: per row and batch the last
event counts, and a row is in the history while some batch's last word on it is that it was found.

A batch that runs again replaces what it said: rows that only its earlier run found get a tombstone, for which that batch's own segments are
read and no others. ``merge_segments`` folds small segments into one, so that their number stays logarithmic in the rows; the pointer forgets
the old ones and ``drop_old_versions`` removes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.operators.publish import PERIOD, changed_since, current_table, read_periods, replace_periods
from feedloom.scratch import drop_path, materialize, scratch_path

SEGMENTS = "segments"
KEY, BATCH, FOUND, AT, ORDER = "_key", "_batch", "_found", "_at", "_order"
EVENT = [BATCH, FOUND, AT, ORDER]


def reject_key(rows: DataFrame) -> Column:
    """What a bad row is known by: all of its columns."""
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)]), {"ignoreNullFields": "false"})
    return F.sha2(content, 256)


def record_events(spark: SparkSession, root: str, batch: str, found: DataFrame, gone: DataFrame | None = None) -> None:
    """Append one segment. Rows carry their ``_key``; an empty segment is not written."""
    work = scratch_path(spark, "segment")
    try:
        version, _ = read_periods(spark, root, SEGMENTS, [])
        events = found.withColumn(FOUND, F.lit(True))
        if gone is not None:
            events = events.unionByName(gone.withColumn(FOUND, F.lit(False)))
        order = F.lit(version + 1).cast("long")
        events = events.withColumns({BATCH: F.lit(batch), AT: F.current_timestamp(), ORDER: order})
        events = materialize(events, f"{work}/events")
        if not events.limit(1).count():
            return
        name = f"{version + 1:012d}-{uuid.uuid4().hex[:12]}"
        replace_periods(spark, root, {SEGMENTS: (events.withColumn(PERIOD, F.lit(name)), [name])}, version)
    finally:
        drop_path(spark, work)


def write_batch(spark: SparkSession, root: str, batch: str, bad: DataFrame) -> None:
    """What a batch found, all of it. If it ran before, what it found then and not now gets a tombstone."""
    found = bad.distinct()
    found = found.withColumn(KEY, reject_key(found))
    before = batch_words(spark, root, batch)
    if before is None:
        return record_events(spark, root, batch, found)
    work = scratch_path(spark, "rerun")
    try:
        found = materialize(found, f"{work}/found")
        said = materialize(before, f"{work}/said")
        new = found.join(said.select(KEY), KEY, "left_anti").select(*found.columns)
        gone = said.join(found.select(KEY), KEY, "left_anti").select(*found.columns)
        record_events(spark, root, batch, new, gone)
    finally:
        drop_path(spark, work)


def segment_names(spark: SparkSession, root: str) -> list[str]:
    return changed_since(spark, root, SEGMENTS, -1)[1]


def batch_words(spark: SparkSession, root: str, batch: str) -> DataFrame | None:
    """The rows that a batch's last word says were found. The filter on the batch skips other batches' row groups."""
    events = current_table(spark, root, SEGMENTS)
    return None if events is None else last_words(events.filter(F.col(BATCH) == batch)).drop(*EVENT)


def last_words(events: DataFrame) -> DataFrame:
    """Per row and batch the last event, if it says found. Events of one row are few: one for each batch that changed it."""
    window = Window.partitionBy(KEY, BATCH).orderBy(F.desc(ORDER), F.asc(FOUND))
    return events.withColumn("_nth", F.row_number().over(window)).filter((F.col("_nth") == 1) & F.col(FOUND)).drop("_nth")


def history(spark: SparkSession, root: str) -> DataFrame | None:
    """Each bad row once, with the first and the last batch that found it and when it was first found."""
    events = current_table(spark, root, SEGMENTS)
    if events is None:
        return None
    content = [c for c in events.columns if c not in (KEY, *EVENT)]
    seen = F.struct(ORDER, AT, BATCH)
    # The row itself is the same in every event; any of them will do.
    rows = last_words(events).groupBy(KEY).agg(
        *[F.any_value(F.col(f"`{c}`")).alias(c) for c in content], F.min(seen).alias("_first"), F.max(seen).alias("_last")
    )
    return rows.select(
        *[F.col(f"`{c}`") for c in content],
        F.col(f"_first.{AT}").alias("quarantined_at"),
        F.col(f"_first.{BATCH}").alias("first_batch"),
        F.col(f"_last.{BATCH}").alias("last_batch"),
    )


def still_bad(spark: SparkSession, root: str) -> DataFrame | None:
    """The rows whose last event of all says found: what a run over changes, which records both, leaves open."""
    events = current_table(spark, root, SEGMENTS)
    if events is None:
        return None
    window = Window.partitionBy(KEY).orderBy(F.desc(ORDER), F.asc(FOUND))
    last = events.withColumn("_nth", F.row_number().over(window)).filter((F.col("_nth") == 1) & F.col(FOUND))
    return last.drop("_nth", KEY, *EVENT)


def merge_segments(spark: SparkSession, root: str, ratio: int = 4, least: int = 1000) -> int:
    """Fold the newest segments into one while each older one is less than ``ratio`` times what is folded; how many were folded.

    Sizes are event counts, one row per segment on the driver. A segment below ``least`` rows is always folded. As segments grow by that
    ratio, their number is logarithmic and a row is rewritten as often.
    """
    version, events = read_periods(spark, root, SEGMENTS, segment_names(spark, root))
    if events is None:
        return 0
    sizes = {r[PERIOD]: r["count"] for r in events.groupBy(PERIOD).count().collect()}
    chosen: list[str] = []
    rows = 0
    for name in sorted(sizes, reverse=True):
        if chosen and sizes[name] >= max(ratio * rows, least):
            break
        chosen.append(name)
        rows += sizes[name]
    if len(chosen) < 2:
        return 0
    work = scratch_path(spark, "merge-segments")
    try:
        # Of a row and batch only the last event can still matter; a tombstone is needed while older segments may hold the row.
        window = Window.partitionBy(KEY, BATCH).orderBy(F.desc(ORDER), F.asc(FOUND))
        folded = events.filter(F.col(PERIOD).isin(chosen)).drop(PERIOD)
        folded = folded.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")
        if len(chosen) == len(sizes):
            later = Window.partitionBy(KEY)
            folded = folded.withColumn("_any", F.max(FOUND).over(later)).filter("_any").drop("_any")
        folded = materialize(folded, f"{work}/folded")
        name = f"{sorted(chosen)[-1][:12]}-{uuid.uuid4().hex[:12]}"
        replace_periods(spark, root, {SEGMENTS: (folded.withColumn(PERIOD, F.lit(name)), [*chosen, name])}, version)
        return len(chosen)
    finally:
        drop_path(spark, work)
