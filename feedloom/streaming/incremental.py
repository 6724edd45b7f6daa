"""Clean a feed from new, replaced and withdrawn snapshots only.

The batch job reads every snapshot on every run. Here a table of processed files says which path was read at which modification
time and length, and which periods its rows went to. Each run compares it with a listing of the source:

* a file that is not in the table is new, however old its modification time;
* a file whose time or length differs has been replaced: its earlier rows are withdrawn before its new ones are added;
* a file that is in the table but no longer in the source has been withdrawn, and its rows with it.

The store keeps the shaped rows of every present snapshot, cut by year, and only the years touched are rewritten. Dedup comes
when the store is read, as it does in the batch job, so the outcome equals the batch job's over the same files, in
whatever order they arrived. Rows and file table are published together, so a failed run is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedup import keep_latest
from feedloom.operators.publish import PERIOD, WHOLE, current_table, new_attempt, read_periods, replace_periods, write_periods
from feedloom.operators.quality import FeedQualityError, tag_errors
from feedloom.plans.clean import CleanCounts, store_feed
from feedloom.scratch import drop_path, materialize, scratch_path
from feedloom.sources.feeds import REJECT_ID, SNAPSHOT, FeedSpec, look_back, read_documents, shape, unnest

FILE = "_file"
FILES = "files"


def listing(spark: SparkSession, source: str) -> DataFrame:
    """(path, uri, modified, length) of every file under ``source``; ``uri`` is the path as a reader tells it. Contents are not read."""
    files = spark.read.format("binaryFile").load(source)
    return files.select("path", F.col("_metadata.file_path").alias("uri"), F.col("modificationTime").alias("modified"), "length")


def no_periods() -> Column:
    return F.array().cast("array<string>")


def merge_arrivals(
    spark: SparkSession,
    spec: FeedSpec,
    source: str,
    store: str,
    multi_line: bool = True,
    stamp: str | None = None,
    base: str | None = None,
) -> int:
    """Bring the store up to the snapshots now under ``source``; how many files were read.

    ``stamp`` and ``base`` are those of landed documents, as in ``read_documents``.

    What the driver holds is the list of new paths, which reading them needs anyway, and the periods touched.
    """
    work = scratch_path(spark, f"arrivals-{spec.name}")
    same = ["path", "modified", "length"]
    try:
        present = materialize(listing(spark, source), f"{work}/listing")
        version, files = read_periods(spark, store, FILES, [WHOLE])
        known = present.withColumn("periods", no_periods()).limit(0) if files is None else files.drop(PERIOD)
        paths = [r["path"] for r in present.join(known, same, "left_anti").select("path").toLocalIterator()]
        gone = materialize(known.join(present, same, "left_anti"), f"{work}/gone")
        touched = {r[0] for r in gone.select(F.explode("periods")).distinct().collect()}
        if not paths and not gone.limit(1).count():
            return 0
        kept = known.join(gone.select("path"), "path", "left_anti")
        attempt = new_attempt(version)
        rows = None
        if paths:
            # Written once, where they will be published from; a failed run leaves folders that no pointer names.
            shaped = shaped_with_file(spark, spec, paths, multi_line, stamp, base)
            rows = write_periods(store, spec.name, shaped.hint("rebalance", PERIOD), attempt)
            per_file = rows.groupBy(FILE).agg(F.collect_set(PERIOD).alias("periods"))
            new = present.join(known, same, "left_anti").join(per_file, F.col("uri") == F.col(FILE), "left")
            new = new.select("path", "uri", "modified", "length", F.coalesce("periods", no_periods()).alias("periods"))
            kept = kept.unionByName(new)
            touched |= {r[0] for r in rows.select(PERIOD).distinct().collect()}
        files = write_periods(store, FILES, kept.withColumn(PERIOD, F.lit(WHOLE)), attempt)
        changes = {FILES: (files, [WHOLE])}
        _, old = read_periods(spark, store, spec.name, sorted(touched))
        if old is not None:
            # Rows that stay lie together by period already, so they are added to those folders as they are.
            old = old.join(gone.select(F.col("uri").alias(FILE)), FILE, "left_anti")
            rows = write_periods(store, spec.name, old, attempt, more=rows is not None)
        if touched and rows is not None:
            changes[spec.name] = (rows, sorted(touched))
        replace_periods(spark, store, changes, version, attempt)
        return len(paths)
    finally:
        drop_path(spark, work)


def shaped_with_file(
    spark: SparkSession, spec: FeedSpec, paths: list[str], multi_line: bool, stamp: str | None, base: str | None
) -> DataFrame:
    """The shaped rows of some files with ``_file`` and the year they belong to; rows without a date share period 0.

    Shaping keeps a row's snapshot and nothing else of its origin, so the file rides along in it and is split off after.
    """
    documents = read_documents(spark, spec, paths, multi_line, stamp, with_path=True, base=base)
    rows = shape(unnest(documents, spec), spec)
    return rows.select(
        *[F.col(f"`{c}`") for c in rows.columns if c != SNAPSHOT],
        F.col(SNAPSHOT).getField("name").alias(SNAPSHOT),
        F.col(SNAPSHOT).getField("path").alias(FILE),
        F.coalesce(F.year(F.col(f"`{spec.date}`")), F.lit(0)).cast("string").alias(PERIOD),
    )


def arrived_feed(spark: SparkSession, spec: FeedSpec, store: str) -> DataFrame | None:
    """Everything that is present, one row per key, with its error reason or NULL."""
    rows = current_table(spark, store, spec.name)
    return None if rows is None else judged_arrivals(rows, spec)


def judged_arrivals(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rows of the store, of some periods or all, with one survivor per key and its error reason. A key never leaves its period."""
    rows = keep_latest(rows.drop(FILE), [*spec.key, REJECT_ID], SNAPSHOT)
    return tag_errors(look_back(rows, spec), spec.all_rules)


def clean_arrivals(
    spark: SparkSession,
    spec: FeedSpec,
    source: str,
    store: str,
    silver: str,
    quarantine: str,
    batch_id: str,
    multi_line: bool = True,
    stamp: str | None = None,
    base: str | None = None,
) -> CleanCounts:
    """The batch cleaning job's outputs and gates, without reading unchanged snapshots again."""
    merge_arrivals(spark, spec, source, store, multi_line, stamp, base)
    tagged = arrived_feed(spark, spec, store)
    if tagged is None:
        raise FeedQualityError(f"{spec.name}: no snapshot has arrived yet")
    return store_feed(spark, tagged, spec, silver, quarantine, batch_id)
