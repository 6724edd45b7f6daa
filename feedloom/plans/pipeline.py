"""The whole job: clean three feeds, build the star, publish it."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

from feedloom.operators.publish import drop_old_versions
from feedloom.operators.segments import merge_segments
from feedloom.plans.changes import run_changes
from feedloom.plans.clean import CleanCounts, clean_files
from feedloom.plans.land import LOAD_DATE, land_feed
from feedloom.plans.load import load_star
from feedloom.plans.star import StarOptions, build_star
from feedloom.sources.feeds import FEED_FILES, MOVEMENTS, PRICES, STOCKS, FeedSpec
from feedloom.streaming.incremental import clean_arrivals


@dataclass(frozen=True)
class Paths:
    bronze: str
    silver: str
    quarantine: str
    gold: str
    serving: str
    arrivals: str
    landed: str
    changes: str

    @classmethod
    def under(cls, root: str) -> Paths:
        return cls(*(f"{root}/{field.name}" for field in fields(cls)))


FEEDS = (PRICES, STOCKS, MOVEMENTS)


def land_all(spark: SparkSession, paths: Paths) -> None:
    for spec in FEEDS:
        land_feed(spark, spec, paths.bronze, paths.landed)


def feed_source(paths: Paths, spec: FeedSpec, landed: bool) -> tuple[str, dict]:
    """Where a feed's snapshots are and how they are read."""
    base = f"{paths.landed}/{spec.name}"
    if landed:
        return f"{base}/*/*", {"multi_line": False, "stamp": LOAD_DATE, "base": base}
    return f"{paths.bronze}/{FEED_FILES[spec.name]}", {}


def clean_all(
    spark: SparkSession, paths: Paths, batch_id: str, incremental: bool = False, landed: bool = False
) -> dict[str, CleanCounts]:
    """Clean the three feeds from every snapshot, or from what has changed since.

    The snapshots are the files in bronze, one task each, or, with ``landed``, what ``land_all`` made of them, which splits.
    """
    counts = {}
    for spec in FEEDS:
        base = f"{paths.landed}/{spec.name}"
        source, form = feed_source(paths, spec, landed)
        outputs = (paths.silver, paths.quarantine, batch_id)
        if incremental:
            counts[spec.name] = clean_arrivals(spark, spec, source, f"{paths.arrivals}/{spec.name}", *outputs, **form)
        else:
            form.pop("base", None)
            counts[spec.name] = clean_files(spark, spec, base if landed else source, *outputs, **form)
    return counts


def run(
    spark: SparkSession,
    paths: Paths,
    batch_id: str,
    options: StarOptions = StarOptions(),
    incremental: bool = False,
    landed: bool = False,
) -> dict[str, CleanCounts]:
    """Run every step; any gate that fails stops the ones after it. Re-running a batch changes nothing."""
    if landed:
        land_all(spark, paths)
    counts = clean_all(spark, paths, batch_id, incremental, landed)
    build_star(spark, paths.silver, paths.gold, options)
    load_star(spark, paths.gold, paths.serving)
    return counts


def run_changed(
    spark: SparkSession, paths: Paths, batch_id: str, options: StarOptions = StarOptions(), landed: bool = False
) -> dict[str, CleanCounts]:
    """The whole job over what has changed since the last one; a week's run costs the years that the week touches."""
    if landed:
        land_all(spark, paths)
    return run_changes(spark, paths, batch_id, {spec.name: feed_source(paths, spec, landed) for spec in FEEDS}, options)


def prune(spark: SparkSession, paths: Paths, keep: int = 1) -> list[str]:
    """Merge small quarantine segments and remove superseded versions of every store; what was removed.

    Only after a complete run and while none is under way: one that stopped midway still reads the versions it started from.
    """
    for spec in FEEDS:
        merge_segments(spark, f"{paths.quarantine}_events/{spec.name}")
    stores = [paths.serving, f"{paths.changes}/gold"]
    for spec in FEEDS:
        stores += [f"{root}/{spec.name}" for root in (paths.arrivals, paths.changes, paths.quarantine, f"{paths.quarantine}_events")]
    return [path for store in stores for path in drop_old_versions(spark, store, keep)]
