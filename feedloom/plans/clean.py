"""Clean a feed: documents to valid silver rows plus quarantined ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedup import keep_latest
from feedloom.operators.quality import (
    REASON,
    bad_rows,
    require_rows,
    require_survivors,
    tag_errors,
    valid_rows,
    write_quarantine,
)
from feedloom.operators.sinks import replace_table
from feedloom.scratch import drop_path, materialize, scratch_path
from feedloom.sources.feeds import (
    CORRUPT,
    RAW_VALUE,
    REJECT_ID,
    SNAPSHOT,
    FeedSpec,
    look_back,
    read_documents,
    shape,
    unnest,
)
from feedloom.sources.split_json import read_records


@dataclass(frozen=True)
class CleanCounts:
    """``by_rule`` has the rows that each rule was the first to refuse, where they were counted."""

    total: int
    valid: int
    bad: int
    by_rule: Mapping[str, int] = field(default_factory=dict, compare=False)

    @property
    def bad_share(self) -> float:
        return self.bad / self.total if self.total else 0.0

    def shares(self) -> dict[str, float]:
        """Each rule's share of all rows."""
        return {reason: n / self.total for reason, n in self.by_rule.items()} if self.total else {}


def materialize_counted(tagged: DataFrame, reasons: Sequence[str], path: str) -> tuple[DataFrame, CleanCounts]:
    """Write tagged rows once and take their counts from that same write, without a second read.

    The measures are made in the write's own tasks, each of which counts once however often it is tried.
    """
    seen = Observation()
    each = {f"rule{i}": F.count_if(F.col(REASON) == reason) for i, reason in enumerate(reasons)}
    bad = F.count_if(F.col(REASON).isNotNull())
    observed = tagged.observe(seen, F.count(F.lit(1)).alias("total"), bad.alias("bad"), *[c.alias(n) for n, c in each.items()])
    stored = materialize(observed, path)
    found = seen.get
    by_rule = {reason: found[f"rule{i}"] for i, reason in enumerate(reasons)}
    return stored, CleanCounts(found["total"], found["total"] - found["bad"], found["bad"], by_rule)


def tagged_feed(documents: DataFrame, spec: FeedSpec, dedup: bool = True) -> DataFrame:
    """Shaped rows, one per key unless ``dedup`` is off, each with its error reason or NULL.

    The business filter comes before dedup and the rules after it: the newest snapshot decides what
    a key's value is, even if that value then fails a rule.
    """
    return tagged_records(unnest(documents, spec), spec, dedup)


def tagged_records(records: DataFrame, spec: FeedSpec, dedup: bool = True) -> DataFrame:
    rows = shape(records, spec)
    if dedup:
        rows = keep_latest(rows, [*spec.key, REJECT_ID], SNAPSHOT)
    return tag_errors(look_back(rows, spec), spec.all_rules)


def rejected(bad: DataFrame, spec: FeedSpec, *besides: str) -> DataFrame:
    """Bad rows as they are quarantined: with the text that did not parse and the snapshot it came from."""
    return bad.select(
        *spec.columns,
        F.when(F.col(CORRUPT).isNull(), F.col(REJECT_ID)).alias("raw_period"),
        F.col(RAW_VALUE).alias("raw_value"),
        F.col(CORRUPT).alias("raw_document"),
        F.col(SNAPSHOT).alias("snapshot"),
        REASON,
        *besides,
    )


def store_feed(
    spark: SparkSession, tagged: DataFrame, spec: FeedSpec, silver: str, quarantine: str, batch_id: str
) -> CleanCounts:
    """Replace ``silver``/<feed> with the valid rows and merge the bad ones into the feed's history.

    The tagged rows are written once to shared scratch, so neither output recomputes the parse or the
    dedup and the two cannot disagree. The counts are taken while they are written, and the
    quarantine skips every row group whose reasons are all NULL. A batch that is bad throughout still
    leaves its quarantine rows before the job fails.
    """
    work = scratch_path(spark, spec.name)
    try:
        stored, n = materialize_counted(tagged, [rule.reason for rule in spec.all_rules], work)
        require_rows(n.total, spec.name)
        write_quarantine(rejected(bad_rows(stored), spec), f"{quarantine}/{spec.name}", batch_id)
        require_survivors(n.valid, spec.name)
        good = valid_rows(stored).select(*spec.columns)
        replace_table(good, f"{silver}/{spec.name}", sort_by=(spec.date,))
        return n
    finally:
        drop_path(spark, work)


def valid_feed(documents: DataFrame, spec: FeedSpec, dedup: bool = True) -> DataFrame:
    """The silver rows as a plan, nothing written."""
    return valid_rows(tagged_feed(documents, spec, dedup)).select(*spec.columns)


def clean_files(
    spark: SparkSession,
    spec: FeedSpec,
    path: str,
    silver: str,
    quarantine: str,
    batch_id: str,
    multi_line: bool = True,
    stamp: str | None = None,
    split: bool = False,
) -> CleanCounts:
    """Clean every snapshot under ``path``; ``stamp`` is the folder column of landed documents.

    ``split`` reads each indented document with many tasks instead of one.
    """
    if split:
        return store_feed(spark, tagged_records(read_records(spark, spec, path), spec), spec, silver, quarantine, batch_id)
    tagged = tagged_feed(read_documents(spark, spec, path, multi_line, stamp), spec)
    return store_feed(spark, tagged, spec, silver, quarantine, batch_id)
