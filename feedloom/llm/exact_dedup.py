"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest, one row per distinct text ever kept. A batch is reduced to one row per
digest, deduplicated against the index by a sort-merge anti-join that reads the index without shuffling it, and what is
new is appended.

Defined results: a NULL text is the empty text. A NULL doc_id never beats another one; where all of a group are NULL, the
group's keep_id is NULL and one such row stays. Of rows repeated with the same doc_id and text one stays. An empty batch
appends nothing and returns no rows. Only ``doc_id`` and ``text`` are read; other columns may have any name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import repeat_rows
from feedloom.scratch import drop_path, hadoop_path, materialize, scratch_path

BUCKETS = 32
#: Digests that a bucket should hold; a task reads one bucket.
ROWS_PER_BUCKET = 4_000_000
MARK = "_buckets-"


def buckets_for(rows: int) -> int:
    """The bucket count of an index of so many rows."""
    return max(BUCKETS, -(-rows // ROWS_PER_BUCKET))


class DigestIndex:
    """The index at a path that every executor reaches; it outlives the session.

    Its bucket count is kept beside it, as the name of an empty file that readers of the table skip, and is adopted when it is opened again,
    whatever count is asked for: files bucketed in one way would be looked up in another and texts missed. One writer at a time: two that
    append at once could both add a digest.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path = spark, path
        self.buckets = self._known_buckets() or self._mark(buckets)
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, n_rows BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def _known_buckets(self) -> int | None:
        fs, folder = hadoop_path(self.spark, self.path)
        if not fs.exists(folder):
            return None
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        marks = {int(n.removeprefix(MARK)) for n in names if n.startswith(MARK)}
        if len(marks) > 1 or not marks and any(not n.startswith(("_", ".")) for n in names):
            raise ValueError(f"{self.path} does not tell its bucket count")
        return marks.pop() if marks else None

    def _mark(self, buckets: int) -> int:
        fs, mark = hadoop_path(self.spark, f"{self.path}/{MARK}{buckets}")
        fs.create(mark, False).close()
        return buckets

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame, batch: str) -> None:
        """Add the groups (digest, keep_id, n_rows) whose digest the index does not hold.

        A batch that failed after its append may be sent again: its digests are then found and nothing is added twice.
        """
        new = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new.withColumn("batch", F.lit(batch)).select("digest", "keep_id", "n_rows", "batch").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def grown(self, path: str) -> DigestIndex:
        """An index at ``path`` with as many buckets as the rows now call for; this one if it has enough."""
        buckets = buckets_for(self.rows().count())
        if buckets <= self.buckets:
            return self
        other = DigestIndex(self.spark, path, buckets)
        self.rows().write.insertInto(other.name)
        self.spark.catalog.refreshTable(other.name)
        return other

    def close(self) -> None:
        """Forget the session's name for the index; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def deduplicate(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """One row per document of the batch: doc_id, digest, keep_id, group_size, kept.

    A text the index knew before this batch is dropped in favour of the indexed row. Of a text new in this batch the row
    with the largest doc_id stays. group_size counts the rows of this batch and those the index counted when it first saw
    the text. Counts and maxima are made before the shuffle, and the join back can be split by Spark, so that a text
    with a third of all rows is no hot spot.
    """
    spark = docs.sparkSession
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"))
    counted = counted.groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    counted = materialize(counted, scratch_path(spark, "dedup-batch"))
    groups = counted.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("n_rows"))
    work = scratch_path(spark, "dedup-groups")
    groups = materialize(groups, work)
    index.append(groups, batch)
    known = index.rows().withColumnsRenamed({"keep_id": "known_id", "n_rows": "known_rows"})
    fresh = F.col("batch") == batch
    decided = groups.join(known.hint("merge"), "digest").select(
        "digest",
        F.when(fresh, F.col("keep_id")).otherwise(F.col("known_id")).alias("keep_id"),
        (F.col("n_rows") + F.when(fresh, 0).otherwise(F.col("known_rows"))).alias("group_size"),
        fresh.alias("fresh"),
    )
    decided = materialize(decided, scratch_path(spark, "dedup-decided"))
    drop_path(spark, work)
    rows = repeat_rows(counted.join(decided, "digest"), "n", "__copy")
    stays = F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__copy") == 0)
    return rows.select("doc_id", "digest", "keep_id", "group_size", stays.alias("kept"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The whole table as one batch against a new index."""
    spark = docs.sparkSession
    path = scratch_path(spark, "digest-index")
    index = DigestIndex(spark, path, buckets_for(docs.count()))
    out = deduplicate(docs, index, "all")
    # What is returned no longer reads the index, and no other batch follows.
    index.close()
    drop_path(spark, path)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
