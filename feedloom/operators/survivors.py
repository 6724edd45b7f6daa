"""A store of arrived rows from which the survivor of each key is read without a shuffle.

The store is a table bucketed by a digest of the key. Every arrival is appended: of each key, the best row of each origin (such as a file), as an
event of a turn. An origin that is withdrawn gets an event without a row, so that the next best row of its keys comes back. Reading the
survivors meets each key in its bucket, where all its events are; only a new batch is shuffled, never what is stored.

Of a key and an origin the event of the latest turn counts, and a row before a withdrawal of the same turn, so an origin is
replaced by withdrawing and adding it in one turn. Of the rows that count, ``keep_latest`` picks the survivor: the outcome is that of the whole
table deduplicated at once, in whatever order its origins arrived. A turn sent again changes nothing.

NULL is a key value like any other; key values are told apart by their text. A key with a third of all rows reaches its bucket as
one row per origin and map task. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom.operators.dedup import keep_latest, keep_one
from feedloom.scratch import drop_path, hadoop_path, materialize, scratch_path

KEY, ORIGIN, TURN, GONE = "_key", "_origin", "_turn", "_gone"
MARK = "_buckets-"


def key_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of the key's values, each with its length, so that no two keys read alike."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.char_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


class SurvivorStore:
    """The store at a path that every executor reaches; it outlives the session.

    Its bucket count is kept beside it, as the name of an empty file that readers of the table skip, and is adopted when it is opened again.
    ``schema`` is that of the rows, ``key`` and ``newest`` columns of it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, key: Sequence[str], newest: str, buckets: int = 32) -> None:
        own = {KEY, ORIGIN, TURN, GONE} & set(schema.names)
        if own:
            raise ValueError(f"columns that the store uses itself: {', '.join(sorted(own))}")
        self.spark, self.path, self.schema, self.key, self.newest = spark, path, schema, tuple(key), newest
        self.buckets = self._known_buckets() or self._mark(buckets)
        self.name = f"survivors_{uuid.uuid4().hex}"
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
        spark.sql(
            f"CREATE TABLE {self.name} ({', '.join(fields)}, {KEY} BINARY, {ORIGIN} STRING, {TURN} BIGINT, {GONE} BOOLEAN) USING parquet "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS LOCATION '{path}'"
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

    def _append(self, events: DataFrame) -> None:
        # Dealt as the table is bucketed, each bucket is one file a turn.
        events.select(*self.schema.names, KEY, ORIGIN, TURN, GONE).repartition(self.buckets, KEY).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def events(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame, origin: Column, turn: int) -> None:
        """Take in the rows of some origins. ``origin`` says where each comes from, and may be a column that is not stored."""
        told = rows.withColumn(ORIGIN, origin).select(*self.schema.names, ORIGIN).withColumn(KEY, key_digest(self.key))
        best = keep_latest(told, [KEY, ORIGIN], self.newest)
        self._append(best.withColumns({TURN: F.lit(turn).cast("long"), GONE: F.lit(False)}))

    def withdraw(self, origins: DataFrame, turn: int) -> None:
        """Take back every row of the origins (one column). Only keys and origins of the store are read."""
        gone = origins.select(F.col(f"`{origins.columns[0]}`").cast("string").alias(ORIGIN)).distinct()
        held = self._latest(self.events().select(KEY, ORIGIN, TURN, GONE)).select(KEY, ORIGIN).join(gone, ORIGIN, "left_semi")
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        events = held.select(*nothing, KEY, ORIGIN, F.lit(turn).cast("long").alias(TURN), F.lit(True).alias(GONE))
        # What is written would else be read while it is written.
        work = scratch_path(self.spark, "survivors-gone")
        try:
            self._append(materialize(events, work))
        finally:
            drop_path(self.spark, work)

    def _latest(self, events: DataFrame) -> DataFrame:
        """The events that count, withdrawals left out."""
        return keep_one(events, [KEY, ORIGIN], [F.col(TURN).desc(), F.col(GONE).asc()]).filter(~F.col(GONE))

    def survivors(self, of: DataFrame | None = None) -> DataFrame:
        """One row per key; ``of``, if given, has the key's columns and names the keys wanted, and is all that is shuffled."""
        events = self.events()
        if of is not None:
            wanted = of.select(key_digest(self.key).alias(KEY)).distinct()
            events = events.join(wanted.hint("merge"), KEY, "left_semi")
        rows = self._latest(events).drop(ORIGIN, TURN, GONE)
        return keep_latest(rows, [KEY], self.newest).drop(KEY)

    def merged(self, path: str, buckets: int | None = None) -> SurvivorStore:
        """A store at ``path`` with nothing but the rows that count, in as many buckets as asked for."""
        other = SurvivorStore(self.spark, path, self.schema, self.key, self.newest, buckets or self.buckets)
        other._append(self._latest(self.events()))
        return other

    def close(self) -> None:
        """Forget the session's name for the store; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
