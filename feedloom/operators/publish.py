"""Publish several upserted tables as one: readers see all of a publish or none of it.

Every publish writes new folders, named after its own attempt, and never touches the ones in use; a small pointer file, created
last and never overwritten, says which folders make up each table now. Of two publishers that start from the same version
one creates the next pointer and the other fails; what the other wrote is in folders that no pointer names. A table
may be cut into periods (such as years); an upsert then rewrites only the periods it touches and the pointer carries the others
over, so a weekly load costs what the week's periods cost rather than what the table's history costs.

    <root>/<table>/version=<n>-<attempt>/period=<p>/part-*.parquet
    <root>/_published/<n>.json
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.dedup import keep_latest
from feedloom.operators.merge import MissingKeyError, null_key, upsert
from feedloom.scratch import at_once, drop_path, hadoop_path, path_exists

POINTERS = "_published"
PERIOD = "period"
WHOLE = "all"


@dataclass(frozen=True)
class ServedTable:
    """``period``, if given, is ``year(column)`` of a key column, or its quarter or month, so that a key never moves between
    periods and the calendar bounds the periods that the pointer lists.

    Normally a staged row replaces the one that has its key, and no key column may be NULL. With
    ``newest`` the row with the greater value of that column stays, wherever it comes from, so that
    staging may arrive in any order; NULL is then a key value like any other.
    """

    name: str
    keys: Sequence[str]
    period: str | None = None
    newest: str | None = None

    def __post_init__(self) -> None:
        unit = re.fullmatch(r"(?:year|quarter|month)\((\w+)\)", self.period) if self.period else None
        if self.period and (unit is None or unit[1] not in self.keys):
            raise ValueError(f"{self.name}: {self.period} is no year, quarter or month of a key column")


def publish(spark: SparkSession, root: str, staged: Mapping[str, DataFrame], tables: Sequence[ServedTable]) -> int:
    """Merge every staged table, then switch the pointer. Tables not staged keep what they have.

    Staged rows are read more than once; materialize them if they are costly. A failure before the
    switch leaves the old publish in force. Two publishes at once are not merged: the second to switch fails.
    """
    version, parts = _latest(spark, root)
    changes = {}
    for table in tables:
        if table.name not in staged:
            continue
        period = F.lit(WHOLE) if table.period is None else F.expr(table.period).cast("string")
        rows = staged[table.name].withColumn(PERIOD, period)
        staged_sums = _check_keys(rows, table)
        old = {p: v for p, v in parts.get(table.name, {}).items() if p in staged_sums}
        current = _read(spark, root, table.name, old)
        same = _unchanged(staged_sums, current, rows.columns)
        touched = [p for p in staged_sums if p not in same]
        if same and not touched:
            continue
        if same:
            rows = rows.filter(F.col(PERIOD).isin(touched))
            current = _read(spark, root, table.name, {p: v for p, v in old.items() if p in touched})
        changes[table.name] = (_merged(current, rows, table), touched)
    return replace_periods(spark, root, changes, version)


def new_attempt(base: int) -> str:
    """A name for the folders of a publish upon version ``base``."""
    return f"{base + 1}-{uuid.uuid4().hex}"


def write_periods(root: str, name: str, rows: DataFrame, attempt: str, more: bool = False) -> DataFrame:
    """Write a table's rows where ``replace_periods`` will publish them from, and read them back. No pointer names them yet.

    ``more`` adds them to rows of the same columns that are there.
    """
    folder = _folder(root, name, attempt)
    rows.write.mode("append" if more else "error").partitionBy(PERIOD).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def drop_attempt(spark: SparkSession, root: str, names: Iterable[str], attempt: str) -> None:
    """Remove what was written for a publish that will not be."""
    for name in names:
        drop_path(spark, _folder(root, name, attempt))


def replace_periods(
    spark: SparkSession,
    root: str,
    changes: Mapping[str, tuple[DataFrame, Sequence[str]]],
    base: int,
    attempt: str | None = None,
) -> int:
    """Per table, make the rows given (with their ``period``) the whole content of the periods named.

    ``base`` is the version that the rows were computed from; the switch fails if another one has come since. With an ``attempt`` the
    rows have been written for it by ``write_periods``.
    """
    _, parts = _latest(spark, root)
    new = attempt or new_attempt(base)

    def writing(name: str, rows: DataFrame):
        return lambda: rows.write.partitionBy(PERIOD).parquet(_folder(root, name, new))

    if attempt is None:
        at_once([writing(name, rows) for name, (rows, _) in changes.items()])
    for name, (_, touched) in changes.items():
        # A period that has lost its last row has no folder; the pointer forgets it.
        filled = {p: new for p in touched if path_exists(spark, f"{_folder(root, name, new)}/{PERIOD}={p}")}
        parts[name] = {p: v for p, v in parts.get(name, {}).items() if p not in touched} | filled
    return _switch(spark, root, base, parts)


def drop_old_versions(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Remove the folders that none of the newest ``keep`` pointers names, and those pointers' predecessors.

    Not while a publish or a reader of an older version is running: their folders look like leftovers. Returns what was removed.
    """
    numbers = _versions(spark, root)
    kept = [_pointer(spark, root, n) for n in numbers[-keep:]]
    if not any(kept):
        return []
    names = {table for pointer in kept if pointer for table in pointer}
    removed = []
    for table in sorted(names):
        used = {f"version={v}" for pointer in kept if pointer for v in pointer.get(table, {}).values()}
        fs, folder = hadoop_path(spark, f"{root}/{table}")
        for status in fs.listStatus(folder):
            if status.getPath().getName() not in used:
                fs.delete(status.getPath(), True)
                removed.append(status.getPath().toString())
    for number in numbers[:-keep]:
        drop_path(spark, f"{root}/{POINTERS}/{number}.json")
    return removed


def _sums(columns: Sequence[str]) -> list[Column]:
    """What tells two sets of rows apart, whatever their order: their number and two sums of hashes."""
    names = [F.col(f"`{c}`") for c in sorted(columns)]
    hashed = [F.xxhash64(F.lit(seed), *names).cast("decimal(38,0)") for seed in (1, 2)]
    return [F.count("*").alias("_rows"), *[F.sum(h).alias(f"_sum{i}") for i, h in enumerate(hashed)]]


def _check_keys(rows: DataFrame, table: ServedTable) -> dict[str, tuple]:
    """The periods staged with the sums of their rows, in one pass that also refuses NULL keys. One row per period comes back."""
    nulls = F.count_if(null_key(table.keys)).alias("_null_keys")
    periods = rows.groupBy(PERIOD).agg(nulls, *_sums(rows.columns)).collect()
    if table.newest is None and any(p["_null_keys"] for p in periods):
        raise MissingKeyError(f"{table.name}: staged rows with a NULL in {', '.join(table.keys)}")
    return {p[PERIOD]: tuple(p[2:]) for p in periods}


def _unchanged(staged: Mapping[str, tuple], current: DataFrame | None, columns: Sequence[str]) -> set[str]:
    """The periods whose staged rows are the rows already published. They keep their files."""
    if current is None or set(current.columns) != set(columns):
        return set()
    published = {p[PERIOD]: tuple(p[1:]) for p in current.groupBy(PERIOD).agg(*_sums(columns)).collect()}
    return {p for p, sums in staged.items() if published.get(p) == sums}


def _merged(current: DataFrame | None, rows: DataFrame, table: ServedTable) -> DataFrame:
    keys = [*table.keys, PERIOD]
    if table.newest is None:
        merged = upsert(current, rows, keys)
    else:
        both = rows if current is None else current.unionByName(rows)
        merged = keep_latest(both, keys, table.newest)
    return merged if table.period is None else merged.hint("rebalance", PERIOD)


def current_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The table as last published, or ``None`` if it never was."""
    _, parts = _latest(spark, root)
    df = _read(spark, root, table, parts.get(table, {}))
    return None if df is None else df.drop(PERIOD)


def read_periods(spark: SparkSession, root: str, table: str, periods: Sequence[str]) -> tuple[int, DataFrame | None]:
    """(version, rows with their ``period``) of the periods named, as last published."""
    version, parts = _latest(spark, root)
    return version, _read(spark, root, table, {p: v for p, v in parts.get(table, {}).items() if p in periods})


def read_periods_at(
    spark: SparkSession, root: str, table: str, version: int, periods: Sequence[str]
) -> DataFrame | None:
    """The periods named as they were at an earlier version that has not been dropped."""
    parts = _pointer(spark, root, version) if version else {}
    if parts is None:
        raise RuntimeError(f"{root}: version {version} has been dropped")
    return _read(spark, root, table, {p: v for p, v in parts.get(table, {}).items() if p in periods})


def changed_since(spark: SparkSession, root: str, table: str, version: int) -> tuple[int, list[str]]:
    """(version now, periods written, emptied or new since ``version``), told by the pointers alone; no row is read.

    What follows this table remembers the version it was made from and asks for the rest. If that version has been dropped, every period counts as changed.
    """
    now, parts = _latest(spark, root)
    current = parts.get(table, {})
    known = set(_versions(spark, root))
    before = (_pointer(spark, root, version) or {}) if version in known else {}
    earlier = before.get(table, {})
    return now, sorted(p for p in current.keys() | earlier.keys() if current.get(p) != earlier.get(p))


def _folder(root: str, table: str, version: str) -> str:
    return f"{root}/{table}/version={version}"


def _read(spark: SparkSession, root: str, table: str, parts: Mapping[str, str]) -> DataFrame | None:
    """The given periods, each from the version that wrote it last."""
    if not parts:
        return None
    paths = [f"{_folder(root, table, v)}/{PERIOD}={p}" for p, v in sorted(parts.items())]
    df = spark.read.option("basePath", f"{root}/{table}").parquet(*paths).drop("version")
    return df.withColumn(PERIOD, F.col(PERIOD).cast("string"))


def _versions(spark: SparkSession, root: str) -> list[int]:
    folder = f"{root}/{POINTERS}"
    if not path_exists(spark, folder):
        return []
    fs, path = hadoop_path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _pointer(spark: SparkSession, root: str, version: int) -> dict[str, dict[str, str]] | None:
    """What a pointer says, or ``None`` while it is being written or if its writer died."""
    row = spark.read.text(f"{root}/{POINTERS}/{version}.json", wholetext=True).first()
    try:
        return json.loads(row[0]) if row else None
    except ValueError:
        return None


def _latest(spark: SparkSession, root: str) -> tuple[int, dict[str, dict[str, str]]]:
    """The newest complete pointer."""
    for version in reversed(_versions(spark, root)):
        parts = _pointer(spark, root, version)
        if parts is not None:
            return version, parts
    return 0, {}


def _switch(spark: SparkSession, root: str, base: int, parts: Mapping[str, Mapping[str, str]]) -> int:
    """Create the next pointer. Creation without overwrite is what lets one of two publishers through."""
    if _latest(spark, root)[0] != base:
        raise RuntimeError(f"publish {base + 1} was made by someone else meanwhile")
    # A writer that died left an incomplete pointer, whose number is used up.
    version = max(_versions(spark, root), default=base) + 1
    fs, target = hadoop_path(spark, f"{root}/{POINTERS}/{version}.json")
    try:
        out = fs.create(target, False)
    except Exception as error:
        raise RuntimeError(f"publish {version} was made by someone else meanwhile") from error
    out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
    out.close()
    return version
