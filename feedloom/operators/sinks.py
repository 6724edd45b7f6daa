"""Where results end: landed snapshots, replaced and appended tables, JDBC staging tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.scratch import hadoop_path

# Fixed value: the suffix of a staging table.
STAGING_SUFFIX = "_staging"


def land_snapshot(
    df: DataFrame,
    path: str,
    stamp: str = "load_date",
    fmt: str = "parquet",
    rebalance: bool = True,
    compression: str | None = None,
    rows_per_file: int = 0,
) -> None:
    """Write each load date to its own folder: landing a date again replaces it, a new date adds.

    ``fmt="text"`` lands documents as they came, one per line, which unlike one document per file can
    be split among readers. The rebalance shuffles rows towards few files per date but splits a date
    too big for one task; leave it out for rows that are spread by date already.

    ``compression`` is that of the files, if not the format's own. A reader cannot split a compressed text file, so ``rows_per_file``
    should then bound it; documents of unbounded size are better left as they are.
    """
    if fmt == "text":
        # JSON has no line breaks inside its strings, so a document on one line is the same document.
        unbroken = {c: F.replace(F.replace(c, F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(" ")) for c in df.columns if c != stamp}
        df = df.withColumns(unbroken)
    rows = df.hint("rebalance", stamp) if rebalance else df
    codec = {"compression": compression} if compression else {}
    (
        rows.write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", maxRecordsPerFile=rows_per_file, **codec)
        .partitionBy(stamp)
        .format(fmt)
        .save(path)
    )


def replace_table(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> None:
    """Replace a table once the new one is complete: a job that fails before leaves the old one.

    Sorting inside each task costs no shuffle and lets date-range scans skip pages.
    """
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    parent, name = path.rstrip("/").rsplit("/", 1)
    fs, new = hadoop_path(df.sparkSession, f"{parent}/_{name}-{uuid.uuid4().hex}")
    try:
        out.write.parquet(new.toString())
        _, old = hadoop_path(df.sparkSession, path)
        fs.delete(old, True)
        if not fs.rename(new, old):
            raise RuntimeError(f"{path} could not be replaced by {new.toString()}")
    except Exception:
        if fs.exists(hadoop_path(df.sparkSession, path)[1]) and fs.exists(new):
            fs.delete(new, True)
        raise
    df.sparkSession.catalog.refreshByPath(path)


def stage_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    connections: int = 16,
    batch_rows: int = 10_000,
) -> str:
    """Overwrite ``<table>_staging`` in a database and return that name.

    Executors write straight to the database. ``connections`` caps how many do so at once, since a
    cluster has more task slots than a database has sessions; Spark lowers the partition count to it.
    """
    staging = f"{table}{STAGING_SUFFIX}"
    options = {**properties, "numPartitions": str(connections), "batchsize": str(batch_rows)}
    df.write.jdbc(url=url, table=staging, mode="overwrite", properties=options)
    return staging
