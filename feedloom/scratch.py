"""Shared-storage helpers: intermediate tables that outlive an executor, and path checks.

The file-system calls go through the driver's JVM, so jobs run in a classic session, not over a remote client session.
"""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

R = TypeVar("R")

_own_root: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Where it is unset, a folder of this session on the default Hadoop file system, deleted when the process ends. If that is
    the machine's own disk while tasks run elsewhere, other machines would not see it, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        temporary = spark._jsc.hadoopConfiguration().get("hadoop.tmp.dir")
        fs, path = hadoop_path(spark, f"{temporary}/feedloom-{uuid.uuid4().hex}")
        if fs.getUri().getScheme() == "file" and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        path = fs.makeQualified(path)
        atexit.register(lambda: fs.delete(path, True))
        _own_root[app] = path.toString()
    return _own_root[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/feedloom/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) for any URI Spark can read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage without executor-local state, computes the plan once however often the result is
    used, and gives the planner real file sizes to choose join strategies from.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(calls: Sequence[Callable[[], R]], most: int = 8) -> list[R]:
    """The results of independent actions that run at the same time, so that small jobs fill the cores that others leave free.

    An error is raised when all of them have ended, so that none goes on behind its caller's back.
    """
    if len(calls) < 2:
        return [call() for call in calls]
    with ThreadPoolExecutor(max_workers=min(most, len(calls))) as pool:
        running = [pool.submit(inheritable_thread_target(call)) for call in calls]
    return [r.result() for r in running]
