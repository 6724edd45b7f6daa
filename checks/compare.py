"""Run each Spark query and its SQL side by side: ``python -m checks.compare [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.session import local_session
from checks.spark_queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of exact text, columns by name."""
    columns = sorted(df.columns)
    out = pd.DataFrame(index=df.index)
    for c in columns:
        values = df[c]
        if pd.api.types.is_datetime64_any_dtype(values) or str(values.dtype) == "object":
            text = values.map(lambda v: "NULL" if v is None or v is pd.NaT or v != v else str(v).replace(" 00:00:00", ""))
        elif pd.api.types.is_float_dtype(values):
            text = values.map(lambda v: "NULL" if v != v else repr(float(v) + 0.0))
        else:
            text = values.map(lambda v: "NULL" if pd.isna(v) else str(v))
        out[c] = text
    return sorted(map(tuple, out.to_numpy().tolist()))


def differences(spark, connection, name: str, sf_dir: str) -> tuple[int, list[str]]:
    """(row count, what differs)."""
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = connection.sql(ORACLES[name]).df()
    problems = []
    if sorted(ours.columns) != sorted(theirs.columns):
        return len(ours), [f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"]
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} / {len(theirs)}")
    kinds = {c: (str(ours[c].dtype), str(theirs[c].dtype)) for c in ours.columns}
    for c, (a, b) in kinds.items():
        if a[:3] != b[:3] and {a[:3], b[:3]} != {"obj", "dat"}:
            problems.append(f"type of {c}: {a} / {b}")
    a, b = canonical(ours), canonical(theirs)
    if a != b:
        first = next(((x, y) for x, y in zip(a, b) if x != y), None)
        problems.append(f"values, first {first}")
    return len(ours), problems


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, connection = local_session(8), oracle_connection(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            rows, problems = differences(spark, connection, name, sf_dir)
        except Exception as error:  # one broken query must not hide the others
            rows, problems = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        failed += bool(problems)
        print(f"{name:24} {rows:8} rows {time.time() - start:6.2f} s  {'ok' if not problems else problems}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
