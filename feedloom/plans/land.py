"""Land fetched documents so that many tasks can read them: one document per line, one folder per load date."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from feedloom.operators.sinks import land_snapshot
from feedloom.sources.feeds import FEED_FILES, FeedSpec

LOAD_DATE = "load_date"


def land_feed(spark: SparkSession, spec: FeedSpec, bronze: str, landed: str) -> None:
    """Land the feed's files under ``bronze``. A file's load date is the date stamp in its name; landing a date again replaces it.

    Each file is read whole by one task here, once; after that its documents are read line by line.
    """
    files = spark.read.text(f"{bronze}/{FEED_FILES[spec.name]}", wholetext=True)
    stamp = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{8})", 1)
    documents = files.select("value", stamp.alias(LOAD_DATE)).filter(F.length(F.trim("value")) > 0)
    land_snapshot(documents, f"{landed}/{spec.name}", LOAD_DATE, fmt="text")
