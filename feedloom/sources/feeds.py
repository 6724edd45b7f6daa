"""Feed documents: one nested JSON document per snapshot, read with a declared schema.

The schema is never inferred. Inference costs a pass over the input, changes type with the data, and
cannot analyse a feed whose documents are all empty.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.parsing import parse_day, parse_month, parse_number
from feedloom.operators.dedup import latest_n_per_series
from feedloom.operators.quality import Rule

DOCUMENT = "_document"
CORRUPT = "_corrupt_record"
SNAPSHOT = "_snapshot"
REJECT_ID = "_reject_id"
RAW_VALUE = "_raw_value"
DATE_REASON = "Unparsable Date"
DOCUMENT_REASON = "Unreadable Document"
UNDECIDED_REASON = "Undecided Filter"
SCALE_REASON = "Too Many Decimals"
SIZE_REASON = "Too Large To Sum"
#: What ``functions.sums.total`` can add.
LARGEST = 2.0**62


@dataclass(frozen=True)
class FeedSpec:
    """What one feed looks like and how its records become table rows.

    ``texts`` maps output columns to document fields. ``key`` names the output columns that identify
    a row; of several snapshots of one key the newest wins. ``keep`` is a business filter: rows it
    drops are not errors, but rows it cannot decide on are. ``facets`` are wanted values of text columns, part of the filter.
    ``latest``, with ``series``, is the look-back: so many newest dates of each series. ``scale`` is the number of decimals that a
    measure may have, so that sums of them are exact. ``rules`` are checked after the built-in rules.
    """

    name: str
    date: str
    measure: str
    texts: Mapping[str, str]
    key: Sequence[str]
    rules: Sequence[Rule]
    monthly: bool = False
    keep: str | None = None
    facets: Mapping[str, Sequence[str]] = field(default_factory=dict)
    latest: int | None = None
    series: Sequence[str] = ()
    scale: int = 6
    period_field: str = "period"
    value_field: str = "value"

    @property
    def columns(self) -> list[str]:
        return [self.date, self.measure, *self.texts]

    @property
    def record_fields(self) -> list[str]:
        return [self.period_field, self.value_field, *self.texts.values()]

    @property
    def filter(self) -> str | None:
        """The business filter and the facets as one condition."""
        quoted = {c: ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in wanted) for c, wanted in self.facets.items()}
        conditions = [f"({self.keep})"] if self.keep else []
        return " AND ".join([*conditions, *(f"`{c}` IN ({values})" for c, values in quoted.items())]) or None

    @property
    def record_filter(self) -> str | None:
        """The filter over a record ``_r`` as it is in its document, if it is about text columns only."""
        names = re.compile(r"'(?:[^'\\]|\\.)*'|`?\b([A-Za-z_]\w*)\b`?")
        text = self.filter or ""
        if {m[1] for m in names.finditer(text)} & {self.date, self.measure}:
            return None
        return names.sub(lambda m: f"_r.`{self.texts[m[1]]}`" if m[1] in self.texts else m[0], text) or None

    @property
    def all_rules(self) -> list[Rule]:
        return [
            Rule(DOCUMENT_REASON, f"{CORRUPT} IS NULL"),
            Rule(DATE_REASON, f"`{self.date}` IS NOT NULL"),
            *([Rule(UNDECIDED_REASON, self.filter)] if self.filter else []),
            *self.rules,
            Rule(SCALE_REASON, f"`{self.measure}` IS NULL OR round(`{self.measure}`, {self.scale}) = `{self.measure}`"),
            Rule(SIZE_REASON, f"`{self.measure}` IS NULL OR abs(`{self.measure}`) < {LARGEST!r}D"),
        ]


def document_schema(spec: FeedSpec) -> T.StructType:
    """Every record field as text: numbers and quoted numbers then read alike."""
    record = T.StructType([T.StructField(n, T.StringType()) for n in spec.record_fields])
    data = T.StructType([T.StructField("data", T.ArrayType(record))])
    return T.StructType([T.StructField("response", data), T.StructField(CORRUPT, T.StringType())])


def read_documents(
    spark: SparkSession,
    spec: FeedSpec,
    path: str | list[str],
    multi_line: bool = True,
    stamp: str | None = None,
    with_path: bool = False,
    base: str | None = None,
) -> DataFrame:
    """Documents under ``path`` (a glob or a list is fine) with the snapshot each came from.

    The file name carries the snapshot's date stamp, so names order snapshots; for landed documents
    ``stamp`` names the folder column (such as ``load_date``) that does. A multi-line document
    cannot be split: one task parses one file. That suits many bounded API responses; land anything
    larger as one document per line and read it with ``multi_line=False``, which splits. ``with_path`` makes the
    snapshot a pair of its name and the file's path. ``base`` is the folder of the stamps if single files are given.
    """
    schema = document_schema(spec)
    if stamp is not None:
        schema = schema.add(stamp, T.StringType())
    raw = (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .options(**({"basePath": base} if base else {}))
        .json(path)
    )
    snapshot = F.col("_metadata.file_name" if stamp is None else stamp)
    if with_path:
        snapshot = F.struct(snapshot.alias("name"), F.col("_metadata.file_path").alias("path"))
    return raw.select(F.struct("response", CORRUPT).alias(DOCUMENT), snapshot.alias(SNAPSHOT))


def unnest(documents: DataFrame, spec: FeedSpec | None = None) -> DataFrame:
    """One row per record; empty documents vanish.

    A document that breaks its schema anywhere gives a single row that carries its whole text to
    quarantine. Records that the filter of ``spec`` drops are taken out of the array, before they become rows; a filter on rows
    would be pushed below the parse, by repeating the parse.
    The text gets a column of its own first, or every record would drag its whole document along.
    """
    data, corrupt = F.col(f"{DOCUMENT}.response.data"), F.col(CORRUPT)
    if spec and spec.record_filter:
        data = F.expr(f"filter({DOCUMENT}.response.data, _r -> coalesce({spec.record_filter}, true))")
    records = F.when(corrupt.isNotNull(), F.array(F.lit(None))).otherwise(data)
    return documents.withColumn(CORRUPT, F.col(f"{DOCUMENT}.{CORRUPT}")).select(
        F.explode(records).alias("record"), CORRUPT, SNAPSHOT
    )


def snapshot_name(records: DataFrame) -> Column:
    paired = isinstance(records.schema[SNAPSHOT].dataType, T.StructType)
    return F.col(SNAPSHOT).getField("name") if paired else F.col(SNAPSHOT)


def shape(records: DataFrame, spec: FeedSpec) -> DataFrame:
    """Typed, renamed columns plus what dedup and quarantine need to know about each row's origin.

    A row without a usable date has no business key. ``_reject_id`` keeps such rows apart, so that
    different rejects are not folded into one; it is NULL for every row that does have a date.
    ``_raw_value`` holds the text of a value that is not a number, for whoever reads the quarantine.
    """
    period = F.col(f"record.`{spec.period_field}`")
    value = F.col(f"record.`{spec.value_field}`")
    day = parse_month(period) if spec.monthly else parse_day(period)
    number = parse_number(value)
    texts = [F.col(f"record.`{field}`").alias(out) for out, field in spec.texts.items()]
    shaped = records.select(
        day.alias(spec.date),
        number.alias(spec.measure),
        *texts,
        F.when(F.col(CORRUPT).isNotNull(), F.sha2(F.concat_ws("/", snapshot_name(records), CORRUPT), 256))
        .when(day.isNull(), F.coalesce(period, F.lit("")))
        .alias(REJECT_ID),
        F.when(number.isNull(), value).alias(RAW_VALUE),
        CORRUPT,
        SNAPSHOT,
    )
    if spec.filter is None:
        return shaped
    return shaped.filter(F.expr(f"coalesce({spec.filter}, true)") | F.col(CORRUPT).isNotNull())


def look_back(rows: DataFrame, spec: FeedSpec) -> DataFrame:
    """The newest dates of each series, one row per key given. Rows without a date have no place in a series and stay."""
    if spec.latest is None:
        return rows
    day = F.col(f"`{spec.date}`")
    order = [day.desc(), *[F.col(f"`{c}`").asc() for c in spec.key]]
    return latest_n_per_series(rows.filter(day.isNotNull()), spec.latest, spec.series, order).unionByName(rows.filter(day.isNull()))


def keep_facets(df: DataFrame, facets: Mapping[str, Sequence[object]]) -> DataFrame:
    """Rows whose columns hold one of the wanted values, such as given series, products or areas."""
    for column, wanted in facets.items():
        df = df.filter(F.col(column).isin(list(wanted)))
    return df


FINITE = "abs(`{0}`) < double('Infinity')"


def finite(column: str) -> str:
    """False for NaN (which sorts above infinity) and both infinities; NULL for NULL."""
    return FINITE.format(column)


# The three feeds' field names, table columns, keys, business filter and error reasons.
PRICES = FeedSpec(
    name="petroleum_prices",
    date="date",
    measure="price_usd_per_gal",
    texts={"product_name": "product-name", "process_name": "process-name"},
    key=("date", "product_name"),
    rules=(
        Rule(
            "Invalid or Null Price",
            f"price_usd_per_gal IS NOT NULL AND price_usd_per_gal > 0 AND {finite('price_usd_per_gal')}",
        ),
    ),
)
STOCKS = FeedSpec(
    name="supply_estimates",
    date="date",
    measure="volume_k_barrels",
    texts={"product_name": "product-name", "process_name": "process-name", "area": "area-name"},
    key=("date", "product_name", "process_name", "area"),
    keep="process_name = 'Ending Stocks'",
    rules=(
        Rule(
            "Negative Volume in Ending Stocks",
            f"volume_k_barrels >= 0 AND {finite('volume_k_barrels')}",
        ),
    ),
)
MOVEMENTS = FeedSpec(
    name="logistics_movements",
    date="month_date",
    measure="volume_k_barrels_per_day",
    texts={
        "product_name": "product-name",
        "country_code": "area-name",
        "description": "series-description",
    },
    key=("month_date", "product_name", "country_code", "description"),
    monthly=True,
    rules=(
        Rule(
            "Null Volume Detected",
            f"volume_k_barrels_per_day IS NOT NULL AND {finite('volume_k_barrels_per_day')}",
        ),
    ),
)
FEED_FILES = {
    "petroleum_prices": "prices_*.json",
    "supply_estimates": "supply_*.json",
    "logistics_movements": "movements_*.json",
}
