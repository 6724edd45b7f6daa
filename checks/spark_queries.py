"""One Spark query per operator. Every query reads whole tables."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import roles
from checks.roles import table
from feedloom.functions.calendar import month_text, week_start
from feedloom.functions.classify import NameClass
from feedloom.functions.keys import key_summary, surrogate_key
from feedloom.functions.parsing import parse_day, parse_month, parse_number
from feedloom.functions.sums import mean, total
from feedloom.functions.exact_sums import exact_sum
from feedloom.operators import registry, segments
from feedloom.operators.asof import as_of
from feedloom.operators.clustered import Between, scan_clustered, write_clustered
from feedloom.operators.dedup import keep_latest, keep_one, latest_n, latest_n_per_series
from feedloom.operators.dims import conform, date_dimension, named_dimension
from feedloom.operators.facts import (
    add_monthly_total,
    join_on_week,
    lookup_key,
    monthly_sum,
    round_to,
    weekly_sum,
)
from feedloom.operators.merge import upsert
from feedloom.operators.publish import ServedTable, current_table, publish
from feedloom.operators.quality import (
    FeedQualityError,
    Rule,
    bad_rows,
    quality_counts,
    quarantined,
    shares_above,
    split_valid,
    tag_errors,
    write_quarantine,
)
from feedloom.operators.sinks import land_snapshot
from feedloom.operators.states import StateTable, summary, update_states
from feedloom.operators.survivors import SurvivorStore
from feedloom.plans import marts, star
from feedloom.plans.changes import run_changes
from feedloom.plans.clean import store_feed, tagged_feed
from feedloom.plans.load import load_star
from feedloom.plans.pipeline import Paths
from feedloom.scratch import drop_path, hadoop_path, materialize, scratch_path
from feedloom.sources.feeds import MOVEMENTS, PRICES, STOCKS, FeedSpec, keep_facets, read_documents, unnest
from feedloom.sources.tables import date_range, read_optional
from feedloom.streaming.incremental import arrived_feed, merge_arrivals

log = logging.getLogger(__name__)

Query = Callable[[SparkSession, str], DataFrame]

# Amounts in the test tables have two decimals.
CENTS = 2
#: How the documents made from tables are landed. One task reads a compressed file, some 130 MB of text at most.
TEXT_CODEC = "snappy"
DOCUMENTS_PER_FILE = 250_000


def _day(column: str) -> Column:
    return F.col(column).cast("date")


_work_paths: dict[str, list[str]] = {}


def _work_path(spark: SparkSession, label: str) -> str:
    """A new shared folder for a query's own tables.

    The one before it stays, since a result that reads it may be in use; older ones are removed.
    """
    paths = _work_paths.setdefault(label, [])
    paths.append(scratch_path(spark, label))
    while len(paths) > 2:
        drop_path(spark, paths.pop(0))
    return paths[-1]


# Facts


def _weekly_fact(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    urgent = roles.order_prices(spark, sf_dir).filter(F.col("product").contains("URGENT"))
    stock = weekly_sum(roles.stock_lines(spark, sf_dir), "date", "quantity", "total_stock", ("area",), mode, CENTS)
    rows = join_on_week(roles.first_prices(urgent), F.broadcast(stock), "date", mode)
    return _with_returns(rows, spark, sf_dir).select(
        "date",
        "product",
        "area",
        round_to("price", 3).alias("price"),
        "total_stock",
        round_to("monthly_value", 2).alias("monthly_value"),
    )


def _with_returns(
    rows: DataFrame, spark: SparkSession, sf_dir: str, fill: float | None = 0.0, found: str | None = None
) -> DataFrame:
    returns = roles.movement_lines(spark, sf_dir)
    return add_monthly_total(rows, "date", returns, "date", "amount", "monthly_value", fill, found, CENTS)


def weekly_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly_fact(spark, sf_dir, "calendar")


def weekly_fact_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly_fact(spark, sf_dir, "iso")


def fact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names swapped for keys by looking them up in the dimensions."""
    fact = weekly_fact_iso(spark, sf_dir)
    products = named_dimension(
        "product", "product_category", PRIORITIES, "Routine", (table(spark, sf_dir, "orders"), "o_orderpriority")
    )
    areas = named_dimension("area", "area_type", AREAS, "Other", (roles.lines(spark, sf_dir), "l_linestatus"))
    keyed = lookup_key(fact, products, "product", "product_name", "product_id")
    return lookup_key(keyed, areas, "area", "area_name", "area_id").drop("product", "area")


def inner_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order meets its week's stock in every area; the sums are written so their size is known."""
    stock = weekly_sum(
        roles.lines(spark, sf_dir).withColumn("date", _day("l_shipdate")),
        "date",
        "l_quantity",
        "total_stock",
        by=("l_linestatus",),
        scale=CENTS,
    )
    stock = materialize(stock, _work_path(spark, "weekly-stock"))
    return join_on_week(roles.order_prices(spark, sf_dir), stock, "date")


def left_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_returns(roles.order_prices(spark, sf_dir), spark, sf_dir, found="has_macro")


def weekly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = roles.lines(spark, sf_dir).withColumn("date", _day("l_shipdate"))
    return weekly_sum(dated, "date", "l_quantity", "total_stock", by=("l_linestatus",), mode="calendar", scale=CENTS)


def monthly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = roles.lines(spark, sf_dir).withColumn("date", _day("l_shipdate"))
    sums = monthly_sum(dated, "date", "l_extendedprice", "monthly_value", by=("l_linestatus",), scale=CENTS)
    return sums.select(month_text(F.col("month_start")).alias("month"), "l_linestatus", "monthly_value")


# Dedup and top-N


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_latest(roles.lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], "l_shipdate")


def distinct_on_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    return keep_one(table(spark, sf_dir, "orders"), ["o_custkey"], order)


def latest_52(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()]
    return latest_n(table(spark, sf_dir, "orders"), 52, order)


def latest_104_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()]
    return latest_n_per_series(table(spark, sf_dir, "orders"), 104, ["o_orderpriority"], order)


def facet_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": ["F"]}
    return keep_facets(table(spark, sf_dir, "orders"), wanted)


# Quality

BALANCE_RULES = [Rule("Negative Balance", "c_acctbal >= 0")]


def quarantine_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_valid(table(spark, sf_dir, "customer"), BALANCE_RULES)[0]


def quarantine_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_valid(table(spark, sf_dir, "customer"), BALANCE_RULES)[1]


def quality_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_counts(tag_errors(table(spark, sf_dir, "customer"), BALANCE_RULES))


def quarantine_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares_above(tag_errors(table(spark, sf_dir, "customer"), BALANCE_RULES), ["c_nationkey"], 0.05)


def first_failed_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rules in order, one of them never decided (NULL) for unpriced lines."""
    lines = roles.lines(spark, sf_dir).withColumn(
        "unit_price", F.expr("CASE WHEN l_discount > 0 THEN l_extendedprice / l_quantity END")
    )
    rules = [
        Rule("Returned", "l_returnflag <> 'R'"),
        Rule("Small Lot", "l_quantity >= 10"),
        Rule("Cheap or Unpriced", "unit_price > 1000"),
    ]
    return bad_rows(tag_errors(lines, rules)).groupBy("error_reason").agg(F.count(F.lit(1)).alias("n_rows"))


def quarantine_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches over customers, the second of them run again after a repair: the bad rows of each and who saw them."""
    root = _work_path(spark, "quarantine-history")
    bad = bad_rows(tag_errors(table(spark, sf_dir, "customer"), BALANCE_RULES)).select("c_custkey", "c_acctbal", "error_reason")
    low, odd = F.col("c_acctbal") < -500, F.col("c_custkey") % 2 == 1
    for batch, rows in (("1", bad.filter(low)), ("2", bad), ("3", bad.filter(odd)), ("2", bad.filter(low))):
        write_quarantine(rows, root, batch)
    return quarantined(spark, root).drop("quarantined_at")


def rounded_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges with six decimals and credits below zero, summed exactly by day and rounded half up to three."""
    exact = [F.col(c).cast("decimal(12,2)") for c in ("l_extendedprice", "l_discount", "l_tax")]
    charge = exact[0] * (F.lit(1).cast("decimal(1,0)") - exact[1]) * (F.lit(1).cast("decimal(1,0)") + exact[2])
    signed = F.when(F.col("l_returnflag") == "R", -charge).otherwise(charge).cast("decimal(20,6)")
    rows = roles.lines(spark, sf_dir).select(_day("l_shipdate").alias("date"), "l_returnflag", signed.alias("charge"))
    summed = rows.groupBy("date", "l_returnflag").agg(F.sum("charge").cast("decimal(28,6)").alias("total"))
    return summed.select("date", "l_returnflag", round_to("total", 3).cast("double").alias("total"), round_to("total", -1).cast("double").alias("tens"))


# Parsing and documents


def typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers and dates written three ways each; only one is parsable."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    plain = F.col("l_extendedprice").cast("string")
    number = (
        F.when(flag == "A", F.format_number("l_extendedprice", 2))
        .when(flag == "R", F.concat(plain, F.lit(" USD")))
        .otherwise(plain)
    )
    day = F.when(status == "F", F.date_format("l_shipdate", "dd.MM.yyyy")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    return roles.lines(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        parse_number(number).alias("amount"),
        parse_day(day).alias("ship_day"),
    )


def _land(documents: DataFrame, path: str) -> None:
    """Documents of a few short records each, as text: repeated field names are most of it, so it is compressed."""
    land_snapshot(documents, path, "snapshot", fmt="text", rebalance=False, compression=TEXT_CODEC, rows_per_file=DOCUMENTS_PER_FILE)


def _landed(spark: SparkSession, label: str, spec: FeedSpec, documents: DataFrame) -> DataFrame:
    """Documents landed as files by snapshot and read back."""
    path = _work_path(spark, f"{label}-landed")
    _land(documents, path)
    return read_documents(spark, spec, path, multi_line=False, stamp="snapshot")


def explode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _landed(spark, "explode-nested", STOCKS, roles.stock_documents(spark, sf_dir))
    record = "record.`{}`".format
    return unnest(documents).select(
        parse_day(F.col(record("period"))).alias("date"),
        parse_number(F.col(record("value"))).alias("value"),
        F.col(record("product-name")).alias("product_name"),
        F.col(record("process-name")).alias("process_name"),
        F.col(record("area-name")).alias("area"),
        F.col("_snapshot").alias("snapshot"),
    )


def month_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM")
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_month(text).alias("month_date"))


def clean_price_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job, from landed files to silver and quarantine tables; both are returned.

    Its gates refuse a feed without a valid row, such as one in which a pending order is the newest of every key. There is no silver table
    then, and what the job has left in quarantine is all there is to return.
    """
    work = _work_path(spark, "clean-prices")
    tagged = tagged_feed(_landed(spark, "clean-prices", PRICES, roles.price_documents(spark, sf_dir)), PRICES)
    try:
        store_feed(spark, tagged, PRICES, f"{work}/silver", f"{work}/quarantine", batch_id="1")
    except FeedQualityError as refused:
        log.warning("%s", refused)
    kept = [*PRICES.columns, "error_reason"]
    silver = read_optional(spark, f"{work}/silver/{PRICES.name}")
    bad = quarantined(spark, f"{work}/quarantine/{PRICES.name}")
    found = spark.createDataFrame([], tagged.select(*kept).schema)
    if silver is not None:
        found = found.unionByName(silver.withColumn("error_reason", F.lit(None).cast("string")).select(*kept))
    return found if bad is None else found.unionByName(bad.select(*kept))


def incremental_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals: most snapshots, with a draft of that of 2000; older ones, written ten days ago; the final one of 2000."""
    work = _work_path(spark, "incremental")
    landed, store = f"{work}/landed", f"{work}/store"
    documents, year = roles.price_documents(spark, sf_dir), F.year("snapshot")
    draft = F.regexp_replace("document", '"product-name":"', '"product-name":"draft ')
    drafts = documents.filter(year == 2000).withColumn("document", draft)
    for rows in (documents.filter(year > 2000).unionByName(drafts), documents.filter(year < 2000), documents.filter(year == 2000)):
        _land(rows, landed)
        _age(spark, landed, "snapshot=19*/*")
        merge_arrivals(spark, PRICES, f"{landed}/*/*", store, multi_line=False, stamp="snapshot", base=landed)
    return arrived_feed(spark, PRICES, store).select(*PRICES.columns, "error_reason")


def _age(spark: SparkSession, folder: str, pattern: str) -> None:
    fs, path = hadoop_path(spark, f"{folder}/{pattern}")
    for status in fs.globStatus(path) or []:
        fs.setTimes(status.getPath(), 946_684_800_000, -1)


def clean_stock_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _landed(spark, "clean-stocks", STOCKS, roles.stock_documents(spark, sf_dir))
    return tagged_feed(documents, STOCKS).select(*STOCKS.columns, "error_reason")


def clean_movement_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _landed(spark, "clean-movements", MOVEMENTS, roles.movement_documents(spark, sf_dir))
    return tagged_feed(documents, MOVEMENTS).select(*MOVEMENTS.columns, "error_reason")


# Dimensions

PRIORITIES = [NameClass("Rush", contains=("URGENT", "HIGH")), NameClass("Standard", equals=("3-MEDIUM",))]
AREAS = [NameClass("Open", equals=("O",))]
PARTS = [
    NameClass("Fastener", contains=("bolt",)),
    NameClass("Turning", contains=("gear", "ring")),
    NameClass("Order Class", prefixes=("1-", "2-", "3-", "4-", "5-")),
]
PLACES = [NameClass("Continent", equals=("ASIA", "AFRICA", "EUROPE")), NameClass("Nation", prefixes=("NATION",))]


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = table(spark, sf_dir, "orders").select(_day("o_orderdate").alias("day"))
    shipped = roles.lines(spark, sf_dir).select(_day("l_shipdate").alias("day"))
    return date_dimension((ordered, "day"), (shipped, "day"))


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_dimension(
        "product",
        "product_category",
        PARTS,
        "Other",
        (table(spark, sf_dir, "part"), "p_name"),
        (table(spark, sf_dir, "orders"), "o_orderpriority"),
        (table(spark, sf_dir, "customer"), "c_mktsegment"),
    )


def dim_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named_dimension(
        "area",
        "area_type",
        PLACES,
        "Other",
        (table(spark, sf_dir, "nation"), "n_name"),
        (table(spark, sf_dir, "region"), "r_name"),
    )


def distinct_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), roles.lines(spark, sf_dir)
    return conform("member", (orders, "o_orderkey"), (lines, "l_orderkey"), (lines, "l_partkey"))


def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = conform(
        "name",
        (table(spark, sf_dir, "customer"), "c_name"),
        (table(spark, sf_dir, "supplier"), "s_name"),
        (table(spark, sf_dir, "part"), "p_name"),
    )
    return key_summary(names.withColumn("id", surrogate_key(F.col("name"))), "id", "name")


# Star


def _silver(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        roles.silver_prices(spark, sf_dir),
        roles.silver_stocks(spark, sf_dir),
        roles.silver_movements(spark, sf_dir),
    )


EXACT = star.StarOptions(value_scale=CENTS)


def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.market_fact(*_silver(spark, sf_dir), EXACT)


def gold_fact_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.market_fact(*_silver(spark, sf_dir), star.StarOptions(week_key="calendar", value_scale=CENTS))


def gold_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_date(roles.price_members(spark, sf_dir), roles.silver_stocks(spark, sf_dir))


def gold_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = roles.price_members(spark, sf_dir)
    return star.dim_product(prices, roles.silver_stocks(spark, sf_dir), roles.silver_movements(spark, sf_dir))


def gold_dim_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.dim_area(roles.silver_stocks(spark, sf_dir), roles.silver_movements(spark, sf_dir))


def star_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four tables are written and read back, as the job does, so each is computed once and its size is known."""
    work = _work_path(spark, "star")
    tables = {"fact": gold_fact, "date": gold_dim_date, "product": gold_dim_product, "area": gold_dim_area}
    built = {name: materialize(build(spark, sf_dir), f"{work}/{name}") for name, build in tables.items()}
    return marts.weekly_mart(
        built["fact"],
        built["date"],
        built["product"],
        built["area"],
        category="Distillate Fuel",
        scale=CENTS,
    )


# Loading


def _old_and_new_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").withColumn("order_day", _day("o_orderdate")).drop("o_orderdate")
    old = orders.filter(F.col("order_day") < F.lit("2000-01-01").cast("date"))
    new = orders.filter(F.col("order_day") >= F.lit("1999-01-01").cast("date"))
    return old, new.withColumn("o_totalprice", F.col("o_totalprice") + 1)


def upsert_insert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new_orders(spark, sf_dir)
    return upsert(old, new, ["o_orderkey"])


def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _old_and_new_orders(spark, sf_dir)
    return upsert(upsert(old, new, ["o_orderkey"]), new, ["o_orderkey"])


def publish_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three publishes of a table cut by year: everything, the new slice, the new slice again."""
    root = _work_path(spark, "serving")
    served = [ServedTable("orders", ("o_orderkey", "order_day"), period="year(order_day)")]
    old, new = _old_and_new_orders(spark, sf_dir)
    for staged in (old, new, new):
        publish(spark, root, {"orders": staged}, served)
    return current_table(spark, root, "orders")


def snapshot_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All load dates landed, then the later ones landed again with other prices."""
    path = _work_path(spark, "landing")
    day = F.trunc(_day("o_orderdate"), "year")
    snapshots = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", day.alias("load_date"))
    again = snapshots.filter(F.col("load_date") >= F.lit("1999-01-01").cast("date"))
    land_snapshot(snapshots, path)
    land_snapshot(again.withColumn("o_totalprice", F.col("o_totalprice") + 1), path)
    return spark.read.schema(snapshots.schema).parquet(path)


# Series


def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = date_range(table(spark, sf_dir, "orders"), "o_orderdate", "1998-01-01", "1998-03-31")
    return kept.select("o_orderkey", "o_orderdate", "o_totalprice")


def missing_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = roles.lines(spark, sf_dir).select("l_suppkey", _day("l_shipdate").alias("date"))
    return marts.missing_weeks(shipped, "date", ["l_suppkey"])


def lag_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = week_start(F.col("date")).alias("week_start")
    prices = roles.order_prices(spark, sf_dir).groupBy("product", week).agg(
        mean(F.col("price"), CENTS).alias("avg_price")
    )
    stock = roles.stock_lines(spark, sf_dir).groupBy(week).agg(total(F.col("quantity"), CENTS).alias("total_stock"))
    result = marts.lag_correlation(prices, "avg_price", stock, "total_stock", ["product"], (0, 1, 2))
    return result.withColumn("correlation", F.round("correlation", 6))


def mom_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = roles.lines(spark, sf_dir).select("l_suppkey", "l_extendedprice", _day("l_shipdate").alias("date"))
    return marts.month_over_month(shipped, "date", "l_extendedprice", ["l_suppkey"], CENTS)


def annual_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``level`` marks totals, so their NULL year and quarter are shown as 0."""
    rolled = marts.annual_rollup(roles.lines(spark, sf_dir), "l_shipdate", "l_quantity", CENTS)
    return rolled.fillna(0, ["year", "quarter"])


def season_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.season_profile(roles.lines(spark, sf_dir), "l_shipdate", "l_quantity", CENTS)


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of some days only, as in the oracle. No series loses a whole month by it."""
    d = F.col("date")
    thinned = (F.dayofmonth(d) % 3 == 0) | (F.month(d) % 2 == 0) | F.col("product").contains("URGENT")
    prices = roles.first_prices(roles.order_prices(spark, sf_dir)).filter(thinned)
    monthly = monthly_sum(roles.movement_lines(spark, sf_dir), "date", "amount", "monthly_value", scale=CENTS)
    return marts.latest_monthly(prices, "date", monthly, "monthly_value")


# What flows on from changes


def incremental_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job over changes, three times: drafts and a snapshot that is withdrawn again, a late and a final snapshot, the withdrawal."""
    work = _work_path(spark, "incremental-star")
    paths = Paths.under(work)
    documents = roles.market_documents(spark, sf_dir)
    landed = {feed: f"{paths.landed}/{feed}" for feed in documents}
    sources = {feed: (f"{path}/*/*", {"multi_line": False, "stamp": "snapshot", "base": path}) for feed, path in landed.items()}
    snapshot = F.col("snapshot")
    # Drafts have other values and other years than what replaces them.
    draft = F.regexp_replace("document", r'"period":"(\d\d\d)\d-(.*?)"value":', r'"period":"$17-$2"value":1')
    drafts = {feed: df.withColumn("document", draft) for feed, df in documents.items()}
    first = {
        feed: df.filter(snapshot == 2)
        .unionByName(drafts[feed].filter(snapshot == 3))
        .unionByName(drafts[feed].filter(snapshot == 1).withColumn("snapshot", snapshot + 8))
        for feed, df in documents.items()
    }
    later = {feed: df.filter(snapshot != 2) for feed, df in documents.items()}
    for arrival in (first, later):
        for feed, df in arrival.items():
            _land(df, landed[feed])
        run_changes(spark, paths, "1", sources)
    for path in landed.values():
        drop_path(spark, f"{path}/snapshot=9")
    run_changes(spark, paths, "2", sources)
    return current_table(spark, f"{paths.changes}/gold", star.FACT)


def served_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tables built into the star and loaded twice; the fact as it is served, its price a decimal."""
    paths = Paths.under(_work_path(spark, "served-fact"))
    for spec, df in zip((PRICES, STOCKS, MOVEMENTS), _silver(spark, sf_dir)):
        materialize(df, f"{paths.silver}/{spec.name}")
    star.build_star(spark, paths.silver, paths.gold, EXACT)
    for _ in range(2):
        load_star(spark, paths.gold, paths.serving)
    return current_table(spark, paths.serving, star.FACT).withColumn("price_usd_per_gal", F.col("price_usd_per_gal").cast("double"))


def wide_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cents times powers of two, from less than 1e-6 to more than 1e15 and of both signs, summed exactly by supplier."""
    power = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 65 - 37
    cents = F.rint(F.col("l_extendedprice") * 100) * F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    rows = roles.lines(spark, sf_dir).select("l_suppkey", (cents * F.pow(F.lit(2.0), power)).alias("value"))
    return exact_sum(rows, ["l_suppkey"], "value", "total", "n_values")


def state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly states by supplier: most lines with drafts of some, then late lines, then the drafts withdrawn for the final ones."""
    root = _work_path(spark, "states")
    shipped = StateTable("shipped", ("month", "l_suppkey"), "l_extendedprice", period="year(month)", extremes=True)
    lines = roles.lines(spark, sf_dir).withColumn("month", F.trunc("l_shipdate", "month")).select("month", "l_suppkey", "l_extendedprice", "l_linenumber")
    number = F.col("l_linenumber")
    drafts = lines.filter(number == 5).withColumn("l_extendedprice", F.col("l_extendedprice") * 1e9)
    update_states(spark, root, shipped, added=lines.filter(number < 5).unionByName(drafts))
    update_states(spark, root, shipped, added=lines.filter(number > 5))
    update_states(spark, root, shipped, added=lines.filter(number == 5), withdrawn=drafts)
    rows = summary(spark, root, shipped)
    cents = F.round("total", 2)
    return rows.withColumns({"total": cents, "mean": cents / F.col("n_values")})


def quarantine_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of ``quarantine_history`` as segments of events, merged before and after the repair."""
    root = _work_path(spark, "quarantine-segments")
    bad = bad_rows(tag_errors(table(spark, sf_dir, "customer"), BALANCE_RULES)).select("c_custkey", "c_acctbal", "error_reason")
    low, odd = F.col("c_acctbal") < -500, F.col("c_custkey") % 2 == 1
    for batch, rows in (("1", bad.filter(low)), ("2", bad), ("3", bad.filter(odd))):
        segments.write_batch(spark, root, batch, rows)
    segments.merge_segments(spark, root)
    segments.write_batch(spark, root, "2", bad.filter(low))
    segments.merge_segments(spark, root)
    return segments.history(spark, root).drop("quarantined_at")


def carry_by_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the latest monthly total of its own customer's delivered orders, most months having none."""
    orders = table(spark, sf_dir, "orders").withColumn("date", _day("o_orderdate"))
    monthly = monthly_sum(orders.filter("o_orderstatus = 'F'"), "date", "o_totalprice", "monthly_value", by=("o_custkey",), scale=CENTS)
    prices = orders.select("o_orderkey", "o_custkey", "date", F.col("o_totalprice").alias("price"))
    return as_of(prices, monthly, ["o_custkey"], "date", "month_start", ["monthly_value"], unit="year", matched="of_month")


def clustered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders clustered by date and customer in folders by year; then one quarter of a third of the customers."""
    root = _work_path(spark, "clustered")
    orders = table(spark, sf_dir, "orders").withColumn("date", _day("o_orderdate")).select("date", "o_custkey", "o_orderkey", "o_totalprice")
    columns = ["date", "o_custkey"]
    write_clustered(orders, root, columns, F.year("date"), rows_per_file=500)
    most = orders.agg(F.max("o_custkey")).first()[0]
    day = datetime.date
    return scan_clustered(spark, root, columns, {"date": Between(day(1998, 4, 1), day(1998, 6, 30)), "o_custkey": Between(high=most // 3)})


def registry_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of customers, parts and suppliers registered in three batches under a hash of 12 bits, so that many collide."""
    root = _work_path(spark, "registry")
    for name in ("part", "customer", "supplier"):
        registry.register(spark, root, table(spark, sf_dir, name).select(f"{name[0]}_name"), bits=12, buckets=8)
    return registry.registered(spark, root)


def survivor_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest order of each customer and priority, kept in a store over three turns: five files of orders arrive, one is withdrawn and one
    replaced by what is settled of it, at other prices."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate", "o_totalprice")
    file = F.col("o_orderkey") % 5
    path = _work_path(spark, "survivors")
    store = SurvivorStore(spark, path, orders.schema, ["o_custkey", "o_orderpriority"], "o_orderdate", buckets=8)
    store.add(orders.filter(file.isin(0, 1, 2)), file.cast("string"), 1)
    store.withdraw(spark.createDataFrame([("1",)], "file string"), 2)
    store.add(orders.filter(file == 3), file.cast("string"), 2)
    store.withdraw(spark.createDataFrame([("0",)], "file string"), 3)
    settled = orders.filter((file == 0) & (F.col("o_orderstatus") == "F")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    store.add(settled.unionByName(orders.filter(file == 4)), file.cast("string"), 3)
    return store.survivors()


QUERIES: dict[str, Query] = {
    "survivor_store": survivor_store,
    "incremental_star": incremental_star,
    "served_fact": served_fact,
    "wide_sums": wide_sums,
    "state_totals": state_totals,
    "quarantine_segments": quarantine_segments,
    "carry_by_series": carry_by_series,
    "registry_keys": registry_keys,
    "clustered_scan": clustered_scan,
    "weekly_fact": weekly_fact,
    "weekly_fact_iso": weekly_fact_iso,
    "fact_keys": fact_keys,
    "inner_week": inner_week,
    "left_fill": left_fill,
    "weekly_sum": weekly_totals,
    "monthly_sum": monthly_totals,
    "dedup_latest": dedup_latest,
    "distinct_on_key": distinct_on_key,
    "latest_n": latest_52,
    "latest_n_per_series": latest_104_per_series,
    "facet_filter": facet_filter,
    "quarantine_valid": quarantine_valid,
    "quarantine_bad": quarantine_bad,
    "quality_counts": quality_counts_query,
    "quarantine_share": quarantine_share,
    "first_failed_rule": first_failed_rule,
    "quarantine_history": quarantine_history,
    "rounded_fact": rounded_fact,
    "typed_parse": typed_parse,
    "explode_nested": explode_nested,
    "month_date": month_date,
    "clean_price_feed": clean_price_feed,
    "incremental_clean": incremental_clean,
    "clean_stock_feed": clean_stock_feed,
    "clean_movement_feed": clean_movement_feed,
    "dim_date": dim_date,
    "dim_product": dim_product,
    "dim_area": dim_area,
    "distinct_members": distinct_members,
    "key_collisions": key_collisions,
    "gold_fact": gold_fact,
    "gold_fact_calendar": gold_fact_calendar,
    "gold_dim_date": gold_dim_date,
    "gold_dim_product": gold_dim_product,
    "gold_dim_area": gold_dim_area,
    "star_mart": star_mart,
    "upsert_insert_update": upsert_insert_update,
    "upsert_idempotent": upsert_idempotent,
    "publish_upsert": publish_upsert,
    "snapshot_landing": snapshot_landing,
    "range_scan": range_scan,
    "missing_weeks": missing_weeks,
    "lag_corr": lag_corr,
    "mom_change": mom_change,
    "annual_rollup": annual_rollup,
    "season_dow": season_dow,
    "carry_forward": carry_forward,
}
