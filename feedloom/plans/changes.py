"""A run that costs what has changed: the periods that new, late, replaced and withdrawn snapshots touch flow on, and nothing else is read.

Each layer is a set of tables cut by year and published under one pointer, and each remembers, in the same publish, the version of the
layer before it that it was made from. Comparing that layer's pointer then and now names the periods to read, so a run that
dies anywhere is taken up by the next one where it stopped, and nothing is applied twice.

    arrivals/<feed>         shaped rows of every present snapshot
      -> changes/<feed>     valid rows, bad rows and counts of the years touched
      -> changes/gold       weekly and monthly sum states, member counts, dimensions, fact
      -> serving            the fact's years touched and the dimensions that differ, upserted

Sums are states that merge (``operators.states``): of a changed year its new rows are added and its old ones withdrawn, and no other year
is read. A week that two years share, or a price of one year that meets a sum of another, makes both years' fact rows new. A member is in a dimension
while some row names it. Bad rows are kept as events: found by a batch, gone in a later one (``operators.segments``).

The outcome equals that of the batch job with exact sums over the same files.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.calendar import MONTH_KEY, WEEK_KEY, date_attributes, month_start, with_week_key
from feedloom.functions.exact_sums import totals
from feedloom.operators.dims import named_dimension, require_unique_keys
from feedloom.operators.facts import EXACT
from feedloom.operators.publish import PERIOD, WHOLE, changed_since, current_table, publish, read_periods, read_periods_at, replace_periods
from feedloom.operators.quality import bad_rows, quality_counts, require_rows, require_survivors, valid_rows
from feedloom.operators.segments import KEY, record_events, reject_key
from feedloom.operators.states import StateChange, StateTable, state_change
from feedloom.plans import star
from feedloom.plans.clean import CleanCounts, rejected
from feedloom.plans.load import SERVED, as_served
from feedloom.scratch import at_once, drop_path, materialize, scratch_path
from feedloom.sources.feeds import MOVEMENTS, PRICES, STOCKS, FeedSpec
from feedloom.streaming.incremental import judged_arrivals, merge_arrivals

ROWS, BAD, COUNTS, APPLIED = "rows", "bad", "counts", "applied"
WEEKLY = StateTable("weekly_stocks", (*WEEK_KEY, "area"), "volume_k_barrels", period="week_year")
MONTHLY = StateTable("monthly_flows", (MONTH_KEY,), "volume_k_barrels_per_day", period=f"year({MONTH_KEY})")
MEMBERS = "members"
#: Where each dimension's members come from: (feed, column).
SOURCES: Mapping[str, list[tuple[str, str]]] = {
    star.DIM_DATE: [(PRICES.name, "date"), (STOCKS.name, "date")],
    star.DIM_PRODUCT: [(s.name, "product_name") for s in (PRICES, STOCKS, MOVEMENTS)],
    star.DIM_AREA: [(STOCKS.name, "area"), (MOVEMENTS.name, "country_code")],
}
NAMED = {
    star.DIM_PRODUCT: ("product", "product_category", star.PRODUCT_CLASSES, star.PRODUCT_OTHERWISE),
    star.DIM_AREA: ("area", "area_type", star.AREA_CLASSES, star.AREA_OTHERWISE),
}
FEEDS = (PRICES, STOCKS, MOVEMENTS)


def applied_versions(spark: SparkSession, root: str) -> dict[str, int]:
    """The version of each source that the tables under ``root`` were made from; 0 for none. One row per source."""
    rows = current_table(spark, root, APPLIED)
    return {} if rows is None else {r["source"]: r["as_of"] for r in rows.collect()}


def applied(spark: SparkSession, versions: Mapping[str, int]) -> tuple[DataFrame, list[str]]:
    rows = spark.createDataFrame(list(versions.items()), "source string, as_of long")
    return rows.withColumn(PERIOD, F.lit(WHOLE)), [WHOLE]


def clean_changes(
    spark: SparkSession, spec: FeedSpec, arrivals: str, root: str, quarantine: str, batch_id: str
) -> CleanCounts:
    """Bring a feed's valid rows, bad rows and counts up to what has arrived; counts are those of the whole feed.

    A look-back depends on every date of a series, so a feed that has one is redone whole.
    """
    since = applied_versions(spark, root).get(ARRIVED, 0)
    version, touched = changed_since(spark, arrivals, spec.name, since)
    if touched and spec.latest is not None:
        touched = sorted({*touched, *all_periods(spark, arrivals, spec.name)})
    if not touched:
        return passed(feed_counts(spark, root), spec)
    base, _ = read_periods(spark, root, ROWS, [])
    work = scratch_path(spark, f"changes-{spec.name}")
    try:
        _, arrived = read_periods(spark, arrivals, spec.name, touched)
        if arrived is None:
            # Every row of these years is gone.
            arrived = read_periods(spark, arrivals, spec.name, all_periods(spark, arrivals, spec.name)[:1])[1]
            require_rows(arrived is not None, spec.name)
            arrived = arrived.limit(0)
        year = F.coalesce(F.year(F.col(f"`{spec.date}`")), F.lit(0)).cast("string")
        tagged = materialize(judged_arrivals(arrived.drop(PERIOD), spec).withColumn(PERIOD, year), f"{work}/tagged")
        good = valid_rows(tagged).select(*spec.columns, PERIOD).hint("rebalance", PERIOD).sortWithinPartitions(PERIOD, spec.date)
        bad = rejected(bad_rows(tagged), spec, PERIOD).distinct()
        bad = materialize(bad.withColumn(KEY, reject_key(bad.drop(PERIOD))), f"{work}/bad")
        counts = materialize(quality_counts(tagged, [PERIOD]).drop("bad_share"), f"{work}/counts")
        _, old_bad = read_periods(spark, root, BAD, touched)
        if old_bad is None:
            record_events(spark, quarantine, batch_id, bad.drop(PERIOD))
        else:
            found = bad.join(old_bad.select(KEY), KEY, "left_anti").drop(PERIOD)
            gone = old_bad.join(bad.select(KEY), KEY, "left_anti").drop(PERIOD)
            record_events(spark, quarantine, batch_id, found, gone)
        _, others = read_periods(spark, root, COUNTS, [p for p in all_periods(spark, root, COUNTS) if p not in touched])
        n = passed(sum_counts([c for c in (counts, others) if c is not None]), spec)
        tables = {ROWS: (good, touched), BAD: (bad, touched), COUNTS: (counts, touched), APPLIED: applied(spark, {ARRIVED: version})}
        replace_periods(spark, root, tables, base)
        return n
    finally:
        drop_path(spark, work)


def passed(n: CleanCounts, spec: FeedSpec) -> CleanCounts:
    """The gates, over the whole feed."""
    require_rows(n.total, spec.name)
    require_survivors(n.valid, spec.name)
    return n


ARRIVED = "arrivals"


def all_periods(spark: SparkSession, root: str, table: str) -> list[str]:
    return changed_since(spark, root, table, -1)[1]


def sum_counts(tables: list[DataFrame]) -> CleanCounts:
    total = valid = bad = 0
    for table in tables:
        n = table.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("total_rows", "valid_rows", "bad_rows")]).first()
        total, valid, bad = total + n[0], valid + n[1], bad + n[2]
    return CleanCounts(total, valid, bad)


def feed_counts(spark: SparkSession, root: str) -> CleanCounts:
    counts = current_table(spark, root, COUNTS)
    return CleanCounts(0, 0, 0) if counts is None else sum_counts([counts])


@dataclass(frozen=True)
class FeedChange:
    """The years of a feed that changed, with their rows before and after."""

    version: int
    years: list[str]
    old: DataFrame | None
    new: DataFrame | None


def applied_to(df: DataFrame | None, step: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    return None if df is None else step(df)


def feed_change(spark: SparkSession, root: str, since: int) -> FeedChange:
    version, years = changed_since(spark, root, ROWS, since)
    old = read_periods_at(spark, root, ROWS, since, years) if years else None
    new = read_periods(spark, root, ROWS, years)[1] if years else None
    return FeedChange(version, years, *[None if df is None else df.drop(PERIOD) for df in (old, new)])


def gold_changes(spark: SparkSession, feeds: Mapping[str, str], root: str, options: star.StarOptions) -> None:
    """Bring states, members, dimensions and fact up to the feeds, in one publish."""
    since = applied_versions(spark, root)
    base, _ = read_periods(spark, root, star.FACT, [])
    read = at_once([lambda n=name, p=path: feed_change(spark, p, since.get(n, 0)) for name, path in feeds.items()])
    change = dict(zip(feeds, read))
    if not any(c.years for c in change.values()):
        return
    work = scratch_path(spark, "changes-gold")
    try:
        stocks, flows, prices = change[STOCKS.name], change[MOVEMENTS.name], change[PRICES.name]

        def weekly_rows(df: DataFrame) -> DataFrame:
            return with_week_key(star.market_stocks(df), "date", options.week_key)

        def monthly_rows(df: DataFrame) -> DataFrame:
            return star.market_flows(df).withColumn(MONTH_KEY, month_start(F.col("month_date")))

        weekly, monthly, *dims = at_once(
            [
                lambda: state_change(spark, root, WEEKLY, applied_to(stocks.new, weekly_rows), applied_to(stocks.old, weekly_rows), work),
                lambda: state_change(spark, root, MONTHLY, applied_to(flows.new, monthly_rows), applied_to(flows.old, monthly_rows), work),
                *[lambda d=dim: member_changes(spark, root, d, change, options, work) for dim in SOURCES],
            ]
        )
        years = sorted({*prices.years, *years_of_weeks(weekly, options.week_key), *years_of_months(monthly)} - {"0"})
        changes = reduce(operator.or_, [weekly.tables, monthly.tables, *dims])
        if years:
            changes[star.FACT] = (fact_rows(spark, feeds[PRICES.name], root, years, weekly, monthly, options), years)
        changes[APPLIED] = applied(spark, {name: c.version for name, c in change.items()})
        replace_periods(spark, root, changes, base)
    finally:
        drop_path(spark, work)


def years_of_weeks(change: StateChange, week_key: str) -> set[str]:
    """The calendar years of the days of the weeks that changed. The calendar bounds what is collected."""
    if change.groups is None:
        return set()
    if week_key != "iso":
        return set(change.touched)
    monday = F.expr("date_add(trunc(make_date(week_year, 1, 4), 'week'), 7 * (week_no - 1))")
    years = F.explode(F.array(F.year(monday), F.year(F.date_add(monday, 6))))
    return {str(r[0]) for r in change.groups.select(years).distinct().collect()}


def years_of_months(change: StateChange) -> set[str]:
    return set(change.touched)


def fact_rows(
    spark: SparkSession, prices: str, root: str, years: list[str], weekly: StateChange, monthly: StateChange, options: star.StarOptions
) -> DataFrame:
    """The fact's rows of some years, from these years' prices and the states of the weeks and months that they meet."""
    _, price = read_periods(spark, prices, ROWS, years)
    if price is None:
        _, price = read_periods(spark, prices, ROWS, all_periods(spark, prices, ROWS)[:1])
        price = price.limit(0)
    near = sorted({str(int(y) + d) for y in years for d in (-1, 0, 1)})
    stock = totals(current_states(spark, root, WEEKLY, weekly, near), WEEKLY.by, star.STOCK_TOTAL)
    flow = totals(current_states(spark, root, MONTHLY, monthly, years), MONTHLY.by, star.FLOW_TOTAL)
    fact = star.assemble_fact(star.market_prices(price.drop(PERIOD)), stock, flow, options)
    return fact.withColumn(PERIOD, F.year("date").cast("string"))


def current_states(spark: SparkSession, root: str, table: StateTable, change: StateChange, periods: list[str]) -> DataFrame:
    """States of some periods: the new ones where they changed, the published ones elsewhere."""
    new = change.tables[table.name][0] if change.tables else None
    _, old = read_periods(spark, root, table.name, [p for p in periods if p not in change.touched])
    parts = [df for df in (new, old) if df is not None]
    if not parts:
        none = {"week_year": "int", "week_no": "int", "area": "string", MONTH_KEY: "date"}
        fields = ", ".join(f"{c} {none[c]}" for c in table.by)
        limbs = ", ".join(f"_limb{i} decimal(38,0)" for i in range(3))
        return spark.createDataFrame([], f"{fields}, _bin int, _n long, {limbs}")
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return both.filter(F.col(PERIOD).isin(periods)).drop(PERIOD)


def member_changes(
    spark: SparkSession, root: str, dim: str, change: Mapping[str, FeedChange], options: star.StarOptions, work: str
) -> dict[str, tuple[DataFrame, list[str]]]:
    """A dimension, if its members changed, with how many rows name each member.

    Dates are cut by year; products and areas are one table each, bounded by their catalogs.
    """
    parts = []
    for feed, column in SOURCES[dim]:
        for df, sign in ((change[feed].new, 1), (change[feed].old, -1)):
            if df is not None:
                parts.append(df.groupBy(F.col(f"`{column}`").alias("member")).agg((F.count("*") * sign).alias("n")))
    if not parts:
        return {}
    period = F.coalesce(F.year("member").cast("string"), F.lit("0")) if dim == star.DIM_DATE else F.lit(WHOLE)
    delta = reduce(DataFrame.unionByName, parts).groupBy("member").agg(F.sum("n").alias("n")).filter("n <> 0")
    delta = materialize(delta.withColumn(PERIOD, period), f"{work}/{dim}-delta")
    touched = sorted(r[0] for r in delta.select(PERIOD).distinct().collect())
    if not touched:
        return {}
    counts = f"{dim}_{MEMBERS}"
    _, old = read_periods(spark, root, counts, touched)
    both = delta if old is None else delta.unionByName(old)
    members = materialize(both.groupBy("member", PERIOD).agg(F.sum("n").alias("n")).filter("n <> 0"), f"{work}/{counts}")
    if dim == star.DIM_DATE:
        attributes = date_attributes(F.col("date"))
        built = members.select(F.col("member").alias("date"), PERIOD).withColumns(attributes).select("date", *attributes, PERIOD)
        return {counts: (members, touched), dim: (built, touched)}
    prefix, *classes = NAMED[dim]
    built = named_dimension(prefix, *classes, (members, "member"), key_method=options.key_method)
    built = materialize(built.withColumn(PERIOD, F.lit(WHOLE)), f"{work}/{dim}")
    require_unique_keys(built, f"{prefix}_id", f"{prefix}_name")
    return {counts: (members, touched), dim: (built, touched)}


def serve_changes(spark: SparkSession, gold: str, serving: str) -> None:
    """Upsert what changed in gold. An upsert repeated changes nothing, so the version is noted after it."""
    since = applied_versions(spark, serving).get("gold", 0)
    staged, version = {}, 0
    for table in SERVED:
        version, periods = changed_since(spark, gold, table.name, since)
        _, rows = read_periods(spark, gold, table.name, periods)
        if rows is not None:
            staged[table.name] = as_served(rows.drop(PERIOD), table)
    if version == since:
        return
    if staged:
        publish(spark, serving, staged, SERVED)
    base, _ = read_periods(spark, serving, APPLIED, [])
    replace_periods(spark, serving, {APPLIED: applied(spark, {"gold": version})}, base)


def run_changes(
    spark: SparkSession, paths, batch_id: str, sources: Mapping[str, tuple[str, dict]], options: star.StarOptions = star.StarOptions()
) -> dict[str, CleanCounts]:
    """Take in what changed at each feed's source and carry it to serving. ``sources`` are a path and how to read it, by feed."""
    options = replace(options, value_scale=EXACT)

    def clean(spec: FeedSpec) -> CleanCounts:
        source, form = sources[spec.name]
        arrivals = f"{paths.arrivals}/{spec.name}"
        merge_arrivals(spark, spec, source, arrivals, **form)
        return clean_changes(spark, spec, arrivals, f"{paths.changes}/{spec.name}", f"{paths.quarantine}_events/{spec.name}", batch_id)

    counts = at_once([lambda s=spec: clean(s) for spec in FEEDS])
    feeds = {spec.name: f"{paths.changes}/{spec.name}" for spec in FEEDS}
    gold_changes(spark, feeds, f"{paths.changes}/gold", options)
    serve_changes(spark, f"{paths.changes}/gold", paths.serving)
    return dict(zip(feeds, counts))
