"""Stored aggregate states: sums, counts and extremes per group that late and withdrawn rows change without old detail being read.

A table of states is cut into periods that are a function of its grouping columns. An update aggregates the rows that came and those
that went, merges the result with the stored states of the periods it touches, and publishes those periods; the pointer carries
the others over. Sums are the exact states of ``functions.exact_sums``, so that what is withdrawn leaves nothing behind. Extremes cannot be
taken back from a minimum; they are read from a table of distinct values with their counts, updated in the same way and published with the sums.

Coarser groups come from the states alone, by merging them: quarters and years from months, a category from its products.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.exact_sums import BIN, COUNT, LIMBS, merged, sum_states, totals, without_empty
from feedloom.operators.publish import PERIOD, current_table, drop_attempt, new_attempt, read_periods, replace_periods, write_periods
from feedloom.scratch import drop_path, materialize, scratch_path

VALUE = "_value"


class WithdrawnTwiceError(ValueError):
    """More rows of a group were withdrawn than had been added."""


@dataclass(frozen=True)
class StateTable:
    """``period`` is SQL over the columns ``by``, such as ``year(month)``; the calendar must bound its values."""

    name: str
    by: Sequence[str]
    value: str
    period: str
    extremes: bool = False

    @property
    def values_name(self) -> str:
        return f"{self.name}_values"

    def of_period(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PERIOD, F.expr(self.period).cast("string"))


def _signed(added: DataFrame | None, withdrawn: DataFrame | None, table: StateTable) -> DataFrame:
    """The rows that came and went with their sign, so that one aggregate takes both."""
    value = F.col(f"`{table.value}`").cast("double").alias(VALUE)
    parts = [(df, sign) for df, sign in ((added, 1), (withdrawn, -1)) if df is not None]
    signed = [df.select(*table.by, value, F.lit(sign).cast("bigint").alias(COUNT)) for df, sign in parts]
    return signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1])


@dataclass(frozen=True)
class StateChange:
    """What ``replace_periods`` is to write, the periods read for it, and the groups that changed."""

    tables: dict[str, tuple[DataFrame, list[str]]]
    touched: list[str]
    groups: DataFrame | None


def update_states(
    spark: SparkSession, root: str, table: StateTable, added: DataFrame | None = None, withdrawn: DataFrame | None = None
) -> list[str]:
    """Apply the rows that came and went; the periods that were rewritten, which are all that is read."""
    work = scratch_path(spark, f"states-{table.name}")
    try:
        version, _ = read_periods(spark, root, table.name, [])
        attempt = new_attempt(version)
        try:
            change = state_change(spark, root, table, added, withdrawn, work, attempt)
        except Exception:
            drop_attempt(spark, root, [table.name, table.values_name], attempt)
            raise
        if change.touched:
            replace_periods(spark, root, change.tables, version, attempt)
        return change.touched
    finally:
        drop_path(spark, work)


def state_change(
    spark: SparkSession,
    root: str,
    table: StateTable,
    added: DataFrame | None,
    withdrawn: DataFrame | None,
    work: str,
    attempt: str | None = None,
) -> StateChange:
    """The new states of the periods touched, not yet published: written under ``work``, or for the publish ``attempt``."""
    if added is None and withdrawn is None:
        return StateChange({}, [], None)

    def stored(name: str, rows: DataFrame) -> DataFrame:
        return materialize(rows, f"{work}/{name}") if attempt is None else write_periods(root, name, rows, attempt)

    rows = _signed(added, withdrawn, table)
    change = materialize(table.of_period(without_empty(sum_states(rows, table.by, VALUE, sign=COUNT))), f"{work}/{table.name}-change")
    touched = sorted(r[0] for r in change.select(PERIOD).distinct().collect())
    if not touched:
        return StateChange({}, [], None)
    by = [*table.by, PERIOD]
    _, old = read_periods(spark, root, table.name, touched)
    new = stored(table.name, change if old is None else without_empty(merged(change.unionByName(old), by)))
    _refuse_negative(new, table)
    tables = {table.name: (new, touched)}
    if table.extremes:
        values = table.of_period(rows).select(*by, VALUE, COUNT)
        _, old = read_periods(spark, root, table.values_name, touched)
        both = values if old is None else values.unionByName(old)
        counts = both.groupBy(*by, VALUE).agg(F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) != 0)
        counts = stored(table.values_name, counts)
        _refuse_negative(counts, table)
        # A value withdrawn and another one added may leave the sum as it was, in a period that the sums do not name.
        tables[table.values_name] = (counts, touched)
    return StateChange(tables, touched, change.select(*table.by).distinct())


def _refuse_negative(states: DataFrame, table: StateTable) -> None:
    found = states.filter(F.col(COUNT) < 0).select(*table.by).first()
    if found:
        raise WithdrawnTwiceError(f"{table.name}: more rows withdrawn than added for {found.asDict()}")


def read_states(spark: SparkSession, root: str, table: StateTable, periods: Sequence[str] | None = None) -> DataFrame | None:
    """The stored sum states, of some periods or all of them."""
    if periods is None:
        return current_table(spark, root, table.name)
    _, states = read_periods(spark, root, table.name, list(periods))
    return None if states is None else states.drop(PERIOD)


def coarser(states: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    """States of larger groups, each named column computed from the smaller groups' columns."""
    kept = [BIN, COUNT, *LIMBS]
    return merged(states.select(*[c.alias(name) for name, c in by.items()], *kept), list(by))


def summary(
    spark: SparkSession, root: str, table: StateTable, total: str = "total", periods: Sequence[str] | None = None
) -> DataFrame | None:
    """Per group the number of values, their total and mean and, where they are kept, the least and the greatest value."""
    states = read_states(spark, root, table, periods)
    if states is None:
        return None
    rows = with_mean(totals(states, table.by, total, "n_values"), total)
    if not table.extremes:
        return rows
    if periods is None:
        values = current_table(spark, root, table.values_name)
    else:
        values = read_periods(spark, root, table.values_name, list(periods))[1]
    ends = values.groupBy(*table.by).agg(F.min(VALUE).alias("least"), F.max(VALUE).alias("greatest"))
    renamed = ends.select(*[F.col(f"`{c}`").alias(f"_of_{c}") for c in table.by], "least", "greatest")
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`")) for c in table.by]
    return rows.join(renamed, same, "left").select(*rows.columns, "least", "greatest")


def with_mean(rows: DataFrame, total: str, count: str = "n_values") -> DataFrame:
    return rows.withColumn("mean", F.try_divide(F.col(total), F.col(count)))
