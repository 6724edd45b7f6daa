"""Exact sums of any doubles, as states that can be stored, merged and taken back.

Every finite double is a whole number of 2**-1074. It is cut into three limbs of 32 bits, and the position of the lowest one is its
*bin*. A state has one row per group and bin, at most 66 of them, with the limbs' sums as decimals. Sums of whole numbers do not
depend on any order, a state merges with another by adding, and a row is withdrawn by adding its negated state: nothing is left of it, however large it was. Only when a
total is asked for are the limbs carried into one number, which is rounded once, to the nearest double and in a tie to the
even one. So a total is that of the true sum, with small values among huge ones and with any cancellation.

NaN and infinities are counted in bins of their own: a total is NaN with a NaN or with both infinities in it. A total without any
value is NULL. A finite sum beyond the largest double is infinite, as a double must be.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BIN = "_bin"
COUNT = "_n"
LIMBS = ["_limb0", "_limb1", "_limb2"]
# Bins of what is no finite number; NONE counts NULLs, so that a group without any value is not lost.
NONE, NAN, INFINITE, MINUS_INFINITE = -4, -3, -2, -1
#: Positions above the highest bin: its two other limbs and room for the carries of 2**90 rows.
ABOVE = 5
BASE = 1 << 32
LOWEST = 1074


def sum_states(df: DataFrame, by: Sequence[str], value: str, sign: str | None = None) -> DataFrame:
    """``by``, bin, number of rows and limb sums. Partial sums are made before the shuffle.

    ``sign`` names a bigint column that is 1 for rows to add and -1 for rows to withdraw.
    """
    counted = F.lit(1).cast("bigint") if sign is None else F.col(f"`{sign}`")
    x = F.col(f"`{value}`").cast("double")
    size = F.abs(x)
    # log2 may be off by a little at powers of two; one bit less makes the lowest bit a whole number all the same.
    bin_ = F.floor((F.floor(F.log2(size)) + F.lit(LOWEST - 53)) / 32)
    found = (
        F.when(x.isNull(), NONE)
        .when(F.isnan(x), NAN)
        .when(x == float("inf"), INFINITE)
        .when(x == float("-inf"), MINUS_INFINITE)
        .when(x == 0, 0)
        .otherwise(F.greatest(bin_, F.lit(0)))
        .cast("int")
    )
    binned = df.select(*[F.col(f"`{c}`") for c in by], x.alias("_x"), found.alias(BIN), counted.alias(COUNT))
    # Powers of two by halves, since 2**1074 is no double; multiplying by them is exact.
    power = F.lit(LOWEST) - 32 * F.col(BIN)
    half = F.floor(power / 2)
    finite = F.when(F.col(BIN) >= 0, F.abs("_x")).otherwise(0.0)
    scaled = finite * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)
    scaled = binned.select(*binned.columns, F.when(F.col(BIN) >= 0, scaled).otherwise(0.0).alias("_q"))
    rest = F.col("_q") - F.floor(F.col("_q") / 2.0**64) * F.lit(2.0**64)
    sign = F.when(F.col("_x") < 0, -F.col(COUNT)).otherwise(F.col(COUNT))
    parts = (rest - F.floor(rest / 2.0**32) * F.lit(2.0**32), F.floor(rest / 2.0**32), F.floor(F.col("_q") / 2.0**64))
    limbs = {name: (F.floor(part).cast("bigint") * sign).cast("decimal(18,0)") for name, part in zip(LIMBS, parts)}
    return merged(scaled.withColumns(limbs), by)


def merged(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group and bin again, of several states put together by ``unionByName``."""
    sums = [F.sum(limb).cast("decimal(38,0)").alias(limb) for limb in LIMBS]
    return states.groupBy(*[F.col(f"`{c}`") for c in by], BIN).agg(F.sum(COUNT).alias(COUNT), *sums)


def negated(states: DataFrame) -> DataFrame:
    """What withdraws these states when it is merged."""
    return states.withColumns({c: -F.col(c) for c in (COUNT, *LIMBS)})


def without_empty(states: DataFrame) -> DataFrame:
    """Without bins of which everything has been withdrawn. A group of which nothing is left goes with its last bin."""
    return states.filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in (COUNT, *LIMBS)]))


def totals(states: DataFrame, by: Sequence[str], out: str, count: str | None = None) -> DataFrame:
    """``by`` with the rounded total and, if asked for, the number of values summed. ``states`` has one row per group and bin."""
    limbs = F.struct(*LIMBS)
    seen = {name: F.count_if((F.col(BIN) == b) & (F.col(COUNT) > 0)).alias(f"_{name}") for name, b in (("nan", NAN), ("inf", INFINITE), ("minus", MINUS_INFINITE))}
    grouped = states.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.map_from_entries(F.collect_list(F.struct(BIN, limbs))).alias("_bins"),
        F.coalesce(F.sum(F.when(F.col(BIN) != NONE, F.col(COUNT))), F.lit(0)).alias(COUNT),
        *seen.values(),
    )
    for step in _carry_steps():
        grouped = grouped.withColumns({name: F.expr(text) for name, text in step.items()})
    special = (
        F.when(F.col(COUNT) <= 0, F.lit(None).cast("double"))
        .when((F.col("_nan") > 0) | ((F.col("_inf") > 0) & (F.col("_minus") > 0)), F.lit(float("nan")))
        .when(F.col("_inf") > 0, F.lit(float("inf")))
        .when(F.col("_minus") > 0, F.lit(float("-inf")))
        .otherwise(F.col("_total"))
    )
    counted = [F.col(COUNT).alias(count)] if count else []
    return grouped.select(*[F.col(f"`{c}`") for c in by], special.alias(out), *counted)


def exact_sum(df: DataFrame, by: Sequence[str], value: str, out: str, count: str | None = None) -> DataFrame:
    """``by`` with the exact sum of ``value``, rounded once."""
    return totals(sum_states(df, by, value), by, out, count)


def _carry_steps() -> list[dict[str, str]]:
    """From the bins' limbs to a double, as SQL expressions one after the other."""
    limb = "coalesce(try_element_at(_bins, p - {0})._limb{0}, cast(0 as decimal(38,0)))".format
    # Positions from the lowest bin in use up; all below are zero.
    finite = "filter(map_keys(_bins), b -> b >= 0)"
    spread = f"transform(sequence(_low, _high + {ABOVE}), p -> cast({limb(0)} + {limb(1)} + {limb(2)} as decimal(38,0)))"
    over = "((c + t - pmod(c + t, {0})) div {0})".format(BASE).replace("c + t", "cast(c + t as decimal(38,0))")
    carried = over.replace("c + t", "a.c + t * _sign")
    digit = f"cast(pmod(cast(a.c + t * _sign as decimal(38,0)), {BASE}) as bigint)"
    # _top: the highest limb in use, counted from _low; _width: its bits; _a, _b, _c: it and the two below.
    below = "coalesce(try_element_at(_limbs, _top + 1 - {0}), 0L)".format
    sticky = "exists(slice(_limbs, 1, greatest({0}, 0)), x -> x > 0)".format
    return [
        {"_low": f"coalesce(array_min({finite}), 0)", "_high": f"coalesce(array_max({finite}), 0)"},
        {"_spread": spread},
        {"_sign": f"if(aggregate(_spread, 0L, (c, t) -> {over}) < 0, -1, 1)"},
        {"_limbs": f"aggregate(_spread, named_struct('c', 0L, 'd', array_repeat(0L, 0)), (a, t) -> named_struct('c', {carried}, 'd', array_append(a.d, {digit}))).d"},
        {"_top": "coalesce(array_max(transform(_limbs, (x, i) -> if(x > 0, i, -1))), -1)"},
        {
            "_a": "if(_top < 0, 0L, element_at(_limbs, greatest(_top, 0) + 1))",
            "_b": f"if(_top < 1, 0L, {below(1)})",
            "_c": f"if(_top < 2, 0L, {below(2)})",
        },
        {"_width": "if(_a > 0, length(bin(_a)), 0)"},
        {"_bits": "if(_top < 0, 0, (_top + _low) * 32 + _width)"},
        {
            # The 53 highest bits, and what is left below them as (rest, half of the last bit, whether anything is lower still).
            "_kept": "if(_bits <= 53, _b + if(_top + _low > 0, _a * 4294967296L, _a), if(_width >= 21, "
            "shiftleft(_a, 53 - _width) + shiftright(_b, _width - 21), "
            "shiftleft(_a, 53 - _width) + shiftleft(_b, 21 - _width) + shiftright(_c, 11 + _width)))",
            "_rest": "CASE WHEN _width > 21 THEN _b & (shiftleft(1L, _width - 21) - 1) WHEN _width = 21 THEN _c "
            "ELSE _c & (shiftleft(1L, 11 + _width) - 1) END",
            "_half": "CASE WHEN _width > 21 THEN shiftleft(1L, _width - 22) WHEN _width = 21 THEN 2147483648L ELSE shiftleft(1L, 10 + _width) END",
            "_lower": f"{sticky('_top - 2')} OR (_width > 21 AND _c > 0)",
        },
        {"_up": "_bits > 53 AND (_rest > _half OR (_rest = _half AND (_lower OR _kept % 2 = 1)))"},
        {
            "_total": "_sign * (_kept + if(_up, 1L, 0L)) * if(_bits > 53, power(2D, _bits - 53 - 1074), 1D)"
            " * if(_bits > 53, 1D, power(2D, -537)) * if(_bits > 53, 1D, power(2D, -537))"
        },
    ]
