"""Sums of doubles that do not depend on the order in which partitions arrive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Whole parts are summed in three limbs of so many bits, so that 4e12 rows of a group cannot overflow a long.
LIMB = 21
MASK = (1 << LIMB) - 1


def total(value: Column, scale: int | None = None) -> Column:
    """Sum of ``value``.

    With ``scale`` given, values known to carry at most that many decimals are added as whole numbers and whole
    smallest units: exact, repeatable, and cheaper than decimals because the aggregation buffer stays a few longs. A
    value may be anything below 2**62; above 2**63 the cast raises under ANSI mode. Nothing is ever wrong silently. Values
    beyond that, or without a known number of decimals, are for ``exact_sums``.
    """
    if scale is None:
        return F.sum(value)
    unit = 10**scale
    whole = F.rint(value)
    units = whole.cast("bigint")
    limbs = (F.shiftright(units, 2 * LIMB), F.shiftright(units, LIMB).bitwiseAND(F.lit(MASK)), units.bitwiseAND(F.lit(MASK)))
    high, middle, low = (F.sum(limb).cast("decimal(38,0)") for limb in limbs)
    rest = F.sum(F.rint((value - whole) * F.lit(float(unit))).cast("bigint")).cast("decimal(38,0)")
    wide = lambda n: F.lit(n).cast("decimal(20,0)")
    together = ((high * wide(1 << LIMB) + middle) * wide(1 << LIMB) + low) * wide(unit) + rest
    # Both are the nearest double of the exact quotient; the first needs a numerator that is a double itself.
    near = together.cast("double") / F.lit(float(unit))
    return near if scale > 6 else F.when(F.abs(together) < 2**53, near).otherwise((together / wide(unit)).cast("double"))


def mean(value: Column, scale: int | None = None) -> Column:
    return F.avg(value) if scale is None else total(value, scale) / F.count(value)
