"""Ordered name classes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NameClass:
    """A label and the ways a name can earn it; any one is enough. Matching is case-sensitive."""

    label: str
    equals: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    contains: tuple[str, ...] = ()

    def matches(self, name: Column) -> Column:
        tests = [name == v for v in self.equals]
        tests += [name.startswith(v) for v in self.prefixes]
        tests += [name.contains(v) for v in self.contains]
        return reduce(lambda a, b: a | b, tests)


def classify(name: Column, classes: list[NameClass], otherwise: str) -> Column:
    """First class that matches wins; a NULL name matches none."""
    branches = [F.when(c.matches(name), F.lit(c.label)) for c in classes]
    return F.coalesce(*branches, F.lit(otherwise))


# The class labels and the texts that earn them, in order of precedence.
PRODUCT_CLASSES = [
    NameClass("Crude Oil", contains=("Crude",)),
    NameClass("Distillate Fuel", contains=("Diesel", "Distillate")),
    NameClass("Gasoline", contains=("Gasoline", "Blend")),
]
PRODUCT_OTHERWISE = "Other Petroleum Product"
AREA_CLASSES = [
    NameClass("Country", equals=("U.S.",)),
    NameClass("PADD District", prefixes=("PADD",)),
]
AREA_OTHERWISE = "Other/Unknown"
