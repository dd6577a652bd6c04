"""Null-safe ratios, rounding, months, bands: the expressions every operator uses."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

CRORE = 1e7


@dataclass(frozen=True)
class Rounding:
    """Decimals kept beyond the published ones.

    Published tables round money to whole units and percentages to one or two
    digits. A finer setting serves comparisons between engines, whose `round`
    disagree on ties.
    """

    money: int = 0
    mean: int = 0
    scaled: int = 0

    def to_money(self, column: Column, digits: int = 0) -> Column:
        return F.round(column, digits + self.money)

    def to_mean(self, column: Column, digits: int = 2) -> Column:
        return F.round(column, digits + self.mean)

    def to_crore(self, column: Column, digits: int = 2) -> Column:
        return F.round(column / F.lit(CRORE), digits + self.scaled)


PUBLISHED = Rounding()
FINE = Rounding(money=4, mean=4, scaled=8)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; NULL where whole is 0 or NULL (ANSI division would raise)."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole as double, NULL-safe like `ratio`."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def rows() -> Column:
    return F.count(F.lit(1))


def share_pct(condition: Column) -> Column:
    """Percent of a group's rows that satisfy the condition."""
    return pct(F.count_if(condition), rows())


def month_start(column: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(column, "month")


def month_number(column: Column) -> Column:
    """Months on one running scale, so that month gaps are plain differences."""
    return F.year(column) * 12 + F.month(column)


def month_from_number(number: Column) -> Column:
    """Inverse of `month_number`, as the first day of that month."""
    zero_based = number.cast("int") - 1
    return F.make_date(F.floor(zero_based / 12).cast("int"), zero_based % 12 + 1, F.lit(1))


def not_blank(column: Column) -> Column:
    """True for a key that is present: neither NULL nor only spaces."""
    return F.coalesce(F.trim(column) != "", F.lit(False))


def banded(
    value: Column, bands: Sequence[tuple[Callable[[Column], Column], str]], otherwise: str
) -> Column:
    """Label of the first band whose test holds; NULL values take `otherwise`."""
    chain = None
    for test, label in bands:
        chain = F.when(test(value), label) if chain is None else chain.when(test(value), label)
    return chain.otherwise(otherwise)
