"""Exact money arithmetic.

Amounts are currency held as doubles. Adding doubles across partitions gives a
result that depends on the order of the tasks, so sums run over whole units of a
millionth: exact for amounts of up to six places, parts of a cent included,
order-independent, and rounded once, where the result is shown.

Rows are added as bigints (``sum_units``), a plain long addition inside generated
code, good for 9 trillion per group of the first grouping (an item, a user, a
week of a user); the few rows of the groupings after it as decimals (``total``),
good for 32 digits. What does not fit raises under ANSI mode instead of wrapping.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS = 1_000_000


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(amount: Column | str) -> Column:
    """Amount in whole units."""
    return F.rint(_column(amount) * UNITS).cast("bigint")


def sum_units(amount: Column | str) -> Column:
    """Aggregate: exact total of rows in units, null when there is nothing to add."""
    return F.sum(units(amount))


def total(units_: Column | str) -> Column:
    """Aggregate: exact total of totals in units."""
    return F.sum(_column(units_).cast("decimal(38,0)"))


def exact_amount(units_: Column | str) -> Column:
    """Units back to a currency amount, parts of a cent included."""
    return _column(units_).cast("double") / UNITS


def amount(units_: Column | str) -> Column:
    """Units back to a currency amount, rounded half up to cents."""
    return F.round(exact_amount(units_), 2)


def mean_amount(units_: Column, n: Column) -> Column:
    """Unrounded mean of ``n`` amounts; null when ``n`` is zero."""
    return F.try_divide(units_.cast("double"), (n * UNITS).cast("double"))


def ratio(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` rounded half up; null when ``den`` is zero."""
    return F.round(F.try_divide(num, den), scale)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part`` as a percentage of ``whole``, rounded half up."""
    return F.round(F.try_divide(part * 100, whole), scale)
