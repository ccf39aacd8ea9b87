"""Calendar buckets.

Grouping by a formatted string costs a formatter call per row, so the analytics
group by a date (the Saturday that closes the week, the first of the month) and
turn it into its label after the aggregation, once per group.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def week_end(ts: Column | str) -> Column:
    """Saturday closing the US week (Sunday to Saturday) that holds ``ts``."""
    day = F.to_date(ts)
    return F.date_add(day, 7 - F.dayofweek(day))


def week_label(saturday: Column | str) -> Column:
    """``YYYY-ww`` of a week given by its Saturday.

    Week 1 holds 1 January and the year is the week's own year: both follow from
    the Saturday alone, since a week with 1 January in it ends in the new year.
    """
    week = F.floor((F.dayofyear(saturday) + 6) / 7)
    return F.concat(F.date_format(saturday, "yyyy"), F.lit("-"), F.lpad(week.cast("string"), 2, "0"))


def us_week(ts: Column | str) -> Column:
    """``YYYY-ww`` label of a timestamp or date."""
    return week_label(week_end(ts))


def month_start(ts: Column | str) -> Column:
    return F.trunc(F.to_date(ts), "month")


def month_label(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole calendar months from ``earlier`` to ``later``; may be negative."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
