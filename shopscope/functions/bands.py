"""Banding of numbers into labelled classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Class bounds and labels, in order of evaluation.
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"))
AGE_OLDEST = "55+"
AGE_ORDER = ("18-24", "25-34", "35-44", "45-54", "55+", "unknown")
PRICE_TIERS = ((20, "budget"), (100, "mid-range"), (300, "premium"))
PRICE_TOP = "luxury"
SPEND_TIERS = ((1000, "high_value"), (300, "mid_value"))
SPEND_LOWEST = "low_value"
CLV_TIERS = ((500, "platinum"), (200, "gold"), (50, "silver"))
CLV_LOWEST = "bronze"
CLV_ORDER = ("platinum", "gold", "silver", "bronze")

Steps = Sequence[tuple[float, str]]


def first_below(value: Column, steps: Steps, rest: str) -> Column:
    """Label of the first bound that ``value`` lies under; null falls to ``rest``."""
    out = F
    for bound, label in steps:
        out = out.when(value < bound, label)
    return out.otherwise(rest)


def first_above(value: Column, steps: Steps, rest: str) -> Column:
    """Label of the first bound that ``value`` exceeds; null falls to ``rest``."""
    out = F
    for bound, label in steps:
        out = out.when(value > bound, label)
    return out.otherwise(rest)


def age_band(age: Column, null_label: str = "unknown") -> Column:
    """Age band. ``null_label`` names the band of a missing age: ``unknown`` in
    the cleaned tables, the youngest band where a missing age sorts lowest."""
    return F.when(age.isNull(), null_label).otherwise(first_below(age, AGE_BANDS, AGE_OLDEST))


def price_tier(price: Column) -> Column:
    return first_below(price, PRICE_TIERS, PRICE_TOP)


def spend_tier(spend: Column, steps: Steps = SPEND_TIERS) -> Column:
    return first_above(spend, steps, SPEND_LOWEST)


def clv_tier(score: Column, steps: Steps = CLV_TIERS) -> Column:
    return first_above(score, steps, CLV_LOWEST)
