"""Predicates on transaction status; they differ in what they do with null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
SOLD = ("completed", "shipped")
REFUNDED = "refunded"
CONVERTED = "converted"


def is_sold(status: str = "status") -> Column:
    """Completed or shipped; a null status is out."""
    return F.col(status).isin(*SOLD)


def not_refunded(status: str = "status") -> Column:
    """SQL inequality: a null status is out."""
    return F.col(status) != REFUNDED


def not_refunded_or_null(status: str = "status") -> Column:
    """Document-style inequality: a null or missing status stays in."""
    return ~F.col(status).eqNullSafe(REFUNDED)


def is_converted(status: str = "conversion_status") -> Column:
    return F.col(status) == CONVERTED
