"""Spending by registration cohort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import calendar, money


def cohort_analysis(transactions: DataFrame, users: DataFrame, exclude_status: str | None = None) -> DataFrame:
    """Spending per registration month and months since registration.

    Transactions collapse to one row per user and month before they meet the
    users, so each joined row is one active user of its cell.
    """
    if exclude_status is not None:
        transactions = transactions.filter(F.col("status") != exclude_status)
    monthly = transactions.groupBy("user_id", calendar.month_start("timestamp").alias("month")).agg(
        F.count("transaction_id").alias("n"), money.sum_units("total").alias("_units")
    )
    cohort = users.select("user_id", calendar.month_start("registration_date").alias("reg"))
    return (
        monthly.join(cohort, "user_id")
        .groupBy("reg", calendar.months_apart(F.col("month"), F.col("reg")).alias("months_since_reg"))
        .agg(
            F.sum("n").alias("num_transactions"),
            money.total("_units").alias("_units"),
            F.count("user_id").alias("active_users"),
        )
        .select(
            calendar.month_label("reg").alias("reg_month"),
            "months_since_reg",
            "num_transactions",
            money.exact_amount("_units").alias("total_revenue"),
            money.mean_amount(F.col("_units"), F.col("num_transactions")).alias("avg_order_value"),
            "active_users",
        )
        .orderBy("reg_month", "months_since_reg")
    )


def cohort_pivot(cohorts: DataFrame, offsets: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """Revenue per cohort, one column per month offset. Cohorts whose spending
    all falls on other offsets stay, with nulls."""
    return (
        cohorts.filter("months_since_reg >= 0")
        .groupBy("reg_month")
        .pivot("months_since_reg", list(offsets))
        .agg(money.amount(money.sum_units("total_revenue")))
        .orderBy("reg_month")
    )


def cohort_revenue_matrix(
    cohorts: DataFrame, max_offset: int = 4, offsets: Sequence[int] | None = None
) -> DataFrame:
    """Revenue per cohort and month offset, zero where there is none.

    There is one column ``Month +k`` per offset that occurs, in order of k. Finding
    those runs a small job over the cohort table; passing ``offsets`` avoids it.
    """
    near = cohorts.filter(F.col("months_since_reg").between(0, max_offset))
    matrix = (
        near.groupBy("reg_month")
        .pivot("months_since_reg", None if offsets is None else list(offsets))
        .agg(money.exact_amount(money.sum_units("total_revenue")))
        .fillna(0.0)
        .orderBy("reg_month")
    )
    return matrix.withColumnsRenamed({c: f"Month +{c}" for c in matrix.columns if c != "reg_month"})
