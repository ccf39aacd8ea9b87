"""Series over weeks and days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import calendar, money, status as st


def _by_week(transactions: DataFrame) -> DataFrame:
    """One row per week. Users collapse to one row per week first, which makes
    the distinct count of users a plain count."""
    return (
        transactions.filter(st.not_refunded())
        .groupBy(calendar.week_end("timestamp").alias("_week"), "user_id")
        .agg(F.count("transaction_id").alias("n"), money.sum_units("total").alias("_units"))
        .groupBy("_week")
        .agg(
            F.sum("n").alias("n"),
            money.total("_units").alias("_units"),
            F.count("user_id").alias("users"),
        )
    )


def weekly_revenue(transactions: DataFrame) -> DataFrame:
    return (
        _by_week(transactions)
        .select(
            calendar.week_label("_week").alias("txn_week"),
            F.col("n").alias("num_transactions"),
            money.amount("_units").alias("total_revenue"),
            F.round(money.mean_amount(F.col("_units"), F.col("n")), 2).alias("avg_order_value"),
            F.col("users").alias("unique_customers"),
        )
        .orderBy("txn_week")
    )


def weekly_trend(transactions: DataFrame, window: int = 4) -> DataFrame:
    """Weekly revenue with averages over the last ``window`` rows. Rows, not
    weeks: a week without sales is no row and leaves no gap.

    The window has no partition key and runs in one task, over one row per
    week: that is bounded by the calendar, not by the data.
    """
    w = Window.orderBy("txn_week").rowsBetween(1 - window, 0)
    mean = money.mean_amount(money.total("_units").over(w), F.count("_units").over(w))
    mean_users = F.try_divide(F.sum("users").over(w), F.count("users").over(w))
    return (
        _by_week(transactions)
        .withColumn("txn_week", calendar.week_label("_week"))
        .select(
            "txn_week",
            F.col("n").alias("num_txns"),
            money.amount("_units").alias("revenue"),
            F.col("users").alias("unique_buyers"),
            F.round(mean, 2).alias("rolling_avg_revenue"),
            F.round(mean_users, 1).alias("rolling_avg_buyers"),
        )
        .orderBy("txn_week")
    )


def product_daily_metrics(
    views: DataFrame | None = None, carts: DataFrame | None = None, lines: DataFrame | None = None, activity: DataFrame | None = None
) -> DataFrame:
    """Views, cart adds, units bought and revenue per product and day.

    ``activity`` stands for views and carts where one source tells both: a row per session and product with ``viewed`` and
    ``carted`` as 0 or 1.

    Views and cart adds fall on the day the session starts, purchases on the
    day of the transaction, refunds left out. A missing source counts zero. The
    sources are stacked and grouped once, which stands for a full outer join.
    """
    def stacked(df: DataFrame, ts: str, **counts) -> DataFrame:
        zero = {"views": F.lit(0), "cart_adds": F.lit(0), "purchases": F.lit(0), "_units": F.lit(0)}
        columns = {**zero, **counts}
        return df.select(
            "product_id", F.to_date(ts).alias("metric_date"),
            *(c.cast("bigint").alias(name) for name, c in columns.items()),
        )

    parts = []
    if activity is not None:
        parts.append(stacked(activity, "start_time", views=F.col("viewed"), cart_adds=F.col("carted")))
    if views is not None:
        parts.append(stacked(views, "start_time", views=F.lit(1)))
    if carts is not None:
        parts.append(stacked(carts, "start_time", cart_adds=F.lit(1)))
    if lines is not None:
        sold = lines.filter(st.not_refunded())
        parts.append(stacked(sold, "timestamp", purchases=F.col("quantity"), _units=money.units("subtotal")))
    return (
        reduce(DataFrame.unionByName, parts).groupBy("product_id", "metric_date")
        .agg(*(F.sum(c).alias(c) for c in ("views", "cart_adds", "purchases", "_units")))
        .withColumn("revenue", money.amount("_units"))
        .drop("_units")
    )
