"""Nested collections to rows.

The analytics work on these flat forms. A source that is flat already (one row
per order line, one per product view) supplies them directly and never builds
the nested form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

LINE_HEADER = ("transaction_id", "user_id", "session_id", "timestamp", "status")


def line_items(transactions: DataFrame) -> DataFrame:
    """One row per item of each transaction; transactions without items vanish."""
    header = [c for c in LINE_HEADER if c in transactions.columns]
    return transactions.select(*header, F.explode("items").alias("item")).select(
        *header, "item.product_id", "item.quantity", "item.unit_price", "item.subtotal"
    )


def session_views(sessions: DataFrame) -> DataFrame:
    """One row per product viewed in a session."""
    return sessions.select(
        "session_id", "user_id", "start_time", F.explode("viewed_products").alias("product_id")
    )


def cart_lines(sessions: DataFrame) -> DataFrame:
    """One row per product in a session's cart."""
    return sessions.select(
        "session_id", "user_id", "start_time", F.explode("cart_contents").alias("product_id", "line")
    ).select("session_id", "user_id", "start_time", "product_id", "line.quantity", "line.price")
