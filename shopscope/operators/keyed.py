"""Keyed tables: uniqueness, upsert, last write, latest rows, lookups, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import calendar, rowkeys


def duplicate_keys(df: DataFrame, key: str, sparse: bool = False) -> DataFrame:
    """Keys that occur more than once, with their row count. A sparse key
    ignores rows where it is null; otherwise null is a key like any other."""
    if sparse:
        df = df.filter(F.col(key).isNotNull())
    return df.groupBy(key).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def merge_updates(updates: DataFrame, key: str, order: str) -> DataFrame:
    """Fold several updates of one key into one: each column keeps its latest
    non-null value, as if the updates had been applied one after the other."""
    rest = [c for c in updates.columns if c not in (key, order)]
    return updates.groupBy(key).agg(
        *(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest)
    )


def upsert(current: DataFrame, updates: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """``current`` with ``updates`` merged in: new keys are added, known keys
    take the non-null columns of the update and keep the rest.

    ``updates`` holds one row per key, unless ``order`` names the column that
    sorts several updates of a key.
    """
    if order is not None:
        updates = merge_updates(updates, key, order)
    columns = list(dict.fromkeys(current.columns + updates.columns))
    a, b = current.alias("a"), updates.alias("b")

    def merged(c: str) -> Column:
        sides = [F.col(f"{t}.{c}") for t, df in (("b", updates), ("a", current)) if c in df.columns]
        return F.coalesce(*sides).alias(c)

    return a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer").select(*map(merged, columns))


def inserted_keys(current: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Keys an upsert would add; their count is the number of inserts."""
    return updates.select(key).filter(F.col(key).isNotNull()).distinct().join(current.select(key), key, "left_anti")


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key in the given order.

    The rank limit is applied inside each input partition before the shuffle,
    so a hot key sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def last_write(df: DataFrame, key: str | Sequence[str], write_order: str | Sequence[str]) -> DataFrame:
    """One row per key: the one written last."""
    key = [key] if isinstance(key, str) else list(key)
    write_order = [write_order] if isinstance(write_order, str) else list(write_order)
    return latest_per_key(df, key, [F.col(c).desc() for c in write_order])


def latest_sessions(sessions: DataFrame, n: int = 5) -> DataFrame:
    """Newest ``n`` sessions of every user."""
    return latest_per_key(sessions, ["user_id"], [F.col("start_time").desc(), F.col("session_id")], n)


def user_sessions(sessions: DataFrame, user_id, limit: int = 5) -> DataFrame:
    """Newest sessions of one user, with the wide table's row key."""
    return (
        sessions.filter(F.col("user_id") == user_id)
        .orderBy(F.col("start_time").desc(), "session_id")
        .limit(limit)
        .select(
            rowkeys.session_key("user_id", "start_time").alias("row_key"),
            "session_id",
            "start_time",
            F.col("device_type").alias("device"),
            F.col("conversion_status").alias("conversion"),
            "referrer",
        )
    )


def metric_range(
    metrics: DataFrame, product_id, first_day, last_day, columns: Sequence[str] | None = None
) -> DataFrame:
    """Daily metrics of one product, both end dates included. ``columns``
    restricts the scan to some counters. On the stored table, which is
    partitioned by month, only the months of the range are read."""
    picked = columns or ("views", "cart_adds", "purchases", "revenue")
    first, last = (F.lit(d).cast("date") for d in (first_day, last_day))
    wanted = (F.col("product_id") == product_id) & F.col("metric_date").between(first, last)
    if "metric_month" in metrics.columns:
        wanted &= F.col("metric_month").between(calendar.month_label(first), calendar.month_label(last))
    return metrics.filter(wanted).select(
        rowkeys.product_day_key("product_id", "metric_date").alias("row_key"), *picked
    )


def point_get(df: DataFrame, row_key: str, key: str = "row_key") -> DataFrame:
    return df.filter(F.col(key) == row_key)


def prefix_get(df: DataFrame, prefix: str, key: str = "row_key") -> DataFrame:
    """Rows whose key begins with ``prefix``, as a range of keys, which the statistics of a sorted table answer."""
    return df.filter((F.col(key) >= prefix) & F.col(key).startswith(prefix))


def retained(df: DataFrame, ts: str, as_of, days: int = 90) -> DataFrame:
    """Rows no older than ``days`` at ``as_of``. The cut-off takes the type of
    the column, so that the comparison reaches the scan."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    type_ = df.schema[ts].dataType.simpleString()
    return df.filter(F.col(ts) >= (as_of.cast("timestamp") - F.make_dt_interval(F.lit(days))).cast(type_))


def wide_sessions(sessions: DataFrame) -> DataFrame:
    """Sessions as rows of the wide table: text cells, empty text for a missing
    value, collections as JSON. Apply ``last_write`` for one row per key."""
    geo = ("geo_data.city", "geo_data.state", "geo_data.ip_address")
    city, state, ip = geo if "geo_data" in sessions.columns else ("city", "state", "ip_address")

    def cell(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    def moment(c: str) -> Column:
        return F.coalesce(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))

    return sessions.select(
        rowkeys.session_key("user_id", "start_time").alias("row_key"),
        cell("session_id").alias("session_id"),
        moment("start_time").alias("start_time"),
        moment("end_time").alias("end_time"),
        F.coalesce(F.col("duration_seconds"), F.lit(0)).cast("string").alias("duration_secs"),
        cell("device_type").alias("device_type"),
        cell("device_os").alias("device_os"),
        cell("referrer").alias("referrer"),
        cell("conversion_status").alias("conversion"),
        F.coalesce(F.to_json("viewed_products"), F.lit("[]")).alias("viewed"),
        F.coalesce(F.to_json("cart_contents"), F.lit("{}")).alias("cart"),
        F.col("page_count").cast("string").alias("page_count"),
        cell(city).alias("city"),
        cell(state).alias("state"),
        cell(ip).alias("ip"),
    )
