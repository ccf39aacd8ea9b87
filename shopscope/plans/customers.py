"""Customers: spending profiles, segments, lifetime value."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import bands, money, status as st


def _spend_by_user(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("user_id").agg(
        F.count("*").alias("num_orders"),
        F.coalesce(money.sum_units("total"), F.lit(0)).alias("_units"),
        F.max("total").alias("max_spend"),
        F.count("total").alias("_n"),
    )


def user_spend_profile(
    transactions: DataFrame, segment: str | None = None, tiers: bands.Steps = bands.SPEND_TIERS
) -> DataFrame:
    """Spending and payment methods per user, refunds left out but unknown
    status counted. ``segment`` keeps the users of one spend tier."""
    out = (
        transactions.filter(st.not_refunded_or_null())
        .groupBy("user_id")
        .agg(
            F.count("*").alias("num_orders"),
            F.coalesce(money.sum_units("total"), F.lit(0)).alias("_units"),
            F.count("total").alias("_n"),
            F.max("total").alias("max_spend"),
            F.sort_array(F.collect_set("payment_method")).alias("payments"),
        )
        .select(
            "user_id", "num_orders",
            money.exact_amount("_units").alias("total_spend"),
            money.mean_amount(F.col("_units"), F.col("_n")).alias("avg_spend"),
            "max_spend", "payments",
            bands.spend_tier(money.exact_amount("_units"), tiers).alias("spend_segment"),
        )
    )
    return out if segment is None else out.filter(F.col("spend_segment") == segment)


def user_segmentation_by_age(
    transactions: DataFrame, users: DataFrame, tiers: bands.Steps = bands.SPEND_TIERS
) -> DataFrame:
    """Spending per age band: means over users of their orders, spend and mean
    order, and the share of high-value users. Buyers without a profile or an
    age fall in the youngest band."""
    spend = _spend_by_user(transactions.filter(st.not_refunded_or_null()))
    youngest = bands.AGE_BANDS[0][1]
    # A user's mean order in units, too: a sum of doubles would depend on the order of tasks.
    mean = money.mean_amount(F.col("_units"), F.col("_n"))
    high = bands.spend_tier(money.exact_amount("_units"), tiers) == tiers[0][1]
    return (
        spend.join(users.select("user_id", "age"), "user_id", "left")
        .withColumn("age_group", bands.age_band(F.col("age"), null_label=youngest))
        .groupBy("age_group")
        .agg(
            F.count("*").alias("num_users"),
            F.sum("num_orders").alias("_orders"),
            money.total("_units").alias("_units"),
            money.total(money.units(mean)).alias("_means"),
            F.count(mean).alias("_buyers"),
            F.count_if(high).alias("_high"),
        )
        .select(
            "age_group", "num_users",
            F.bround(F.col("_orders") / F.col("num_users"), 1).alias("avg_orders"),
            F.bround(money.mean_amount(F.col("_units"), F.col("num_users")), 2).alias("avg_total_spend"),
            F.bround(money.mean_amount(F.col("_means"), F.col("_buyers")), 2).alias("avg_order_value"),
            F.bround(F.col("_high") * 100 / F.col("num_users"), 1).alias("high_value_pct"),
        )
        .orderBy(F.desc("avg_total_spend"), "age_group")
    )


def user_segments(
    users: DataFrame,
    transactions: DataFrame,
    tiers: bands.Steps = bands.SPEND_TIERS,
    exclude_status: str | None = None,
) -> DataFrame:
    """Order history and spend tier of every user, buyers or not. Refunds count
    unless ``exclude_status`` names them."""
    if exclude_status is not None:
        transactions = transactions.filter(F.col("status") != exclude_status)
    orders = transactions.groupBy("user_id").agg(
        F.count("transaction_id").alias("num_orders"),
        money.sum_units("total").alias("_units"),
        F.max("total").alias("_max"),
        F.min("txn_date").alias("first_purchase"),
        F.max("txn_date").alias("last_purchase"),
    )
    return users.join(orders, "user_id", "left").select(
        "user_id", "age_group", "gender", "preferred_payment",
        F.coalesce("num_orders", F.lit(0)).alias("num_orders"),
        money.amount("_units").alias("lifetime_value"),
        F.round(money.mean_amount(F.col("_units"), F.col("num_orders")), 2).alias("avg_order_value"),
        F.round("_max", 2).alias("max_order_value"),
        "first_purchase", "last_purchase",
        bands.spend_tier(money.exact_amount("_units"), tiers).alias("customer_segment"),
    )


def age_payment_spend_matrix(segments: DataFrame, values: Sequence[str] | None = None) -> DataFrame:
    """Mean lifetime value by age band and preferred payment (by gender where
    the payment column is missing), zero for empty cells, bands in fixed order.

    Without ``values`` the payment methods are looked up, which runs a job.
    """
    by = "preferred_payment" if "preferred_payment" in segments.columns else "gender"
    rank = F.array_position(F.array(*map(F.lit, bands.AGE_ORDER)), F.col("age_group"))
    return (
        segments.select(
            F.coalesce("age_group", F.lit("unknown")).alias("age_group"),
            F.coalesce(by, F.lit("unknown")).alias("by"),
            F.coalesce(money.units("lifetime_value"), F.lit(0)).alias("_units"),
        )
        .groupBy("age_group")
        .pivot("by", list(values) if values is not None else None)
        .agg(money.mean_amount(money.total("_units"), F.count("_units")))
        .fillna(0.0)
        .orderBy(rank)
    )


def txn_metrics(transactions: DataFrame) -> DataFrame:
    """Purchase history per user, refunds left out."""
    return (
        transactions.filter(st.not_refunded())
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("order_count"),
            money.sum_units("total").alias("_units"),
            F.min("txn_date").alias("first_purchase_date"),
            F.max("txn_date").alias("last_purchase_date"),
        )
        .select(
            "user_id", "order_count",
            money.amount("_units").alias("total_spend"),
            F.round(money.mean_amount(F.col("_units"), F.col("order_count")), 2).alias("avg_order_value"),
            "first_purchase_date", "last_purchase_date",
            F.datediff("last_purchase_date", "first_purchase_date").alias("customer_tenure_days"),
        )
    )


def session_metrics(sessions: DataFrame) -> DataFrame:
    """Browsing activity per user."""
    return (
        sessions.groupBy("user_id")
        .agg(
            F.count("session_id").alias("session_count"),
            F.sum("duration_seconds").alias("_seconds"),
            F.count_if(st.is_converted()).alias("converted_sessions"),
            F.sum("viewed_count").alias("total_products_viewed"),
        )
        .select(
            "user_id", "session_count",
            money.ratio(F.col("_seconds"), F.col("session_count") * 60, 1).alias("avg_session_min"),
            money.ratio(F.col("_seconds"), F.lit(60), 1).alias("total_session_min"),
            "converted_sessions", "total_products_viewed",
        )
    )


@dataclass(frozen=True)
class ClvWeights:
    """Weights of the lifetime-value score. Decimal text: the score is computed
    in decimals, so that a tie at the last cent rounds the same everywhere."""

    sessions: str = "0.4"
    viewed: str = "0.3"
    converted: str = "3.0"
    spend: str = "0.5"
    orders: str = "6.0"
    engagement: str = "0.2"


def _weighted(column: str, type_: str, weight: str) -> Column:
    return F.col(column).cast(type_) * F.lit(Decimal(weight))


def clv_scores(
    users: DataFrame,
    transactions: DataFrame,
    sessions: DataFrame,
    weights: ClvWeights = ClvWeights(),
    tiers: bands.Steps = bands.CLV_TIERS,
    fill_converted: bool = False,
) -> DataFrame:
    """Lifetime value score and tier per user.

    A user without sessions has no converted sessions to weigh, so score and
    engagement are null and the tier is the lowest; ``fill_converted`` reads
    the missing count as zero instead.
    """
    zero = ["order_count", "total_spend", "session_count", "avg_session_min", "total_products_viewed"]
    if fill_converted:
        zero.append("converted_sessions")
    engagement = F.round(
        _weighted("session_count", "decimal(18,0)", weights.sessions)
        + _weighted("total_products_viewed", "decimal(18,0)", weights.viewed)
        + _weighted("converted_sessions", "decimal(18,0)", weights.converted),
        2,
    )
    value = F.round(
        _weighted("total_spend", "decimal(18,2)", weights.spend)
        + _weighted("order_count", "decimal(18,0)", weights.orders)
        + _weighted("engagement_score", "decimal(18,2)", weights.engagement),
        2,
    )
    profile = users.select("user_id", "age_group", "gender", "state", "reg_month", "preferred_payment")
    return (
        profile.join(txn_metrics(transactions), "user_id", "left")
        .join(session_metrics(sessions), "user_id", "left")
        .fillna(0, subset=zero)
        .withColumn("engagement_score", engagement.cast("double"))
        .withColumn("clv_score", value.cast("double"))
        .withColumn("clv_segment", bands.clv_tier(F.col("clv_score"), tiers))
    )


def top_customers(clv: DataFrame, limit: int = 10) -> DataFrame:
    """The users with the highest lifetime value."""
    return (
        clv.select(
            "user_id", "age_group", "state", "order_count", "total_spend",
            "session_count", "clv_score", "clv_segment",
        )
        .orderBy(F.desc("clv_score"), "user_id")
        .limit(limit)
    )


def clv_segment_distribution(clv: DataFrame) -> DataFrame:
    """Size and mean spend, orders and sessions per lifetime-value tier."""
    return (
        clv.groupBy("clv_segment")
        .agg(
            F.count("*").alias("num_users"),
            money.sum_units("total_spend").alias("_units"),
            F.sum("order_count").alias("_orders"),
            F.sum("session_count").alias("_sessions"),
        )
        .select(
            "clv_segment", "num_users",
            F.round(money.mean_amount(F.col("_units"), F.col("num_users")), 2).alias("avg_spend"),
            money.ratio(F.col("_orders"), F.col("num_users"), 2).alias("avg_orders"),
            money.ratio(F.col("_sessions"), F.col("num_users"), 2).alias("avg_sessions"),
        )
        .orderBy(F.desc("avg_spend"), "clv_segment")
    )


def clv_segment_dense(clv: DataFrame, domain: Sequence[str] = bands.CLV_ORDER) -> DataFrame:
    """Users and unrounded mean spend of every tier of ``domain``, in its order;
    zero for a tier nobody is in."""
    counts = clv.groupBy("clv_segment").agg(
        F.count("user_id").alias("num_users"),
        money.mean_amount(money.sum_units("total_spend"), F.count("total_spend")).alias("avg_spend"),
    )
    tiers = clv.sparkSession.range(1).select(
        F.posexplode(F.array(*map(F.lit, domain))).alias("_rank", "clv_segment")
    )
    return (
        tiers.join(counts, "clv_segment", "left")
        .fillna({"num_users": 0, "avg_spend": 0.0})
        .orderBy("_rank")
        .select("clv_segment", "num_users", "avg_spend")
    )
