"""Products and categories: popularity, revenue, performance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import calendar, money, status as st
from ..operators.cleaning import coerce_numeric


def _rounded_mean(total: Column, n: Column, half_even: bool = False) -> Column:
    mean = money.mean_amount(total, n)
    return F.bround(mean, 2) if half_even else F.round(mean, 2)


def product_popularity(lines: DataFrame, products: DataFrame, limit: int = 15) -> DataFrame:
    """Best selling products by revenue. ``num_orders`` counts order lines;
    products missing from the catalogue stay, with null details."""
    best = (
        lines.filter(st.is_sold())
        .groupBy("product_id")
        .agg(
            F.coalesce(F.sum("quantity").cast("bigint"), F.lit(0)).alias("units_sold"),
            F.coalesce(money.sum_units("subtotal"), F.lit(0)).alias("_units"),
            F.count("*").alias("num_orders"),
        )
        .orderBy(F.desc("_units"), "product_id")
        .limit(limit)
    )
    details = products.select("product_id", F.col("name").alias("product_name"), "category_id", "base_price")
    return (
        best.join(details, "product_id", "left")
        .select(
            "product_id", "product_name", "category_id", "base_price", "units_sold",
            money.amount("_units").alias("total_revenue"),
            "num_orders",
            _rounded_mean(F.col("_units"), F.col("units_sold"), half_even=True).alias("avg_unit_price"),
        )
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(limit)
    )


def category_revenue_top(lines: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Categories by revenue; items of unknown products form a null category."""
    by_product = (
        lines.filter(st.is_sold())
        .groupBy("product_id")
        .agg(
            F.sum("quantity").cast("bigint").alias("units"),
            money.sum_units("subtotal").alias("_units"),
            F.count("*").alias("n"),
        )
    )
    return (
        by_product.join(products.select("product_id", "category_id"), "product_id", "left")
        .groupBy("category_id")
        .agg(
            F.coalesce(money.total("_units"), F.lit(0)).alias("_units"),
            F.coalesce(F.sum("units"), F.lit(0)).alias("units_sold"),
            F.sum("n").alias("num_txns"),
        )
        .select(
            "category_id",
            money.amount("_units").alias("total_revenue"),
            "units_sold",
            "num_txns",
            _rounded_mean(F.col("_units"), F.col("num_txns"), half_even=True).alias("avg_item_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category_id")
        .limit(limit)
    )


def revenue_by_category(
    lines: DataFrame, products: DataFrame, exclude_status: str | None = None, tasks: int | None = None
) -> DataFrame:
    """Distinct transactions and customers, revenue and mean item per category.

    Refunds count unless ``exclude_status`` names them. Each line stands once for its transaction and once for its
    customer, and one grouping makes both distinct, whoever a transaction belongs to. Its groups are nearly as many as
    the lines, so a task's memory is that of its share of them: ``tasks`` is the number of tasks, for lines that are
    too many for the session's shuffle partitions.
    """
    if exclude_status is not None:
        lines = lines.filter(F.col("status") != exclude_status)
    of_transaction = F.col("_side") == 0
    sides = (
        lines.join(products.select("product_id", "category_id"), "product_id")
        .withColumn("_side", F.explode(F.array(F.lit(0), F.lit(1))))
        .select(
            "category_id",
            "_side",
            F.when(of_transaction, F.col("transaction_id")).alias("transaction_id"),
            F.when(~of_transaction, F.col("user_id")).alias("user_id"),
            F.when(of_transaction, F.col("subtotal")).alias("subtotal"),
        )
    )
    once = ("category_id", "_side", "transaction_id", "user_id")
    if tasks is not None:
        sides = sides.repartition(tasks, *once)
    return (
        sides.groupBy(*once)
        .agg(money.sum_units("subtotal").alias("_units"), F.count("subtotal").alias("n"))
        .groupBy("category_id")
        .agg(
            F.count("transaction_id").alias("num_transactions"),
            F.count("user_id").alias("num_customers"),
            money.total("_units").alias("_units"),
            F.sum("n").alias("_n"),
        )
        .select(
            "category_id", "num_transactions", "num_customers",
            money.amount("_units").alias("total_revenue"),
            _rounded_mean(F.col("_units"), F.col("_n")).alias("avg_item_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category_id")
    )


def top_categories(revenue: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` categories of ``revenue_by_category`` with most revenue."""
    return revenue.orderBy(F.desc("total_revenue"), "category_id").limit(n)


def product_views(views: DataFrame) -> DataFrame:
    return views.groupBy("product_id").agg(F.count("*").alias("total_views"))


def product_purchases(lines: DataFrame) -> DataFrame:
    return (
        lines.filter(st.not_refunded())
        .groupBy("product_id")
        .agg(
            F.sum("quantity").cast("bigint").alias("units_sold"),
            money.amount(money.sum_units("subtotal")).alias("revenue"),
        )
    )


def product_performance(views: DataFrame, lines: DataFrame, products: DataFrame, how: str = "left") -> DataFrame:
    """Views against sales per product. Products never viewed are left out;
    ``how="full_outer"`` keeps the ones that were bought."""
    details = products.select("product_id", "name", "category_id", "current_price", "price_tier")
    rate = F.round(F.try_divide(F.col("units_sold").cast("double"), F.col("total_views")), 4)
    return (
        product_views(views)
        .join(product_purchases(lines), "product_id", how)
        .join(details, "product_id")
        .select(
            "product_id", "total_views", "units_sold", "revenue",
            "name", "category_id", "current_price", "price_tier",
            rate.alias("view_to_purchase_rate"),
        )
        .orderBy(F.desc("revenue"), "product_id")
    )


PERFORMANCE_NUMBERS = {
    "total_views": "bigint", "units_sold": "bigint", "revenue": "double", "current_price": "double",
    "view_to_purchase_rate": "double",
}


def views_vs_revenue(performance: DataFrame) -> DataFrame:
    """Complete rows of ``product_performance``, ready to plot per price tier.
    The table may come from text: what is no number counts as missing."""
    return coerce_numeric(performance, PERFORMANCE_NUMBERS).dropna()


def monthly_category_revenue(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Item count and revenue per month and category, refunds left out."""
    monthly = (
        lines.filter(st.not_refunded())
        .groupBy(calendar.month_start("timestamp").alias("month"), "product_id")
        .agg(F.count("*").alias("n"), money.sum_units("subtotal").alias("_units"))
    )
    return (
        monthly.join(products.select("product_id", "category_id"), "product_id")
        .groupBy("month", "category_id")
        .agg(F.sum("n").alias("num_txns"), money.total("_units").alias("_units"))
        .select(
            calendar.month_label("month").alias("txn_month"),
            "category_id",
            "num_txns",
            money.amount("_units").alias("revenue"),
        )
        .orderBy("txn_month", F.desc("revenue"), "category_id")
    )
