"""Products that sell or are viewed together."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.pairs import Signal, top_pairs


def _known_items(products: DataFrame) -> DataFrame:
    return products.select(F.col("product_id").alias("item"))


def co_purchase_pairs(
    lines: DataFrame, products: DataFrame, limit: int = 20, exclude_status: str | None = None
) -> DataFrame:
    """Product pairs most often bought in one transaction. Refunds count unless
    ``exclude_status`` names them. Names are looked up for the leading pairs
    only; pairs with a product outside the catalogue are not eligible."""
    if exclude_status is not None:
        lines = lines.filter(F.col("status") != exclude_status)
    signal = Signal(lines, "transaction_id", "product_id", "co_purchase_count")
    best = top_pairs([signal], _known_items(products), limit).withColumnsRenamed(
        {"item_a": "product_a", "item_b": "product_b"}
    )
    names = products.select("product_id", "name")
    for side in ("product_a", "product_b"):
        best = best.join(names.withColumnsRenamed({"product_id": side, "name": f"{side}_name"}), side)
    return (
        best.select("product_a", "product_a_name", "product_b", "product_b_name", "co_purchase_count")
        .orderBy(F.desc("co_purchase_count"), "product_a", "product_b")
        .limit(limit)
    )


def product_affinity(
    lines: DataFrame,
    views: DataFrame,
    products: DataFrame,
    w_buy: float = 3.0,
    w_view: float = 1.0,
    limit: int = 200,
) -> DataFrame:
    """Product pairs by weighted count of joint purchases and joint views.

    Both signals run through one pair count, which stands for a full outer join
    of two counts with missing sides read as zero. Pairs are picked and sorted by
    the score as shown, rounded to two places.
    """
    signals = [
        Signal(lines, "transaction_id", "product_id", "purchase_together", w_buy),
        Signal(views, "session_id", "product_id", "viewed_together", w_view),
    ]
    best = top_pairs(signals, _known_items(products), limit, scale=2)
    details = products.select("product_id", "name", "category_id", "price_tier")
    for s in ("a", "b"):
        best = best.withColumnRenamed(f"item_{s}", f"prod_{s}").join(
            details.withColumnsRenamed({
                "product_id": f"prod_{s}", "name": f"name_{s}", "category_id": f"cat_{s}", "price_tier": f"tier_{s}",
            }),
            f"prod_{s}",
        )
    return (
        best.select(
            "prod_a", "name_a", "cat_a", "tier_a", "prod_b", "name_b", "cat_b", "tier_b",
            "purchase_together", "viewed_together", F.col("score").alias("affinity_score"),
        )
        .orderBy(F.desc("affinity_score"), "prod_a", "prod_b")
        .limit(limit)
    )
