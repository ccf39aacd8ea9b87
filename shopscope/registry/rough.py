"""Documents with faults: each rule of the load and of the cleaning step is broken by some rows.

Which rows is a matter of their key, so that SQL can say the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.warehouse import Warehouse

#: Texts beside the proper files: a document with a field that cannot be read and a number where a document belongs; an array that breaks off.
BROKEN_FILES = {
    "users": ('[{"user_id": "extra", "name": "X", "registration_date": "2024-01-01T00:00:00", "age": "old"}, 7]', '[{"user_id": "lost"}, {"user_'),
}

COLUMNS = {
    "categories": ("category_id", "name"),
    "users": (
        "IF(user_id % 101 = 0, NULL, CAST(user_id AS string)) AS user_id", "name",
        "CASE WHEN user_id % 101 = 0 OR user_id % 5 = 0 THEN NULL WHEN user_id % 70 = 3 THEN 'shared@mail.com' ELSE name || '@mail.com' END AS email",
        "age", "gender", "geo_data", "registration_date", "last_active", "preferred_payment"),
    "products": (
        "CAST(product_id AS string) AS product_id", "name", "IF(product_id % 23 = 0, NULL, category_id) AS category_id", "subcategory_id",
        "IF(product_id % 29 = 0, NULL, base_price) AS base_price", "current_price", "current_stock", "creation_date"),
    "transactions": (
        "CAST(transaction_id AS string) AS transaction_id", "session_id", "IF(transaction_id % 41 = 0, NULL, CAST(user_id AS string)) AS user_id",
        "IF(transaction_id % 43 = 0, NULL, timestamp) AS timestamp", "CASE WHEN transaction_id % 37 = 0 THEN NULL WHEN transaction_id % 31 = 0 THEN 0D ELSE total END AS total",
        "payment_method", "status", "items"),
    "sessions": (
        "IF(user_id % 19 = 0, NULL, session_id) AS session_id", "user_id", "IF(user_id % 17 = 0, NULL, start_time) AS start_time", "end_time",
        "IF(user_id % 13 = 0, 0L, duration_seconds) AS duration_seconds", "device_profile", "conversion_status", "referrer"),
}
#: Rows that come twice, by the key of the table they are made of.
COPIES = {"users": "user_id % 50 = 1", "products": "product_id % 40 = 7", "transactions": "transaction_id % 60 = 5"}


def documents(w: Warehouse, entity: str) -> DataFrame:
    made = {
        "categories": lambda: w.table("part").selectExpr("p_brand AS category_id", "'The ' || p_brand AS name").distinct(),
        "users": w.user_documents, "products": w.product_documents, "transactions": lambda: _orders(w), "sessions": w.session_documents,
    }[entity]()
    if entity in COPIES:
        made = made.withColumn("_times", F.expr(f"IF({COPIES[entity]}, array(1, 2), array(1))")).withColumn("_times", F.explode("_times")).drop("_times")
    return made.selectExpr(*COLUMNS[entity])


def _orders(w: Warehouse) -> DataFrame:
    """Orders with their items, one product in fifty unknown."""
    items = w.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.expr(
        "struct(IF(l_partkey % 50 = 0, 'gone-', '') || l_partkey AS product_id, CAST(l_quantity AS bigint) AS quantity, "
        "l_extendedprice / l_quantity AS unit_price, l_extendedprice AS subtotal)")).alias("items"))
    return w.transaction_documents().join(items, F.expr("transaction_id = l_orderkey"), "left").drop("l_orderkey")
