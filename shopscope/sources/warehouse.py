"""The retail entities over a star schema of orders and an event log.

Orders are transactions, order lines their items, parts the products, customers
the users; a user's events of one day are a session. Columns the star schema
lacks (age, device, referrer, ...) are derived from keys by arithmetic. The
mappings are select lists in SQL, one expression per column.

The flat frames (``lines``, ``views``, ``carts``) are read as they are: no array
is built per order or per session unless a result shows one.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import cleaning
from ..schemas import TIMESTAMP_FORMAT

# The columns of the tables read here.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

#: Rows of a table to a task, where its number of tasks is set by hand, and the most tasks: up to 200, a task that
#: writes for them keeps no rows in memory (``spark.shuffle.sort.bypassMergeThreshold``).
TASK_ROWS = 250_000
MOST_TASKS = 200

# The market segments, which stand for payment methods.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

# Spend and lifetime-value thresholds that suit order totals of this schema.
SPEND_TIERS = ((2_000_000, "high_value"), (1_000_000, "mid_value"))
CLV_TIERS = ((1_300_000, "platinum"), (900_000, "gold"), (500_000, "silver"))


def _iso(ts: str) -> str:
    return f"date_format({ts}, \"{TIMESTAMP_FORMAT}\")"


# How each entity's columns are read off the tables.
USER_COLUMNS = (
    "c_custkey AS user_id",
    "c_name AS name",
    "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' Buyer' || c_custkey || '@Mail.COM ' END AS email",
    "CAST(IF(c_custkey % 17 = 0, NULL, 18 + c_custkey % 53) AS int) AS age",
    "CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender",
    "named_struct('city', 'City ' || (c_custkey % 100), 'state', n_name, 'country', r_name) AS geo_data",
    "first_order AS registration_date",
    "IF(c_custkey % 13 = 0, NULL, last_order) AS last_active",
    "c_mktsegment AS preferred_payment",
)
PRODUCT_COLUMNS = (
    "p_partkey AS product_id",
    "p_name AS name",
    "p_brand AS category_id",
    "p_type AS subcategory_id",
    "p_retailprice AS base_price",
    "IF(p_partkey % 19 = 0, NULL, CAST(p_size * 10 AS double)) AS current_price",
    "IF(p_partkey % 11 = 0, NULL, p_partkey % 7 - 2) AS current_stock",
    "'1995-01-' || lpad(1 + p_partkey % 31, 2, '0') || 'T08:30:00' AS creation_date",
)
HEADER_COLUMNS = (
    "o_orderkey AS transaction_id",
    "CAST(NULL AS string) AS session_id",
    "o_custkey AS user_id",
    "o_orderdate AS timestamp",
    "o_totalprice AS total",
    "o_orderpriority AS payment_method",
    "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'refunded' END AS status",
)
LINE_COLUMNS = (
    "transaction_id", "user_id", "session_id", "timestamp", "status",
    "l_partkey AS product_id",
    "CAST(l_quantity AS bigint) AS quantity",
    "l_extendedprice / l_quantity AS unit_price",
    "l_extendedprice AS subtotal",
)
EVENT_COLUMNS = (
    "event_id", "ts", "user_id", "event_type", "value",
    "CAST(ts AS date) AS day",
    "CAST(get_json_object(props, '$.k') AS bigint) AS product_id",
)
# concat_ws is never null, so no null check of the composed text is left on the events.
SESSION_ID = "concat_ws('-', CAST(user_id AS string), date_format(day, 'yyyy-MM-dd')) AS session_id"
PURCHASE_COLUMNS = (
    "event_id AS transaction_id",
    SESSION_ID,
    "user_id",
    "ts AS timestamp",
    "value AS total",
    "'card' AS payment_method",
    "IF(product_id % 5 = 0, 'refunded', 'completed') AS status",
)
SESSION_COLUMNS = (
    SESSION_ID, "user_id", "start_time", "end_time",
    "CAST(greatest(1, unix_timestamp(end_time) - unix_timestamp(start_time)) AS bigint) AS duration_seconds",
    "named_struct('city', 'City ' || (user_id % 100), 'state', CAST(NULL AS string), "
    "'ip_address', '10.0.0.' || (user_id % 256)) AS geo_data",
    "named_struct('type', element_at(array('mobile', 'desktop', 'tablet'), CAST(user_id % 3 AS int) + 1), "
    "'os', element_at(array('iOS', 'Android', 'Windows', 'macOS', 'iPadOS'), CAST(user_id % 5 AS int) + 1), "
    "'browser', element_at(array('Safari', 'Chrome'), CAST(user_id % 2 AS int) + 1)) AS device_profile",
    "viewed_products", "cart_contents",
    "IF(purchases > 0, 'converted', 'abandoned') AS conversion_status",
    "element_at(array('search_engine', 'social_media', 'direct', 'email', 'affiliate', NULL), "
    "CAST((user_id + dayofmonth(day)) % 6 AS int) + 1) AS referrer",
    "viewed_count", "cart_count", "page_count",
)


class Warehouse:
    """Cleaned frames over a folder of star-schema Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def tasks(self, name: str) -> int | None:
        """Tasks for a shuffle of the rows of a table, about ``TASK_ROWS`` to each; none where the session's partitions do."""
        tasks = min(MOST_TASKS, -(-self.table(name).count() // TASK_ROWS))
        return tasks if tasks > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else None

    # Documents: the layout the cleaning step starts from, timestamps as text.

    def user_documents(self) -> DataFrame:
        """Customers; an unknown date is no date at all in the text."""
        users = self._users()
        text = {
            "registration_date": f"{_iso('registration_date')} AS registration_date",
            "last_active": f"coalesce({_iso('last_active')}, 'unknown') AS last_active",
        }
        return users.selectExpr(*(text.get(c, c) for c in users.columns))

    def product_documents(self) -> DataFrame:
        return self.table("part").selectExpr(*PRODUCT_COLUMNS)

    def transaction_documents(self) -> DataFrame:
        return self._headers().selectExpr(
            "transaction_id", "session_id", "user_id", f"{_iso('timestamp')} AS timestamp", "total",
            "'  ' || payment_method || ' ' AS payment_method", "status",
        )

    def session_documents(self) -> DataFrame:
        sessions = self._sessions()
        text = {c: f"{_iso(c)} AS {c}" for c in ("start_time", "end_time")}
        return sessions.selectExpr(*(text.get(c, c) for c in sessions.columns))

    # Cleaned frames.

    @cached_property
    def users(self) -> DataFrame:
        return cleaning.clean_users(self._users())

    @cached_property
    def products(self) -> DataFrame:
        return cleaning.clean_products(self.product_documents())

    @cached_property
    def transactions(self) -> DataFrame:
        return cleaning.clean_transactions(self._headers())

    @cached_property
    def sessions(self) -> DataFrame:
        return cleaning.clean_sessions(self._sessions())

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with the header columns of their transaction."""
        return (
            self.table("lineitem")
            .join(self.transactions, F.expr("l_orderkey = transaction_id"))
            .selectExpr(*LINE_COLUMNS)
        )

    @cached_property
    def views(self) -> DataFrame:
        """Products viewed or clicked, once per session."""
        seen = self._events("view", "click").select("user_id", "day", "product_id").distinct()
        return seen.selectExpr(SESSION_ID, "user_id", "day AS start_time", "product_id")

    @cached_property
    def carts(self) -> DataFrame:
        """Products clicked into the cart, once per session."""
        clicked = self._events("click").groupBy("user_id", "day", "product_id").agg(
            F.expr("count(*) AS quantity"), F.expr("max(abs(value)) AS price")
        )
        return clicked.selectExpr(SESSION_ID, "user_id", "day AS start_time", "product_id", "quantity", "price")

    @cached_property
    def activity(self) -> DataFrame:
        """Views and carts in one: products viewed or clicked, once per session, with whether they went into the cart."""
        touched = self._events("view", "click").groupBy("user_id", "day", "product_id").agg(
            F.expr("max(IF(event_type = 'click', 1, 0)) AS carted")
        )
        return touched.selectExpr(SESSION_ID, "user_id", "day AS start_time", "product_id", "1 AS viewed", "carted")

    @cached_property
    def session_transactions(self) -> DataFrame:
        """Purchase events as transactions of their session; the orders are of
        other years than the events and belong to none."""
        return cleaning.clean_transactions(self._events("purchase").selectExpr(*PURCHASE_COLUMNS))

    def _users(self) -> DataFrame:
        span = self.table("orders").groupBy("o_custkey").agg(
            F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
        )
        return (
            self.table("customer")
            .join(span, F.expr("c_custkey = o_custkey"), "left")
            .join(self.table("nation"), F.expr("c_nationkey = n_nationkey"))
            .join(self.table("region"), F.expr("n_regionkey = r_regionkey"))
            .selectExpr(*USER_COLUMNS)
        )

    def _headers(self) -> DataFrame:
        return self.table("orders").selectExpr(*HEADER_COLUMNS)

    def _events(self, *event_types: str) -> DataFrame:
        """Events of the given types (all, if none) with their day and product.
        Events without a user or time belong to no session."""
        events = self.table("events").filter("user_id IS NOT NULL AND ts IS NOT NULL")
        if event_types:
            events = events.filter(F.col("event_type").isin(*event_types))
        return events.selectExpr(*EVENT_COLUMNS)

    def _sessions(self) -> DataFrame:
        # One row per session and product first: that spreads the events of a busy session.
        by_product = self._events().groupBy("user_id", "day", "product_id").agg(
            F.expr("date_trunc('second', min(ts)) AS first"),
            F.expr("date_trunc('second', max(ts)) AS last"),
            F.expr("count_if(event_type IN ('view', 'click')) > 0 AS seen"),
            F.expr("count_if(event_type = 'click') AS clicks"),
            F.expr("count_if(event_type = 'purchase') AS purchases"),
            F.expr("max(IF(event_type = 'click', abs(value), NULL)) AS price"),
            F.expr("count(*) AS events"),
        )
        line = "struct(product_id, struct(CAST(clicks AS int) AS quantity, price))"
        return (
            by_product.groupBy("user_id", "day")
            .agg(
                F.expr("min(first) AS start_time"),
                F.expr("max(last) AS end_time"),
                F.expr("count_if(seen) AS viewed_count"),
                F.expr("count_if(clicks > 0) AS cart_count"),
                F.expr("sum(events) AS page_count"),
                F.expr("sum(purchases) AS purchases"),
                F.expr("sort_array(collect_list(IF(seen, product_id, NULL))) AS viewed_products"),
                F.expr(f"map_from_entries(sort_array(collect_list(IF(clicks > 0, {line}, NULL)))) AS cart_contents"),
            )
            .selectExpr(*SESSION_COLUMNS)
        )
