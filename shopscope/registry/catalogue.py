"""Every analytic and operator as a named query over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import calendar, rowkeys, status as st
from ..operators import cleaning, keyed, pairs
from ..plans import affinity, cohorts, customers, funnels, products, trends
from ..schemas import TIMESTAMP_FORMAT
from ..session import scratch_dir
from ..sources import buckets, documents, loading, results
from ..sources.warehouse import CLV_TIERS, SEGMENTS, SPEND_TIERS, Warehouse
from ..streaming import jobs
from . import rough

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
    """Register a function of the warehouse under its own name."""
    QUERIES[fn.__name__] = lambda spark, folder: fn(Warehouse(spark, folder))
    return fn


def _as_text(df: DataFrame, *timestamps: str) -> DataFrame:
    """Timestamps in their document format, for comparison across engines."""
    return df.withColumns({c: F.date_format(c, TIMESTAMP_FORMAT) for c in timestamps})


# Products and categories


@query
def product_popularity(w):
    return products.product_popularity(w.lines, w.products)


@query
def category_revenue_top(w):
    return products.category_revenue_top(w.lines, w.products)


@query
def revenue_by_category(w):
    return products.revenue_by_category(w.lines, w.products, tasks=w.tasks("lineitem"))


@query
def top_categories_chart(w):
    return products.top_categories(revenue_by_category(w))


@query
def product_views(w):
    return products.product_views(w.views)


@query
def product_purchases(w):
    return products.product_purchases(w.lines)


@query
def product_performance(w):
    return products.product_performance(w.views, w.lines, w.products)


@query
def product_performance_all(w):
    return products.product_performance(w.views, w.lines, w.products, how="full_outer")


@query
def views_vs_revenue(w):
    return products.views_vs_revenue(products.product_performance(w.views, w.lines, w.products))


@query
def monthly_category_revenue(w):
    return products.monthly_category_revenue(w.lines, w.products)


# Pairs


@query
def co_purchase_pairs(w):
    return affinity.co_purchase_pairs(w.lines, w.products)


@query
def product_affinity(w):
    return affinity.product_affinity(w.lines, w.views, w.products)


@query
def item_pairs_purchase(w):
    return pairs.item_pairs(w.lines, "transaction_id", "product_id", "purchase_together")


@query
def item_pairs_view(w):
    return pairs.item_pairs(w.views, "session_id", "product_id", "viewed_together")


# Cohorts


@query
def cohort_analysis(w):
    return cohorts.cohort_analysis(w.transactions, w.users)


@query
def cohort_pivot(w):
    return cohorts.cohort_pivot(cohorts.cohort_analysis(w.transactions, w.users))


@query
def cohort_revenue_matrix(w):
    return cohorts.cohort_revenue_matrix(cohorts.cohort_analysis(w.transactions, w.users), offsets=range(5))


# Customers


@query
def user_spend_profile(w):
    return results.flat(customers.user_spend_profile(w.transactions, tiers=SPEND_TIERS))


@query
def user_spend_profile_high(w):
    return results.flat(customers.user_spend_profile(w.transactions, "high_value", tiers=SPEND_TIERS))


@query
def user_segmentation_by_age(w):
    return customers.user_segmentation_by_age(w.transactions, w.users, tiers=SPEND_TIERS)


@query
def user_segments(w):
    return customers.user_segments(w.users, w.transactions, tiers=SPEND_TIERS)


@query
def age_payment_spend_matrix(w):
    segments = customers.user_segments(w.users, w.transactions, tiers=SPEND_TIERS)
    return customers.age_payment_spend_matrix(segments, SEGMENTS)


@query
def txn_metrics(w):
    return customers.txn_metrics(w.transactions)


@query
def session_metrics(w):
    return customers.session_metrics(w.sessions)


def _clv(w: Warehouse, **options) -> DataFrame:
    return customers.clv_scores(w.users, w.transactions, w.sessions, tiers=CLV_TIERS, **options)


@query
def clv_scores(w):
    return _clv(w)


@query
def clv_scores_filled(w):
    return _clv(w, fill_converted=True)


@query
def top_customers(w):
    return customers.top_customers(_clv(w))


@query
def clv_segment_distribution(w):
    return customers.clv_segment_distribution(_clv(w))


@query
def clv_segment_dense(w):
    return customers.clv_segment_dense(_clv(w))


# Funnels


@query
def conversion_funnel(w):
    return funnels.conversion_funnel(w.sessions)


@query
def conversion_funnel_cart(w):
    return funnels.conversion_funnel(w.sessions, cart_source="cart")


@query
def funnel_percentages(w):
    return funnels.funnel_percentages(funnels.conversion_funnel(w.sessions))


@query
def funnel_flags(w):
    return funnels.funnel_flags(w.sessions).select(
        "session_id", "reached_product_view", "reached_cart", "reached_purchase"
    )


@query
def funnel_analysis(w):
    return results.flat(funnels.funnel_analysis(w.sessions))


@query
def funnel_totals(w):
    return funnels.funnel_totals(funnels.funnel_analysis(w.sessions))


@query
def funnel_by_device(w):
    return funnels.funnel_by_device(funnels.funnel_analysis(w.sessions))


@query
def funnel_by_referrer(w):
    return funnels.funnel_by_referrer(funnels.funnel_analysis(w.sessions))


@query
def device_conversion(w):
    return funnels.device_conversion(funnels.funnel_analysis(w.sessions))


@query
def device_referrer_stats(w):
    return funnels.device_referrer_stats(w.sessions)


@query
def revenue_by_referrer(w):
    return funnels.revenue_by_referrer(w.sessions, w.session_transactions)


@query
def session_weekly_trend(w):
    return funnels.session_weekly_trend(w.sessions)


# Trends


@query
def weekly_revenue(w):
    return trends.weekly_revenue(w.transactions)


@query
def weekly_trend(w):
    return trends.weekly_trend(w.transactions)


@query
def product_daily_metrics(w):
    return trends.product_daily_metrics(lines=w.lines, activity=w.activity)


@query
def product_view_metrics(w):
    """The counters a load from sessions alone can fill."""
    return trends.product_daily_metrics(w.views)


# Cleaning


@query
def clean_users(w):
    return _as_text(cleaning.clean_users(w.user_documents()), "registration_date", "last_active")


@query
def clean_users_lenient(w):
    return _as_text(cleaning.clean_users(w.user_documents(), strict=False), "registration_date")


@query
def users_load_form(w):
    return cleaning.load_users(w.user_documents()).select("user_id", "email", "age", "age_group")


@query
def clean_products(w):
    return _as_text(w.products, "creation_date")


@query
def clean_transactions(w):
    cleaned = cleaning.clean_transactions(w.transaction_documents())
    return _as_text(cleaned, "timestamp").drop("session_id")


@query
def clean_sessions(w):
    cleaned = cleaning.clean_sessions(w.session_documents())
    return _as_text(cleaned, "start_time", "end_time").drop("geo_data", "viewed_products", "cart_contents")


@query
def clean_products_lenient(w):
    """Faulty products, leniently cleaned: none is dropped, prices are filled and banded, stock stays as it came."""
    cleaned = cleaning.clean_products(rough.documents(w, "products"), strict=False)
    return cleaned.select("product_id", "category_id", "base_price", "current_price", "current_stock", "price_tier")


@query
def clean_transactions_lenient(w):
    """Faulty orders, leniently cleaned: only those without a positive total go."""
    cleaned = cleaning.clean_transactions(rough.documents(w, "transactions").drop("items"), strict=False)
    return cleaned.select("transaction_id", "user_id", "total", "payment_method", "txn_date", "txn_month", "txn_week")


@query
def clean_sessions_lenient(w):
    """Faulty sessions, leniently cleaned: only those without a positive duration go; the end stays text."""
    cleaned = cleaning.clean_sessions(rough.documents(w, "sessions"), strict=False)
    return cleaned.select("session_id", "user_id", F.date_format("start_time", TIMESTAMP_FORMAT).alias("start_time"), "end_time", "duration_seconds", "device_type", "device_os")


@query
def status_filter_forms(w):
    """Transactions kept by each form of the status filter; orders without a
    stated priority stand for transactions without a status."""
    stated = F.when(F.col("payment_method") != "4-not specified", F.col("status"))
    forms = {
        "sold": st.is_sold(),
        "not_refunded": st.not_refunded(),
        "not_refunded_or_null": st.not_refunded_or_null(),
    }
    return w.transactions.withColumn("status", stated).agg(
        *(F.count_if(test).alias(name) for name, test in forms.items())
    )


@query
def us_week(w):
    """Week label of every day with orders."""
    days = w.transactions.select(F.col("txn_date").alias("day")).distinct()
    return days.select("day", calendar.us_week("day").alias("week"))


# Keyed tables


@query
def duplicate_keys(w):
    """Values that occur more than once in columns meant, or not, as keys."""
    checks = [
        ("users", w.user_documents(), "user_id", False),
        ("users", w.user_documents(), "email", True),
        ("products", w.product_documents(), "product_id", False),
        ("products", w.product_documents(), "name", False),
        ("transactions", w.transaction_documents(), "transaction_id", False),
        ("lineitem", w.table("lineitem"), "l_orderkey", False),
    ]
    out = None
    for table, df, key, sparse in checks:
        part = keyed.duplicate_keys(df, key, sparse).select(
            F.lit(table).alias("table"), F.lit(key).alias("key"),
            F.col(key).cast("string").alias("value"), "row_count",
        )
        out = part if out is None else out.unionByName(part)
    return out


def _new_listings(w: Warehouse) -> DataFrame:
    """A change set for the products: a price for every other size, no stock
    where the size is odd, and a second listing for the largest parts."""
    part = w.table("part")
    changed = part.filter("p_size % 2 = 0 or p_size > 40").select(
        F.col("p_partkey").alias("product_id"),
        (F.col("p_size") * 9.0).alias("current_price"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("bigint")).alias("current_stock"),
    )
    added = part.filter("p_size = 50").select(
        (F.col("p_partkey") + 1_000_000_000_000).alias("product_id"),
        F.lit(450.0).alias("current_price"),
        F.lit(None).cast("bigint").alias("current_stock"),
    )
    return changed.unionByName(added)


def _stock_table(w: Warehouse) -> DataFrame:
    return w.product_documents().select("product_id", "name", "current_price", "current_stock")


@query
def upsert_products(w):
    return keyed.upsert(_stock_table(w), _new_listings(w), "product_id")


@query
def upsert_inserted(w):
    new = keyed.inserted_keys(_stock_table(w), _new_listings(w), "product_id")
    return new.agg(F.count("*").alias("inserted"))


@query
def upsert_sales_feed(w):
    """Order lines as a feed of updates to the products, many per key: the
    latest price, and the latest quantity among the returned lines."""
    feed = w.table("lineitem").select(
        F.col("l_partkey").alias("product_id"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("current_price"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("bigint")).alias("current_stock"),
        F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity").alias("seq"),
    )
    return keyed.upsert(_stock_table(w), feed, "product_id", order="seq")


@query
def last_write(w):
    """The newest order of every customer."""
    rows = w.transactions.select("user_id", "transaction_id", "timestamp", "total")
    return _as_text(keyed.last_write(rows, "user_id", ["timestamp", "transaction_id"]), "timestamp")


@query
def latest_sessions(w):
    rows = w.sessions.select("user_id", "session_id", "start_time", "device_type", "conversion_status")
    return _as_text(keyed.latest_sessions(rows, 5), "start_time")


@query
def wide_sessions(w):
    return keyed.last_write(keyed.wide_sessions(w.sessions), "row_key", "session_id")


@query
def user_sessions_lookup(w):
    return _as_text(keyed.user_sessions(w.sessions, 7, limit=5), "start_time")


@query
def row_key_lookup(w):
    """Sessions of one user by a prefix of the row key, then one by its key, in the stored wide table."""
    folder = scratch_dir(w.spark)
    results.write_wide_sessions(keyed.wide_sessions(w.sessions), f"{folder}/wide")
    wide = w.spark.read.parquet(f"{folder}/wide")
    newest = keyed.prefix_get(wide, "7#").agg(F.min("row_key")).first()[0]
    return keyed.point_get(wide, newest).select("row_key", "session_id", "start_time", "conversion")


@query
def upsert_stored(w):
    """New listings merged into the stored products, of which only the buckets of their keys are rewritten."""
    table = buckets.BucketedTable(w.spark, f"{scratch_dir(w.spark)}/stock", "product_id", 16)
    table.create(_stock_table(w))
    table.upsert(_new_listings(w))
    return table.read()


@query
def upsert_stored_counts(w):
    """Inserted and matched keys, counted while the buckets are rewritten."""
    table = buckets.BucketedTable(w.spark, f"{scratch_dir(w.spark)}/stock", "product_id", 16)
    table.create(_stock_table(w))
    counts = table.upsert(_new_listings(w))
    return w.spark.createDataFrame([(counts["inserted"], counts["matched"])], "inserted bigint, matched bigint")


@query
def metric_range(w):
    metrics = trends.product_daily_metrics(lines=w.lines, activity=w.activity)
    return keyed.metric_range(metrics, 42, "2024-01-05", "2024-01-20")


@query
def metric_columns(w):
    metrics = trends.product_daily_metrics(lines=w.lines, activity=w.activity)
    return keyed.metric_range(metrics, 42, "1995-01-01", "2024-12-31", columns=["views", "revenue"])


@query
def retention(w):
    """Daily metrics no older than 90 days at the end of March 2024."""
    metrics = trends.product_daily_metrics(lines=w.lines, activity=w.activity)
    return keyed.retained(metrics, "metric_date", "2024-04-10")


# Sources and sinks


@query
def documents_landed(w):
    """The products through the document reader: written as JSON, read back
    with the declared schema, landed as Parquet and cleaned."""
    folder = scratch_dir(w.spark)
    w.product_documents().withColumn("product_id", F.col("product_id").cast("string")).write.json(
        f"{folder}/products.json"
    )
    raw = documents.read_documents(w.spark, f"{folder}/products.json", "products", multiline=False, pattern="*.json")
    results.write_parquet(raw, f"{folder}/landed/products")
    landed = documents.read_landed(w.spark, f"{folder}/landed", "products")
    return _as_text(cleaning.clean_products(landed), "creation_date").select(
        "product_id", "name", "category_id", "base_price", "current_price", "current_stock",
        "creation_date", "price_tier",
    )


def _array_files(df: DataFrame, key: str, path: str, rows: int, per_file: int = 10_000) -> None:
    """Documents as JSON arrays, one to a file, of about ``per_file`` documents each however many (``rows``) there are."""
    files = max(1, -(-rows // per_file))
    arrays = df.groupBy(F.pmod(F.xxhash64(key), F.lit(files)).alias("file")).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    arrays.write.partitionBy("file").text(path)


def _transactions_with_items(w: Warehouse) -> DataFrame:
    """An order holds a handful of lines, so its items fit in its document."""
    items = w.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.expr(
        "struct(l_partkey AS product_id, CAST(l_quantity AS bigint) AS quantity, "
        "l_extendedprice / l_quantity AS unit_price, l_extendedprice AS subtotal)"
    )).alias("items"))
    return w.transaction_documents().join(items, F.expr("transaction_id = l_orderkey"), "left").drop("l_orderkey")


def _loaded(w: Warehouse, *entities: str, strict: bool = True) -> documents.Store:
    """Some entities written as files of JSON arrays, loaded, and cleaned."""
    folder = scratch_dir(w.spark)
    sources = {
        "products": (w.product_documents, "product_id", "part", 10_000),
        "transactions": (lambda: _transactions_with_items(w), "transaction_id", "orders", 10_000),
        "sessions": (w.session_documents, "session_id", "customer", 1_000),
    }
    for entity in entities:
        make, key, counted, per_file = sources[entity]
        _array_files(make(), key, f"{folder}/json/{entity}", w.table(counted).count(), per_file)
        loading.load_entity(w.spark, f"{folder}/json/{entity}", f"{folder}/tables", entity, pattern="*.txt")
    return documents.Store(w.spark, f"{folder}/tables", strict)


def _numbered(df: DataFrame) -> DataFrame:
    """Product ids, text in the documents, as the numbers of the tables."""
    return df.withColumn("product_id", F.col("product_id").cast("bigint"))


@query
def documents_popularity(w):
    """Best sellers from nested transactions: ``explode`` of their items."""
    shop = _loaded(w, "products", "transactions")
    return _numbered(products.product_popularity(shop.lines, shop.products))


@query
def documents_daily_metrics(w):
    """Daily metrics from nested sessions (views, cart) and transactions."""
    shop = _loaded(w, "transactions", "sessions")
    return _numbered(trends.product_daily_metrics(shop.views, shop.carts, shop.lines))


@query
def documents_funnel(w):
    """The funnel from sessions in several files: sizes of their collections."""
    return funnels.conversion_funnel(_loaded(w, "sessions").sessions)


@query
def documents_devices(w):
    """Device statistics from sessions in several files: fields of their structs."""
    return funnels.device_referrer_stats(_loaded(w, "sessions").sessions)


@query
def documents_views_sql(w):
    """Views per product in SQL over the named sessions."""
    documents.register_views(_loaded(w, "sessions"), "sessions")
    return w.spark.sql("""
        SELECT CAST(product_id AS bigint) AS product_id, count(*) AS total_views
        FROM sessions LATERAL VIEW explode(viewed_products) AS product_id GROUP BY 1""")


def _rough(w: Warehouse, *entities: str) -> tuple[DataFrame, str]:
    """Documents with every fault that a load knows, loaded: its report, and the folder of its tables."""
    folder = scratch_dir(w.spark)
    for entity in entities:
        key, counted, per_file = {
            "categories": ("category_id", "nation", 10_000), "users": ("name", "customer", 10_000), "products": ("product_id", "part", 10_000),
            "transactions": ("transaction_id", "orders", 10_000), "sessions": ("user_id", "customer", 1_000)}[entity]
        _array_files(rough.documents(w, entity), key, f"{folder}/json/{entity}", w.table(counted).count(), per_file)
        for n, text in enumerate(rough.BROKEN_FILES.get(entity, ())):
            w.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder}/json/{entity}/broken-{n}")
    patterns = dict.fromkeys(entities, "*.txt")
    reports = [loading.load(w.spark, f"{folder}/json/{e}", f"{folder}/tables", True, [e], patterns) for e in entities]
    return reduce(DataFrame.unionByName, reports), f"{folder}/tables"


@query
def load_report(w):
    """Rows read, kept and refused, by table and rule, of a load of faulty documents."""
    return _rough(w, "categories", "users", "products", "transactions", "sessions")[0]


@query
def load_rejects(w):
    """What the load of faulty users and products refused, by reason and key."""
    _, folder = _rough(w, "users", "products")
    found = loading.rejects(w.spark, folder, "users", "products")
    key = F.regexp_extract("reason", "(.*) repeated", 1)
    # The only other columns of use are in the text of the refused row.
    value = F.when(key == "user_id", F.get_json_object("text", "$.user_id")).when(key == "email", F.get_json_object("text", "$.email")).when(
        key == "product_id", F.get_json_object("text", "$.product_id"))
    return found.groupBy("table", "reason", value.alias("value")).agg(F.count("*").alias("rows"))


@query
def rough_revenue(w):
    """Revenue by category of faulty documents: lines of unknown products and products without a category vanish."""
    shop = documents.Store(w.spark, _rough(w, "products", "transactions")[1])
    return products.revenue_by_category(shop.lines, shop.products, tasks=w.tasks("lineitem"))


@query
def rough_categories(w):
    """Leading categories of faulty documents, leniently cleaned: lines of unknown products are a category of their own."""
    shop = documents.Store(w.spark, _rough(w, "products", "transactions")[1], strict=False)
    return products.category_revenue_top(shop.lines, shop.products)


@query
def rough_cohorts(w):
    """Cohorts of faulty documents: users without an id or a date and orders of nobody vanish.

    Of the users of a shared email the one first read stays, which the file order decides; they are left out.
    """
    shop = documents.Store(w.spark, _rough(w, "users", "transactions")[1])
    return cohorts.cohort_analysis(shop.transactions, shop.users.filter("email <> 'shared@mail.com'"))


@query
def clean_users_without_columns(w):
    """Users whose documents lack two optional columns."""
    users = cleaning.clean_users(w.user_documents().drop("gender", "age"))
    return users.select("user_id", "email", "age", "gender", "age_group", "reg_month")


@query
def results_as_csv(w):
    """Funnel sessions through the CSV sink and back, all part files."""
    folder = scratch_dir(w.spark)
    funnel = funnels.funnel_analysis(w.sessions)
    results.write_csv(funnel, f"{folder}/funnel_analysis")
    return results.read_csv(w.spark, f"{folder}/funnel_analysis", funnel.schema)


@query
def views_vs_revenue_from_csv(w):
    """Product performance through CSV, read back as text and coerced."""
    folder = scratch_dir(w.spark)
    performance = products.product_performance(w.views, w.lines, w.products)
    results.write_csv(performance, f"{folder}/product_performance")
    text = StructType([StructField(c, StringType()) for c in performance.columns])
    return products.views_vs_revenue(results.read_csv(w.spark, f"{folder}/product_performance", text))


@query
def metrics_table(w):
    """Daily metrics through their partitioned table, one product's year read back."""
    folder = scratch_dir(w.spark)
    metrics = trends.product_daily_metrics(lines=w.lines, activity=w.activity)
    results.write_daily_metrics(metrics, f"{folder}/product_metrics")
    stored = w.spark.read.parquet(f"{folder}/product_metrics")
    return keyed.metric_range(stored, 42, "2024-01-01", "2024-12-31")


# Streams


def _event_stream(w: Warehouse) -> DataFrame:
    schema = w.table("events").schema
    # The pattern matches a single file as well as a folder of part files.
    events = w.spark.readStream.schema(schema).parquet(f"{w.folder}/events.parquet*")
    return events.withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "product_id": F.get_json_object("props", "$.k").cast("bigint"),
    })


@query
def stream_daily_views(w):
    """Events as a stream of daily view counters per product, as ``product_view_metrics`` has them in batch."""
    folder = scratch_dir(w.spark)
    seen = _event_stream(w).filter("event_type IN ('view', 'click') AND user_id IS NOT NULL AND ts IS NOT NULL")
    jobs.write_batches(jobs.daily_views(seen), f"{folder}/views", f"{folder}/checkpoint", "append").awaitTermination()
    return jobs.daily_view_counts(w.spark, f"{folder}/views")


def _out_of_order(w: Warehouse, folder: str) -> DataFrame:
    """The views as a stream of files in which a part of every day comes with the file of a later one."""
    seen = w.table("events").filter("event_type IN ('view', 'click') AND user_id IS NOT NULL AND ts IS NOT NULL").withColumns({
        "ts": F.col("ts").cast("timestamp"), "product_id": F.get_json_object("props", "$.k").cast("bigint")})
    # A file per fifth of the days; one user in seven comes with the last one.
    file = F.when(F.col("user_id") % 7 == 0, 5).otherwise(F.pmod(F.floor(F.unix_date(F.to_date("ts")) / 7), F.lit(5)))
    rows = seen.select("product_id", "user_id", "ts", file.cast("int").alias("n"))
    rows.repartitionByRange(6, "n").sortWithinPartitions("n").write.partitionBy("n").parquet(f"{folder}/files")
    return w.spark.readStream.schema("product_id bigint, user_id bigint, ts timestamp").option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(f"{folder}/files")


@query
def stream_late_views(w):
    """Daily views from files out of order: late rows are kept aside and the days they belong to counted again."""
    folder = scratch_dir(w.spark)
    jobs.write_views_with_late(_out_of_order(w, folder), f"{folder}/views", f"{folder}/late", f"{folder}/checkpoint").awaitTermination()
    jobs.correct_days(w.spark, f"{folder}/views", f"{folder}/late", f"{folder}/daily")
    return w.spark.read.parquet(f"{folder}/daily").select("product_id", "metric_date", "views")


@query
def retention_stored(w):
    """Daily views in a table by day: half of the days are counted anew, and days before a date are removed by their folders."""
    folder = f"{scratch_dir(w.spark)}/daily"
    daily = trends.product_daily_metrics(w.views).select("product_id", "metric_date", "views")
    buckets.replace_days(daily.withColumn("views", F.when(F.dayofmonth("metric_date") % 2 == 0, F.col("views")).otherwise(0)), folder)
    buckets.replace_days(daily.filter(F.dayofmonth("metric_date") % 2 == 1), folder)
    buckets.drop_days(w.spark, folder, "2024-01-11")
    return w.spark.read.parquet(folder).select("product_id", "metric_date", "views")


@query
def stream_folded_events(w):
    """The latest activity per user and day once its batches are folded into a snapshot, and some come after it."""
    folder = scratch_dir(w.spark)
    rows = w.table("events").selectExpr("event_id", "CAST(ts AS timestamp) AS ts", "user_id", "event_type", "CAST(ts AS date) AS day")
    for n in range(4):
        if n == 3:
            jobs.fold_batches(w.spark, f"{folder}/latest", ["user_id", "day"], ["ts", "event_id"])
        batch = rows.filter(F.pmod("event_id", F.lit(4)) == n)
        keyed.last_write(batch, ["user_id", "day"], ["ts", "event_id"]).write.parquet(f"{folder}/latest/batch_id={n}")
    latest = jobs.read_latest(w.spark, f"{folder}/latest", ["user_id", "day"], ["ts", "event_id"])
    return latest.select("user_id", "day", "event_id", "event_type")


@query
def stream_latest_events(w):
    """Events as a stream of the latest activity per user and day."""
    folder = scratch_dir(w.spark)
    rows = _event_stream(w).select(
        "event_id", "ts", "user_id", "event_type", "product_id", F.to_date("ts").alias("day"),
    )
    once = jobs.distinct_rows(rows, ["event_id"], "ts")
    jobs.write_batches(
        once, f"{folder}/latest", f"{folder}/checkpoint", "append", ["user_id", "day"], ["ts", "event_id"]
    ).awaitTermination()
    latest = jobs.read_latest(w.spark, f"{folder}/latest", ["user_id", "day"], ["ts", "event_id"])
    return latest.select(
        rowkeys.session_key("user_id", "ts").alias("row_key"), "user_id", "day", "event_id", "event_type", "product_id"
    )
