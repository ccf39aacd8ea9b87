"""The catalogue as plain SQL over the same tables, for a second engine.

The SQL is written from the meaning of each query, not from its Spark plan: it
joins before it aggregates, pairs items by a self-join, and rounds with integer
arithmetic. Money is summed in decimals of six places and rounded to cents after it.
"""

from __future__ import annotations

from ..sources.warehouse import CLV_TIERS, SPEND_TIERS


def half_up(num: str, den: str, scale: int) -> str:
    """``num / den`` of non-negative integers, rounded half up."""
    p = 10**scale
    return f"(CAST((2 * {p} * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / {p})"


def half_even(num: str, den: str, scale: int) -> str:
    """``num / den`` of non-negative integers, rounded half to even."""
    p = 10**scale
    q, r = f"(({p} * ({num})) // ({den}))", f"(({p} * ({num})) % ({den}))"
    up = f"(CASE WHEN 2 * {r} > ({den}) OR (2 * {r} = ({den}) AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"(CAST({q} + {up} AS DOUBLE) / {p})"


def cents(total: str) -> str:
    return f"CAST(100 * ({total}) AS HUGEINT)"


def money(column: str) -> str:
    return f"sum(CAST({column} AS DECIMAL(18, 6)))"


def dollars(cents_: str) -> str:
    return f"(CAST({cents_} AS DOUBLE) / 100)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def week(ts: str) -> str:
    saturday = f"(CAST({ts} AS DATE) + CAST(6 - dayofweek({ts}) AS INTEGER))"
    return f"printf('%04d-%02d', year({saturday}), (dayofyear({saturday}) - 1) // 7 + 1)"


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"


def reverse_ts(ts: str) -> str:
    return f"lpad(CAST(9223372036854775807 - epoch_ms(date_trunc('milliseconds', {ts})) AS VARCHAR), 19, '0')"


AGE = """CASE WHEN age IS NULL THEN '{missing}' WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34'
 WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' ELSE '55+' END"""
TIER = """CASE WHEN current_price < 20 THEN 'budget' WHEN current_price < 100 THEN 'mid-range'
 WHEN current_price < 300 THEN 'premium' ELSE 'luxury' END"""
SPEND = f"""CASE WHEN {{0}} > {SPEND_TIERS[0][0]}00 THEN 'high_value'
 WHEN {{0}} > {SPEND_TIERS[1][0]}00 THEN 'mid_value' ELSE 'low_value' END"""
CLV = f"""CASE WHEN clv_score > {CLV_TIERS[0][0]} THEN 'platinum' WHEN clv_score > {CLV_TIERS[1][0]} THEN 'gold'
 WHEN clv_score > {CLV_TIERS[2][0]} THEN 'silver' ELSE 'bronze' END"""

# Named sub-queries; each may use the ones before it.
PARTS = {
    "user_doc": f"""
        SELECT c_custkey AS user_id, c_name AS name,
          CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' Buyer' || c_custkey || '@Mail.COM ' END AS email,
          CAST(CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 18 + c_custkey % 53 END AS INTEGER) AS age,
          CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
          'City ' || (c_custkey % 100) AS city, n_name AS state, r_name AS country,
          first_day, {iso('first_day')} AS registration_date,
          CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE {iso('last_day')} END AS last_active,
          c_mktsegment AS preferred_payment
        FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day
                   FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""",
    "users": f"""
        SELECT *, {AGE.format(missing='unknown')} AS age_group, strftime(first_day, '%Y-%m') AS reg_month
        FROM user_doc WHERE first_day IS NOT NULL""",
    "product_doc": """
        SELECT p_partkey AS product_id, p_name AS name, p_brand AS category_id, p_type AS subcategory_id,
          p_retailprice AS base_price,
          CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_size * 10.0::DOUBLE END AS raw_price,
          CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_partkey % 7 - 2 END AS raw_stock,
          printf('1995-01-%02dT08:30:00', 1 + p_partkey % 31) AS creation_date
        FROM part""",
    "products": f"""
        SELECT *, {TIER} AS price_tier FROM (
          SELECT *, coalesce(raw_price, base_price) AS current_price,
            CASE WHEN raw_stock > 0 THEN raw_stock ELSE 0 END AS current_stock FROM product_doc)""",
    "txns": f"""
        SELECT o_orderkey AS transaction_id, o_custkey AS user_id, o_orderdate AS ts, o_totalprice AS total,
          lower(o_orderpriority) AS payment_method,
          CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'refunded' END AS status,
          CAST(o_orderdate AS DATE) AS txn_date, strftime(o_orderdate, '%Y-%m') AS txn_month,
          {week('o_orderdate')} AS txn_week
        FROM orders WHERE o_totalprice > 0""",
    "lines": """
        SELECT transaction_id, user_id, ts, txn_date, txn_month, status, l_partkey AS product_id,
          CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS subtotal
        FROM lineitem JOIN txns ON l_orderkey = transaction_id""",
    "ev": """
        SELECT event_id, ts, date_trunc('second', ts) AS sec, CAST(ts AS DATE) AS day, user_id, event_type, value,
          CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
          user_id || '-' || strftime(ts, '%Y-%m-%d') AS session_id
        FROM events""",
    "views": "SELECT DISTINCT session_id, user_id, day, k AS product_id FROM ev WHERE event_type IN ('view', 'click')",
    "carts": """
        SELECT session_id, user_id, day, k AS product_id, count(*) AS quantity, max(abs(value)) AS price
        FROM ev WHERE event_type = 'click' GROUP BY ALL""",
    "sessions": """
        SELECT e.*, coalesce(viewed_count, 0) AS viewed_count, coalesce(cart_count, 0) AS cart_count,
          coalesce(viewed, '[]') AS viewed, coalesce(cart, '{}') AS cart
        FROM (
          SELECT session_id, user_id, min(sec) AS start_time, max(sec) AS end_time,
            greatest(1, CAST(epoch(max(sec)) - epoch(min(sec)) AS BIGINT)) AS duration_seconds,
            CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
            CASE user_id % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows'
              WHEN 3 THEN 'macOS' ELSE 'iPadOS' END AS device_os,
            CASE user_id % 2 WHEN 0 THEN 'Safari' ELSE 'Chrome' END AS device_browser,
            CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'converted' ELSE 'abandoned' END
              AS conversion_status,
            CASE (user_id + dayofmonth(day)) % 6 WHEN 0 THEN 'search_engine' WHEN 1 THEN 'social_media'
              WHEN 2 THEN 'direct' WHEN 3 THEN 'email' WHEN 4 THEN 'affiliate' END AS referrer,
            count(*) AS page_count
          FROM ev GROUP BY session_id, user_id, day) e
        LEFT JOIN (SELECT session_id, count(*) AS viewed_count,
                     '[' || string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) || ']' AS viewed
                   FROM views GROUP BY session_id) v USING (session_id)
        LEFT JOIN (SELECT session_id, count(*) AS cart_count,
                     '{' || string_agg('"' || product_id || '":{"quantity":' || quantity || ',"price":' || price || '}',
                                       ',' ORDER BY product_id) || '}' AS cart
                   FROM carts GROUP BY session_id) c USING (session_id)""",
    "stxns": """
        SELECT event_id AS transaction_id, session_id, value AS total,
          CASE WHEN k % 5 = 0 THEN 'refunded' ELSE 'completed' END AS status
        FROM ev WHERE event_type = 'purchase' AND value > 0""",
    # Intermediate results that several queries share.
    "cohorts": f"""
        SELECT reg_month,
          CAST((year(ts) - year(first_day)) * 12 + month(ts) - month(first_day) AS INTEGER) AS months_since_reg,
          count(transaction_id) AS num_transactions, {cents(money('total'))} AS c,
          count(DISTINCT user_id) AS active_users
        FROM txns JOIN users USING (user_id) GROUP BY ALL""",
    "spend": f"""
        SELECT user_id, count(*) AS num_orders, {cents(money('total'))} AS c, max(total) AS max_spend,
          list_sort(list(DISTINCT payment_method)) AS payments
        FROM txns WHERE status IS DISTINCT FROM 'refunded' GROUP BY user_id""",
    "segments": f"""
        SELECT user_id, age_group, gender, preferred_payment, count(transaction_id) AS num_orders,
          {cents(money('total'))} AS c, max(total) AS mx, min(txn_date) AS first_purchase,
          max(txn_date) AS last_purchase
        FROM users LEFT JOIN txns USING (user_id) GROUP BY ALL""",
    "txn_m": f"""
        SELECT user_id, count(transaction_id) AS order_count, {cents(money('total'))} AS c,
          min(txn_date) AS first_purchase_date, max(txn_date) AS last_purchase_date
        FROM txns WHERE status <> 'refunded' GROUP BY user_id""",
    "sess_m": """
        SELECT user_id, count(session_id) AS session_count, CAST(sum(duration_seconds) AS BIGINT) AS secs,
          count(*) FILTER (conversion_status = 'converted') AS converted_sessions,
          CAST(sum(viewed_count) AS BIGINT) AS total_products_viewed
        FROM sessions GROUP BY user_id""",
    "clv_base": f"""
        SELECT user_id, age_group, gender, state, reg_month, preferred_payment,
          coalesce(order_count, 0) AS order_count, coalesce(c, 0) AS c,
          CASE WHEN c IS NOT NULL THEN {half_up('c', '100 * order_count', 2)} END AS avg_order_value,
          first_purchase_date, last_purchase_date,
          date_diff('day', first_purchase_date, last_purchase_date) AS tenure,
          coalesce(session_count, 0) AS session_count,
          coalesce({half_up('secs', '60 * session_count', 1)}, 0) AS avg_session_min,
          {half_up('secs', '60', 1)} AS total_session_min,
          {{converted}} AS converted_sessions,
          coalesce(total_products_viewed, 0) AS total_products_viewed
        FROM users LEFT JOIN txn_m USING (user_id) LEFT JOIN sess_m USING (user_id)""",
    "clv": f"""
        SELECT *, {CLV} AS clv_segment FROM (
          SELECT *, CAST(tenths AS DOUBLE) / 10 AS engagement_score,
            CAST((5 * c + 6000 * order_count + 20 * tenths + 5) // 10 AS DOUBLE) / 100 AS clv_score
          FROM (SELECT *, 4 * session_count + 3 * total_products_viewed + 30 * converted_sessions AS tenths
                FROM clv_base))""",
    "cat_rev": f"""
        SELECT category_id, count(DISTINCT transaction_id) AS num_transactions,
          count(DISTINCT user_id) AS num_customers, {cents(money('subtotal'))} AS c, count(*) AS n
        FROM lines JOIN products USING (product_id) GROUP BY category_id""",
    "sold": f"""
        SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold, {dollars(cents(money('subtotal')))} AS revenue
        FROM lines WHERE status <> 'refunded' GROUP BY product_id""",
    "seen": "SELECT product_id, count(*) AS total_views FROM views GROUP BY product_id",
    "perf": """
        SELECT product_id, total_views, units_sold, revenue, name, category_id, current_price, price_tier,
          round(CAST(units_sold AS DOUBLE) / total_views, 4) AS view_to_purchase_rate
        FROM seen {how} JOIN sold USING (product_id) JOIN products USING (product_id)""",
    "weekly": f"""
        SELECT txn_week, count(transaction_id) AS n, {cents(money('total'))} AS c, count(DISTINCT user_id) AS users
        FROM txns WHERE status <> 'refunded' GROUP BY txn_week""",
    "metrics": f"""
        SELECT product_id, day AS metric_date, coalesce(v, 0) AS views, coalesce(a, 0) AS cart_adds,
          CAST(coalesce(q, 0) AS BIGINT) AS purchases, {dollars('coalesce(c, 0)')} AS revenue
        FROM (SELECT product_id, day, count(*) AS v FROM views GROUP BY ALL)
        FULL JOIN (SELECT product_id, day, count(*) AS a FROM carts GROUP BY ALL) USING (product_id, day)
        FULL JOIN (SELECT product_id, txn_date AS day, sum(quantity) AS q, {cents(money('subtotal'))} AS c
                   FROM lines WHERE status <> 'refunded' GROUP BY ALL) USING (product_id, day)""",
    "buy_pairs": """
        SELECT a.product_id AS x, b.product_id AS y, count(*) AS n
        FROM lines a JOIN lines b ON a.transaction_id = b.transaction_id AND a.product_id < b.product_id
        GROUP BY ALL""",
    "view_pairs": """
        SELECT a.product_id AS x, b.product_id AS y, count(*) AS n
        FROM views a JOIN views b ON a.session_id = b.session_id AND a.product_id < b.product_id
        GROUP BY ALL""",
    "wide": f"""
        SELECT user_id || '#' || {reverse_ts('start_time')} AS row_key, session_id,
          {iso('start_time')} AS start_time, {iso('end_time')} AS end_time,
          CAST(duration_seconds AS VARCHAR) AS duration_secs, device_type, device_os,
          coalesce(referrer, '') AS referrer, conversion_status AS conversion, viewed, cart,
          CAST(page_count AS VARCHAR) AS page_count,
          'City ' || (user_id % 100) AS city, '' AS state, '10.0.0.' || (user_id % 256) AS ip
        FROM sessions""",
    # Faulty documents, and what their load keeps.
    "rough_users": """
        SELECT CASE WHEN user_id % 101 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id, first_day,
          CASE WHEN user_id % 101 = 0 OR user_id % 5 = 0 THEN NULL WHEN user_id % 70 = 3 THEN 'shared@mail.com' ELSE name || '@mail.com' END AS email
        FROM user_doc CROSS JOIN (VALUES (1), (2)) t(n) WHERE n = 1 OR user_id % 50 = 1""",
    "rough_products": """
        SELECT CAST(product_id AS VARCHAR) AS product_id, CASE WHEN product_id % 23 <> 0 THEN category_id END AS category_id,
          CASE WHEN product_id % 29 <> 0 THEN base_price END AS base_price
        FROM product_doc CROSS JOIN (VALUES (1), (2)) t(n) WHERE n = 1 OR product_id % 40 = 7""",
    "rough_txns": """
        SELECT o_orderkey AS k, CASE WHEN o_orderkey % 41 <> 0 THEN o_custkey END AS user_id, CASE WHEN o_orderkey % 43 <> 0 THEN o_orderdate END AS ts,
          CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 0 ELSE o_totalprice END AS total,
          CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'shipped' WHEN 'P' THEN 'refunded' END AS status
        FROM orders CROSS JOIN (VALUES (1), (2)) t(n) WHERE n = 1 OR o_orderkey % 60 = 5""",
    "rough_sessions": """
        SELECT CASE WHEN user_id % 19 <> 0 THEN session_id END AS session_id, user_id, CASE WHEN user_id % 17 <> 0 THEN start_time END AS start_time,
          CASE WHEN user_id % 13 = 0 THEN 0 ELSE duration_seconds END AS duration_seconds FROM sessions""",
    "rough_kept": "SELECT DISTINCT * FROM rough_txns WHERE user_id IS NOT NULL AND ts IS NOT NULL AND total > 0",
    "rough_lines": """
        SELECT k, user_id, status, l_partkey AS p, l_partkey % 50 = 0 AS gone, CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS subtotal
        FROM lineitem JOIN (SELECT DISTINCT * FROM rough_txns WHERE total > 0) ON l_orderkey = k""",
    "stock": "SELECT product_id, name, raw_price AS current_price, raw_stock AS current_stock FROM product_doc",
    "listings": """
        SELECT p_partkey AS product_id, p_size * 9.0::DOUBLE AS current_price,
          CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS BIGINT) END AS current_stock
        FROM part WHERE p_size % 2 = 0 OR p_size > 40
        UNION ALL SELECT p_partkey + 1000000000000, 450.0, NULL FROM part WHERE p_size = 50""",
}


def sql(*names: str, body: str, **options: str) -> str:
    """``body`` over the named parts and whatever those are made of."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name in wanted:
            return
        wanted.add(name)
        text = PARTS[name]
        for other in PARTS:
            if other != name and _mentions(text, other):
                need(other)

    for name in names:
        need(name)
    texts = {n: PARTS[n] for n in PARTS if n in wanted}
    for slot, value in options.items():
        texts = {n: t.replace("{" + slot + "}", value) for n, t in texts.items()}
    return "WITH " + ", ".join(f"{n} AS ({t})" for n, t in texts.items()) + "\n" + body


def _mentions(text: str, name: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(a in ("FROM", "JOIN") and b == name for a, b in zip(words, words[1:]))


PERF_COLUMNS = """product_id, total_views, units_sold, revenue, name, category_id, current_price, price_tier,
 view_to_purchase_rate"""
FLAGS = """CAST(viewed_count > 0 AS INTEGER) AS reached_product_view,
 CAST(conversion_status IS NOT NULL AND viewed_count > 0 AS INTEGER) AS reached_cart,
 CAST(conversion_status = 'converted' AS INTEGER) AS reached_purchase"""
CONVERTED = "count(*) FILTER (conversion_status = 'converted')"
VIEWED = "count(*) FILTER (viewed_count > 0)"
CLV_COLUMNS = f"""user_id, age_group, gender, state, reg_month, preferred_payment, order_count,
 {dollars('c')} AS total_spend, avg_order_value, first_purchase_date, last_purchase_date,
 CAST(tenure AS INTEGER) AS customer_tenure_days, session_count, avg_session_min, total_session_min,
 converted_sessions, total_products_viewed, engagement_score, clv_score, clv_segment"""
AVG_SPEND = half_up("sum(c)", "100 * count(*)", 2)
USER_COLUMNS = """user_id, name, lower(coalesce(email, user_id || '@placeholder.local')) AS email, age, gender,
 preferred_payment, city, state"""
SEGMENT_VALUES = f"""user_id, age_group, gender, preferred_payment, num_orders, {dollars('c')} AS lifetime_value,
 CASE WHEN num_orders > 0 THEN {half_up('c', '100 * num_orders', 2)} END AS avg_order_value, mx AS max_order_value,
 first_purchase, last_purchase, {SPEND.format('c')} AS customer_segment"""
PAYMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CAT_REV = f"""SELECT category_id, num_transactions, num_customers, {dollars('c')} AS total_revenue,
 {half_up('c', '100 * n', 2)} AS avg_item_revenue FROM cat_rev"""
METRIC_COLUMNS = "product_id || '#' || strftime(metric_date, '%Y-%m-%d') AS row_key"

ORACLE_SQL: dict[str, str] = {
    # Products and categories
    "product_popularity": sql("lines", "products", body=f"""
        SELECT product_id, name AS product_name, category_id, base_price, units_sold,
          {dollars('c')} AS total_revenue, n AS num_orders, {half_even('c', '100 * units_sold', 2)} AS avg_unit_price
        FROM (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS units_sold, {cents(money('subtotal'))} AS c,
                count(*) AS n
              FROM lines WHERE status IN ('completed', 'shipped') GROUP BY product_id)
        LEFT JOIN products USING (product_id) ORDER BY total_revenue DESC, product_id LIMIT 15"""),
    "category_revenue_top": sql("lines", "products", body=f"""
        SELECT category_id, {dollars(cents(money('subtotal')))} AS total_revenue,
          CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS num_txns,
          {half_even(cents(money('subtotal')), '100 * count(*)', 2)} AS avg_item_revenue
        FROM lines LEFT JOIN products USING (product_id) WHERE status IN ('completed', 'shipped')
        GROUP BY category_id ORDER BY total_revenue DESC, category_id LIMIT 10"""),
    "revenue_by_category": sql("cat_rev", body=CAT_REV),
    "top_categories_chart": sql("cat_rev", body=CAT_REV + " ORDER BY total_revenue DESC, category_id LIMIT 15"),
    "product_views": sql("seen", body="SELECT * FROM seen"),
    "product_purchases": sql("sold", body="SELECT * FROM sold"),
    "product_performance": sql("perf", how="LEFT", body=f"SELECT {PERF_COLUMNS} FROM perf"),
    "product_performance_all": sql("perf", how="FULL", body=f"SELECT {PERF_COLUMNS} FROM perf"),
    "views_vs_revenue": sql("perf", how="LEFT", body=f"""
        SELECT {PERF_COLUMNS} FROM perf WHERE units_sold IS NOT NULL AND revenue IS NOT NULL
          AND name IS NOT NULL AND category_id IS NOT NULL AND current_price IS NOT NULL"""),
    "monthly_category_revenue": sql("lines", "products", body=f"""
        SELECT txn_month, category_id, count(*) AS num_txns, {dollars(cents(money('subtotal')))} AS revenue
        FROM lines JOIN products USING (product_id) WHERE status <> 'refunded' GROUP BY ALL"""),
    # Pairs
    "co_purchase_pairs": sql("buy_pairs", "products", body="""
        SELECT x AS product_a, a.name AS product_a_name, y AS product_b, b.name AS product_b_name,
          n AS co_purchase_count
        FROM buy_pairs JOIN products a ON a.product_id = x JOIN products b ON b.product_id = y
        ORDER BY n DESC, x, y LIMIT 20"""),
    "product_affinity": sql("buy_pairs", "view_pairs", "products", body="""
        SELECT x AS prod_a, a.name AS name_a, a.category_id AS cat_a, a.price_tier AS tier_a,
          y AS prod_b, b.name AS name_b, b.category_id AS cat_b, b.price_tier AS tier_b,
          coalesce(p.n, 0) AS purchase_together, coalesce(v.n, 0) AS viewed_together,
          CAST(3 * coalesce(p.n, 0) + coalesce(v.n, 0) AS DOUBLE) AS affinity_score
        FROM buy_pairs p FULL JOIN view_pairs v USING (x, y)
        JOIN products a ON a.product_id = x JOIN products b ON b.product_id = y
        ORDER BY affinity_score DESC, x, y LIMIT 200"""),
    "item_pairs_purchase": sql("buy_pairs", body="""
        SELECT x AS item_a, y AS item_b, n AS purchase_together FROM buy_pairs"""),
    "item_pairs_view": sql("view_pairs", body="""
        SELECT x AS item_a, y AS item_b, n AS viewed_together FROM view_pairs"""),
    # Cohorts
    "cohort_analysis": sql("cohorts", body=f"""
        SELECT reg_month, months_since_reg, num_transactions, {dollars('c')} AS total_revenue,
          CAST(c AS DOUBLE) / (100 * num_transactions) AS avg_order_value, active_users FROM cohorts"""),
    "cohort_pivot": sql("cohorts", body="SELECT reg_month, " + ", ".join(
        f"{dollars(f'sum(c) FILTER (months_since_reg = {k})')} AS \"{k}\"" for k in range(3)
    ) + " FROM cohorts WHERE months_since_reg >= 0 GROUP BY reg_month"),
    "cohort_revenue_matrix": sql("cohorts", body="SELECT reg_month, " + ", ".join(
        f"coalesce({dollars(f'sum(c) FILTER (months_since_reg = {k})')}, 0) AS \"Month +{k}\"" for k in range(5)
    ) + " FROM cohorts WHERE months_since_reg BETWEEN 0 AND 4 GROUP BY reg_month"),
    # Customers
    "user_spend_profile": sql("spend", body=f"""
        SELECT user_id, num_orders, {dollars('c')} AS total_spend, CAST(c AS DOUBLE) / (100 * num_orders) AS avg_spend,
          max_spend, CAST(to_json(payments) AS VARCHAR) AS payments, {SPEND.format('c')} AS spend_segment FROM spend"""),
    "user_spend_profile_high": sql("spend", body=f"""
        SELECT user_id, num_orders, {dollars('c')} AS total_spend, CAST(c AS DOUBLE) / (100 * num_orders) AS avg_spend,
          max_spend, CAST(to_json(payments) AS VARCHAR) AS payments, 'high_value' AS spend_segment
        FROM spend WHERE c > {SPEND_TIERS[0][0]}00"""),
    "user_segmentation_by_age": sql("spend", "user_doc", body=f"""
        SELECT age_group, count(*) AS num_users, {half_even('sum(num_orders)', 'count(*)', 1)} AS avg_orders,
          {half_even('sum(c)', '100 * count(*)', 2)} AS avg_total_spend,
          round_even(avg(CAST(c AS DOUBLE) / (100 * num_orders)), 2) AS avg_order_value,
          {half_even(f'100 * count(*) FILTER (c > {SPEND_TIERS[0][0]}00)', 'count(*)', 1)} AS high_value_pct
        FROM (SELECT s.*, {AGE.format(missing='18-24')} AS age_group
              FROM spend s LEFT JOIN user_doc USING (user_id)) GROUP BY age_group"""),
    "user_segments": sql("segments", body=f"SELECT {SEGMENT_VALUES} FROM segments"),
    "age_payment_spend_matrix": sql("segments", body="SELECT age_group, " + ", ".join(
        f"coalesce(CAST(sum(coalesce(c, 0)) FILTER (preferred_payment = '{p}') AS DOUBLE)"
        f" / (100 * count(*) FILTER (preferred_payment = '{p}')), 0) AS \"{p}\"" for p in PAYMENTS
    ) + " FROM segments GROUP BY age_group"),
    "txn_metrics": sql("txn_m", body=f"""
        SELECT user_id, order_count, {dollars('c')} AS total_spend,
          {half_up('c', '100 * order_count', 2)} AS avg_order_value, first_purchase_date, last_purchase_date,
          CAST(date_diff('day', first_purchase_date, last_purchase_date) AS INTEGER) AS customer_tenure_days
        FROM txn_m"""),
    "session_metrics": sql("sess_m", body=f"""
        SELECT user_id, session_count, {half_up('secs', '60 * session_count', 1)} AS avg_session_min,
          {half_up('secs', '60', 1)} AS total_session_min, converted_sessions, total_products_viewed FROM sess_m"""),
    "clv_scores": sql("clv", converted="converted_sessions", body=f"SELECT {CLV_COLUMNS} FROM clv"),
    "clv_scores_filled": sql("clv", converted="coalesce(converted_sessions, 0)", body=f"""
        SELECT {CLV_COLUMNS} FROM clv"""),
    "top_customers": sql("clv", converted="converted_sessions", body=f"""
        SELECT user_id, age_group, state, order_count, {dollars('c')} AS total_spend, session_count, clv_score,
          clv_segment FROM clv ORDER BY clv_score DESC NULLS LAST, user_id LIMIT 10"""),
    "clv_segment_distribution": sql("clv", converted="converted_sessions", body=f"""
        SELECT clv_segment, count(*) AS num_users, {AVG_SPEND} AS avg_spend,
          {half_up('sum(order_count)', 'count(*)', 2)} AS avg_orders,
          {half_up('sum(session_count)', 'count(*)', 2)} AS avg_sessions
        FROM clv GROUP BY clv_segment"""),
    "clv_segment_dense": sql("clv", converted="converted_sessions", body="""
        SELECT t.tier AS clv_segment, count(user_id) AS num_users,
          coalesce(CAST(sum(c) AS DOUBLE) / (100 * count(user_id)), 0) AS avg_spend
        FROM (VALUES ('platinum'), ('gold'), ('silver'), ('bronze')) t(tier)
        LEFT JOIN clv ON clv_segment = t.tier GROUP BY t.tier"""),
    # Funnels
    "conversion_funnel": sql("sessions", body=f"""
        SELECT count(*) AS total_sessions, {VIEWED} AS viewed_product, {VIEWED} AS added_to_cart,
          {CONVERTED} AS converted, {half_up(f'100 * {CONVERTED}', 'count(*)', 2)} AS conversion_rate_pct
        FROM sessions"""),
    "conversion_funnel_cart": sql("sessions", body=f"""
        SELECT count(*) AS total_sessions, {VIEWED} AS viewed_product,
          count(*) FILTER (cart_count > 0) AS added_to_cart,
          {CONVERTED} AS converted, {half_up(f'100 * {CONVERTED}', 'count(*)', 2)} AS conversion_rate_pct
        FROM sessions"""),
    "funnel_percentages": sql("sessions", body=f"""
        SELECT CAST(stage_no AS INTEGER) AS stage_no, stage, s AS sessions, CAST(100 * s AS DOUBLE) / t AS pct_of_total
        FROM (SELECT count(*) AS t, {VIEWED} AS v, {CONVERTED} AS c FROM sessions),
          LATERAL (SELECT * FROM (VALUES (1, 'All sessions', t), (2, 'Viewed product', v), (3, 'Added to cart', v),
                     (4, 'Purchased', c)) x(stage_no, stage, s))"""),
    "funnel_flags": sql("sessions", body=f"SELECT session_id, {FLAGS} FROM sessions"),
    "funnel_analysis": sql("sessions", body=f"""
        SELECT session_id, user_id, device_type, device_os, referrer, conversion_status, duration_seconds,
          viewed AS viewed_products, {FLAGS} FROM sessions"""),
    "funnel_totals": sql("sessions", body=f"""
        SELECT count(*) AS "1_total_sessions", {VIEWED} AS "2_viewed_product", {VIEWED} AS "3_added_to_cart",
          {CONVERTED} AS "4_converted" FROM sessions"""),
    "funnel_by_device": sql("sessions", body=f"""
        SELECT device_type, count(*) AS sessions, {VIEWED} AS viewed, {VIEWED} AS carted, {CONVERTED} AS converted,
          {half_up(f'100 * {CONVERTED}', 'count(*)', 2)} AS conv_rate_pct FROM sessions GROUP BY device_type"""),
    "funnel_by_referrer": sql("sessions", body=f"""
        SELECT referrer, count(*) AS sessions, {CONVERTED} AS converted,
          {half_up(f'100 * {CONVERTED}', 'count(*)', 2)} AS conv_rate_pct FROM sessions GROUP BY referrer"""),
    "device_conversion": sql("sessions", body=f"""
        SELECT device_type, count(*) AS sessions, {CONVERTED} AS conversions,
          CAST(100 * {CONVERTED} AS DOUBLE) / count(*) AS conv_rate
        FROM sessions WHERE device_type IS NOT NULL GROUP BY device_type"""),
    "device_referrer_stats": sql("sessions", body=f"""
        SELECT device_type, device_os, referrer, count(*) AS num_sessions, {CONVERTED} AS conversions,
          {half_up(f'100 * {CONVERTED}', 'count(*)', 2)} AS conv_rate_pct FROM sessions GROUP BY ALL"""),
    "revenue_by_referrer": sql("sessions", "stxns", body=f"""
        SELECT referrer, count(DISTINCT transaction_id) AS num_transactions,
          {dollars(cents(money('total')))} AS total_revenue,
          {half_up(cents(money('total')), '100 * count(*)', 2)} AS avg_order_value
        FROM sessions JOIN stxns USING (session_id) WHERE status <> 'refunded' GROUP BY referrer"""),
    "session_weekly_trend": sql("sessions", body=f"""
        SELECT {week('start_time')} AS week, count(*) AS total_sessions, {CONVERTED} AS conversions,
          {half_up(f'100 * {CONVERTED}', 'count(*)', 2)} AS conv_rate_pct FROM sessions GROUP BY 1"""),
    # Trends
    "weekly_revenue": sql("weekly", body=f"""
        SELECT txn_week, n AS num_transactions, {dollars('c')} AS total_revenue,
          {half_up('c', '100 * n', 2)} AS avg_order_value, users AS unique_customers FROM weekly"""),
    "weekly_trend": sql("weekly", body=f"""
        SELECT txn_week, n AS num_txns, {dollars('c')} AS revenue, users AS unique_buyers,
          {half_up('sum(c) OVER w', '100 * count(*) OVER w', 2)} AS rolling_avg_revenue,
          {half_up('sum(users) OVER w', 'count(*) OVER w', 1)} AS rolling_avg_buyers
        FROM weekly WINDOW w AS (ORDER BY txn_week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""),
    "product_daily_metrics": sql("metrics", body="SELECT * FROM metrics"),
    "product_view_metrics": sql("views", body="""
        SELECT product_id, day AS metric_date, count(*) AS views, CAST(0 AS BIGINT) AS cart_adds,
          CAST(0 AS BIGINT) AS purchases, CAST(0 AS DOUBLE) AS revenue FROM views GROUP BY ALL"""),
    # Cleaning
    "clean_users": sql("users", body=f"""
        SELECT {USER_COLUMNS}, country, registration_date, last_active, age_group, reg_month FROM users"""),
    "clean_users_lenient": sql("user_doc", body=f"""
        SELECT {USER_COLUMNS}, registration_date,
          coalesce(last_active, 'unknown') AS last_active,
          {AGE.format(missing='unknown')} AS age_group, strftime(first_day, '%Y-%m') AS reg_month FROM user_doc"""),
    "users_load_form": sql("user_doc", body=f"""
        SELECT user_id, age, lower(trim(CASE WHEN coalesce(email, '') = '' THEN user_id || '@placeholder.local'
          ELSE email END)) AS email, {AGE.format(missing='18-24')} AS age_group FROM user_doc"""),
    "clean_products": sql("products", body="""
        SELECT product_id, name, category_id, subcategory_id, base_price, current_price, current_stock, creation_date,
          price_tier FROM products"""),
    "clean_transactions": sql("txns", body=f"""
        SELECT transaction_id, user_id, {iso('ts')} AS "timestamp", total, payment_method, status, txn_date,
          txn_month, txn_week FROM txns"""),
    "clean_sessions": sql("sessions", body=f"""
        SELECT session_id, user_id, {iso('start_time')} AS start_time, {iso('end_time')} AS end_time,
          duration_seconds, conversion_status, referrer, viewed_count, cart_count, page_count,
          device_type, device_os, device_browser FROM sessions"""),
    "status_filter_forms": sql("txns", body="""
        SELECT count(*) FILTER (s IN ('completed', 'shipped')) AS sold,
          count(*) FILTER (s <> 'refunded') AS not_refunded,
          count(*) FILTER (s IS DISTINCT FROM 'refunded') AS not_refunded_or_null
        FROM (SELECT CASE WHEN payment_method <> '4-not specified' THEN status END AS s FROM txns)"""),
    "us_week": f"""
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS "day", {week('o_orderdate')} AS week
        FROM orders WHERE o_totalprice > 0""",
    # Keyed tables
    "duplicate_keys": sql("user_doc", body="\nUNION ALL ".join(
        f"""SELECT '{table}' AS "table", '{key}' AS "key", CAST({column} AS VARCHAR) AS "value", count(*) AS row_count
        FROM {source} {where} GROUP BY {column} HAVING count(*) > 1"""
        for table, key, column, source, where in (
            ("users", "user_id", "user_id", "user_doc", ""),
            ("users", "email", "email", "user_doc", "WHERE email IS NOT NULL"),
            ("products", "product_id", "p_partkey", "part", ""),
            ("products", "name", "p_name", "part", ""),
            ("transactions", "transaction_id", "o_orderkey", "orders", ""),
            ("lineitem", "l_orderkey", "l_orderkey", "lineitem", ""),
        )
    )),
    "upsert_products": sql("stock", "listings", body="""
        SELECT coalesce(n.product_id, o.product_id) AS product_id, o.name,
          coalesce(n.current_price, o.current_price) AS current_price,
          coalesce(n.current_stock, o.current_stock) AS current_stock
        FROM stock o FULL JOIN listings n ON o.product_id = n.product_id"""),
    "upsert_inserted": sql("stock", "listings", body="""
        SELECT count(*) AS inserted FROM listings WHERE product_id NOT IN (SELECT product_id FROM stock)"""),
    "upsert_sales_feed": sql("stock", body="""
        SELECT product_id, name, coalesce(p.price, current_price) AS current_price,
          coalesce(q.quantity, current_stock) AS current_stock
        FROM stock
        LEFT JOIN (SELECT l_partkey, l_extendedprice / l_quantity AS price FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_partkey
            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) = 1) p
          ON p.l_partkey = product_id
        LEFT JOIN (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem WHERE l_returnflag = 'R'
            QUALIFY row_number() OVER (PARTITION BY l_partkey
            ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC, l_quantity DESC) = 1) q
          ON q.l_partkey = product_id"""),
    "last_write": sql("txns", body=f"""
        SELECT user_id, transaction_id, {iso('ts')} AS "timestamp", total FROM txns
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, transaction_id DESC) = 1"""),
    "latest_sessions": sql("sessions", body=f"""
        SELECT user_id, session_id, {iso('start_time')} AS start_time, device_type, conversion_status FROM sessions
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY sessions.start_time DESC, session_id) <= 5"""),
    "wide_sessions": sql("wide", body="SELECT * FROM wide"),
    "user_sessions_lookup": sql("sessions", body=f"""
        SELECT user_id || '#' || {reverse_ts('start_time')} AS row_key, session_id, {iso('start_time')} AS start_time,
          device_type AS device, conversion_status AS conversion, referrer
        FROM sessions WHERE user_id = 7 ORDER BY sessions.start_time DESC, session_id LIMIT 5"""),
    "row_key_lookup": sql("wide", body="""
        SELECT row_key, session_id, start_time, conversion FROM wide
        WHERE row_key = (SELECT min(row_key) FROM wide WHERE row_key LIKE '7#%')"""),
    "metric_range": sql("metrics", body=f"""
        SELECT {METRIC_COLUMNS}, views, cart_adds, purchases, revenue FROM metrics
        WHERE product_id = 42 AND metric_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'"""),
    "metric_columns": sql("metrics", body=f"""
        SELECT {METRIC_COLUMNS}, views, revenue FROM metrics
        WHERE product_id = 42 AND metric_date BETWEEN DATE '1995-01-01' AND DATE '2024-12-31'"""),
    "retention": sql("metrics", body="""
        SELECT * FROM metrics WHERE metric_date >= DATE '2024-04-10' - INTERVAL 90 DAY"""),
    # Sources and sinks
    "documents_landed": sql("products", body="""
        SELECT CAST(product_id AS VARCHAR) AS product_id, name, category_id, base_price, current_price, current_stock,
          creation_date, price_tier FROM products"""),
    "results_as_csv": sql("sessions", body=f"""
        SELECT session_id, user_id, device_type, device_os, referrer, conversion_status, duration_seconds,
          viewed AS viewed_products, {FLAGS} FROM sessions"""),
    "views_vs_revenue_from_csv": sql("perf", how="LEFT", body=f"""
        SELECT {PERF_COLUMNS.replace('product_id', 'CAST(product_id AS VARCHAR) AS product_id')} FROM perf
        WHERE units_sold IS NOT NULL AND revenue IS NOT NULL
          AND name IS NOT NULL AND category_id IS NOT NULL AND current_price IS NOT NULL"""),
    "metrics_table": sql("metrics", body=f"""
        SELECT {METRIC_COLUMNS}, views, cart_adds, purchases, revenue FROM metrics
        WHERE product_id = 42 AND year(metric_date) = 2024"""),
    # Streams
    "stream_daily_views": sql("ev", body="""
        SELECT k AS product_id, day AS metric_date, count(DISTINCT user_id) AS views FROM ev
        WHERE event_type IN ('view', 'click') GROUP BY ALL"""),
    "stream_latest_events": sql("ev", body=f"""
        SELECT user_id || '#' || {reverse_ts('ts')} AS row_key, user_id, day, event_id, event_type, k AS product_id
        FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) = 1"""),
}



def report_of(entity: str, source: str, extra: dict[str, int | str], rules: dict[str, str]) -> str:
    """Rows of the load report: counts of ``source`` by condition, and ``extra`` numbers added to them."""
    tests = {"rows in": "true", "rows kept": " AND ".join(f"NOT coalesce({t}, false)" for t in rules.values()) or "true"}
    tests |= rules
    parts = [f"SELECT '{entity}' AS \"table\", '{rule}' AS rule, count(*) FILTER ({test}) + {extra.get(rule, 0)} AS rows FROM {source}" for rule, test in tests.items()]
    parts += [f"SELECT '{entity}', '{rule}', {n}" for rule, n in extra.items() if rule not in tests]
    return " UNION ALL ".join(parts)


def refused_of(source: str, column: str, where: str = "true") -> str:
    """Rows beyond the first of each value."""
    return f"(SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM {source} WHERE {where} GROUP BY {column}))"


# Rows with an email after the repeated ids went: an id comes once, and rows without an id have no email.
EMAILS = "(SELECT DISTINCT user_id, email FROM rough_users WHERE email IS NOT NULL)"
READABLE = {"unreadable": 0, "unreadable field": 0}
ORACLE_SQL |= {
    "load_report": sql("rough_users", "rough_products", "rough_txns", "rough_sessions", body=" UNION ALL ".join([
        report_of("categories", "(SELECT DISTINCT p_brand FROM part)", READABLE | {"category_id repeated": 0}, {}),
        report_of("users", "rough_users", {
            "rows in": 3, "rows kept": 1, "unreadable": 2, "unreadable field": 1, "user_id repeated": refused_of("rough_users", "user_id"),
            "email repeated": refused_of(EMAILS, "email")}, {"user_id missing": "user_id IS NULL", "registration_date missing": "first_day IS NULL"}),
        report_of("products", "rough_products", READABLE | {"product_id repeated": refused_of("rough_products", "product_id")}, {
            "product_id missing": "product_id IS NULL", "category_id missing": "category_id IS NULL", "base_price missing": "base_price IS NULL"}),
        report_of("transactions", "rough_txns", READABLE | {"transaction_id repeated": refused_of("rough_txns", "k")}, {
            "transaction_id missing": "k IS NULL", "user_id missing": "user_id IS NULL", "timestamp missing": "ts IS NULL",
            "total missing": "total IS NULL", "total not positive": "total <= 0"}),
        report_of("sessions", "rough_sessions", READABLE, {
            "session_id missing": "session_id IS NULL", "user_id missing": "user_id IS NULL", "start_time missing": "start_time IS NULL",
            "duration not positive": "duration_seconds <= 0"}),
    ])),
    "load_rejects": sql("rough_users", "rough_products", body=f"""
        SELECT 'users' AS "table", 'user_id repeated' AS reason, user_id AS "value", count(*) - 1 AS rows FROM rough_users GROUP BY user_id HAVING count(*) > 1
        UNION ALL SELECT 'users', 'email repeated', email, count(*) - 1 FROM {EMAILS} GROUP BY email HAVING count(*) > 1
        UNION ALL SELECT 'products', 'product_id repeated', product_id, count(*) - 1 FROM rough_products GROUP BY product_id HAVING count(*) > 1
        UNION ALL VALUES ('users', 'no document', NULL, 1), ('users', 'malformed text', NULL, 1), ('users', 'unreadable: age', NULL, 1)"""),
    "clean_products_lenient": sql("product_doc", body=f"""
        SELECT product_id, category_id, base_price, current_price, current_stock, {TIER} AS price_tier FROM (
          SELECT CAST(product_id AS VARCHAR) AS product_id, CASE WHEN product_id % 23 <> 0 THEN category_id END AS category_id,
            CASE WHEN product_id % 29 <> 0 THEN base_price END AS base_price,
            coalesce(raw_price, CASE WHEN product_id % 29 <> 0 THEN base_price END) AS current_price, raw_stock AS current_stock
          FROM product_doc CROSS JOIN (VALUES (1), (2)) t(n) WHERE n = 1 OR product_id % 40 = 7)"""),
    "clean_transactions_lenient": sql("rough_txns", body=f"""
        SELECT CAST(k AS VARCHAR) AS transaction_id, CAST(t.user_id AS VARCHAR) AS user_id, total, '  ' || o_orderpriority || ' ' AS payment_method,
          CAST(ts AS DATE) AS txn_date, strftime(ts, '%Y-%m') AS txn_month, CASE WHEN ts IS NOT NULL THEN {week('ts')} END AS txn_week
        FROM rough_txns t JOIN orders ON o_orderkey = k WHERE total > 0"""),
    "clean_sessions_lenient": sql("sessions", body=f"""
        SELECT CASE WHEN user_id % 19 <> 0 THEN session_id END AS session_id, user_id,
          CASE WHEN user_id % 17 <> 0 THEN {iso('start_time')} END AS start_time, {iso('end_time')} AS end_time, duration_seconds, device_type, device_os
        FROM sessions WHERE user_id % 13 <> 0"""),
    "rough_revenue": sql("rough_lines", "rough_kept", "rough_products", body=CAT_REV.replace("FROM cat_rev", f"""FROM (
        SELECT category_id, count(DISTINCT k) AS num_transactions, count(DISTINCT l.user_id) AS num_customers, {cents(money('subtotal'))} AS c, count(*) AS n
        FROM rough_lines l JOIN rough_kept USING (k) JOIN (SELECT DISTINCT * FROM rough_products) ON product_id = CAST(p AS VARCHAR) AND NOT gone
        WHERE category_id IS NOT NULL AND base_price IS NOT NULL GROUP BY category_id)""")),
    "rough_categories": sql("rough_lines", "rough_products", body=f"""
        SELECT category_id, {dollars(cents(money('subtotal')))} AS total_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS num_txns,
          {half_even(cents(money('subtotal')), '100 * count(*)', 2)} AS avg_item_revenue
        FROM rough_lines LEFT JOIN (SELECT DISTINCT * FROM rough_products) ON product_id = CAST(p AS VARCHAR) AND NOT gone
        WHERE status IN ('completed', 'shipped') GROUP BY category_id ORDER BY total_revenue DESC, category_id LIMIT 10"""),
    "rough_cohorts": sql("rough_kept", "rough_users", body=f"""
        SELECT reg_month, months_since_reg, num_transactions, {dollars('c')} AS total_revenue,
          CAST(c AS DOUBLE) / (100 * num_transactions) AS avg_order_value, active_users FROM (
            SELECT strftime(first_day, '%Y-%m') AS reg_month, CAST((year(ts) - year(first_day)) * 12 + month(ts) - month(first_day) AS INTEGER) AS months_since_reg,
              count(k) AS num_transactions, {cents(money('total'))} AS c, count(DISTINCT t.user_id) AS active_users
            FROM rough_kept t JOIN (SELECT DISTINCT user_id, first_day FROM rough_users WHERE first_day IS NOT NULL AND (email IS NULL OR email <> 'shared@mail.com')) u
              ON u.user_id = CAST(t.user_id AS VARCHAR) GROUP BY ALL)"""),
}

ORACLE_SQL |= {
    "upsert_stored": ORACLE_SQL["upsert_products"],
    "upsert_stored_counts": sql("stock", "listings", body="""
        SELECT count(*) FILTER (s.product_id IS NULL) AS inserted, count(s.product_id) AS matched FROM listings l LEFT JOIN stock s ON s.product_id = l.product_id"""),
    "stream_late_views": ORACLE_SQL["stream_daily_views"],
    "retention_stored": sql("views", body="""
        SELECT product_id, day AS metric_date, count(*) AS views FROM views WHERE day >= DATE '2024-01-11' GROUP BY ALL"""),
    "stream_folded_events": sql("ev", body="""
        SELECT user_id, day, event_id, event_type FROM ev
        QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC, event_id DESC) = 1"""),
}

# The same answers from nested documents.
ORACLE_SQL |= {
    "documents_popularity": ORACLE_SQL["product_popularity"],
    "documents_daily_metrics": ORACLE_SQL["product_daily_metrics"],
    "documents_funnel": ORACLE_SQL["conversion_funnel"],
    "documents_devices": ORACLE_SQL["device_referrer_stats"],
    "documents_views_sql": ORACLE_SQL["product_views"],
    "clean_users_without_columns": sql("users", body="""
        SELECT user_id, lower(coalesce(email, user_id || '@placeholder.local')) AS email,
          CAST(NULL AS INTEGER) AS age, CAST(NULL AS VARCHAR) AS gender,
          'unknown' AS age_group, reg_month FROM users"""),
}
