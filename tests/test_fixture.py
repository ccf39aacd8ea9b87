"""The analytics over the hand-made shop, against answers worked out by hand."""

import datetime

import pytest
from retail_documents import write_documents

from shopscope.functions import status as st
from shopscope.operators import cleaning, keyed
from shopscope.plans import affinity, cohorts, customers, funnels, products, trends
from shopscope.sources import documents, results

D = datetime.date


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    raw, landed = tmp_path_factory.mktemp("documents"), tmp_path_factory.mktemp("landed")
    write_documents(raw)
    documents.land(spark, str(raw), str(landed))
    return documents.Store(spark, str(landed))


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def by_key(df, *columns):
    return {r[0]: tuple(r[1:]) for r in rows(df, *columns)}


def test_rows_kept(shop):
    raw = {n: shop.raw(n) for n in ("categories", "users", "products", "transactions", "sessions")}
    report = {(t, rule): n for t, rule, n in rows(documents.load_report(raw))}
    assert {t: (report[t, "rows in"], report[t, "rows kept"]) for t in raw} == {
        "categories": (1, 1), "users": (5, 4), "products": (4, 4), "transactions": (6, 5), "sessions": (7, 6)}
    assert report["users", "user_id missing"] == report["transactions", "total not positive"] == report["sessions", "duration not positive"] == 1


def test_lenient_cleaning_keeps_rows_without_keys(shop):
    assert cleaning.clean_users(shop.raw("users"), strict=False).count() == 5
    assert "country" not in cleaning.clean_users(shop.raw("users"), strict=False).columns
    sessions = cleaning.clean_sessions(shop.raw("sessions"), strict=False)
    assert {"cart_contents", "page_views", "device_browser"}.isdisjoint(sessions.columns)
    assert dict(sessions.dtypes)["end_time"] == "string"
    stock = by_key(cleaning.clean_products(shop.raw("products"), strict=False), "product_id", "current_stock")
    assert stock["p2"] == (-3,)


def test_emails(shop):
    assert by_key(shop.users, "user_id", "email") == {
        "u1": (" a@x.com ",), "u2": ("",), "u3": ("u3@placeholder.local",), "u4": ("u4@x.com",),
    }
    loaded = by_key(cleaning.load_users(shop.raw("users")).filter("user_id is not null"), "user_id", "email")
    assert loaded == {
        "u1": ("a@x.com",), "u2": ("u2@placeholder.local",), "u3": ("u3@placeholder.local",), "u4": ("u4@x.com",),
    }


def test_prices_and_stock(shop):
    assert by_key(shop.products, "product_id", "current_price", "current_stock", "price_tier") == {
        "p1": (19.99, 5, "budget"), "p2": (50.0, 0, "mid-range"), "p3": (300.0, 0, "luxury"),
        "p4": (20.0, 1, "mid-range"),
    }


def test_transaction_columns(shop):
    got = by_key(shop.transactions, "transaction_id", "txn_date", "txn_month", "txn_week", "payment_method")
    assert got["t1"] == (D(2025, 1, 4), "2025-01", "2025-01", "paypal")
    assert got["t2"] == (D(2025, 1, 5), "2025-01", "2025-02", "paypal")
    assert "t5" not in got


def test_status_filters_differ_on_null(shop):
    kept = {f.__name__: shop.transactions.filter(f()).count()
            for f in (st.is_sold, st.not_refunded, st.not_refunded_or_null)}
    assert kept == {"is_sold": 3, "not_refunded": 3, "not_refunded_or_null": 4}


def test_cart_is_a_map(shop):
    sizes = by_key(shop.sessions, "session_id", "viewed_count", "cart_count", "page_count")
    assert sizes["s3"] == (3, 3, 3) and sizes["s6"] == (0, 0, 0)
    assert shop.carts.filter("session_id = 's3'").count() == 3


def test_product_popularity(shop):
    got = rows(products.product_popularity(shop.lines, shop.products))
    assert got == [
        ("p9", None, None, None, 1, 1001.0, 1, 1001.0),
        ("p3", "Product p3", "cat_b", 310.0, 1, 300.0, 1, 300.0),
        ("p2", "Product p2", "cat_a", 50.0, 3, 150.0, 2, 50.0),
        ("p1", "Product p1", "cat_a", 25.0, 3, 59.98, 2, 19.99),
    ]


def test_user_segmentation_by_age(shop):
    got = rows(customers.user_segmentation_by_age(shop.transactions, shop.users))
    assert got == [("55+", 1, 1.0, 1001.0, 1001.0, 100.0), ("18-24", 3, 1.0, 176.66, 176.66, 0.0)]


def test_user_spend_profile(shop):
    got = by_key(customers.user_spend_profile(shop.transactions))
    assert got["u1"] == (1, 139.98, 139.98, 139.98, ["paypal"], "low_value")
    high = customers.user_spend_profile(shop.transactions, "high_value")
    assert rows(high, "user_id") == [("u3",)]


def test_category_revenue_top(shop):
    assert rows(products.category_revenue_top(shop.lines, shop.products)) == [
        (None, 1001.0, 1, 1, 1001.0), ("cat_b", 300.0, 1, 1, 300.0), ("cat_a", 209.98, 6, 4, 52.5),
    ]


def test_co_purchase_pairs(shop):
    got = rows(affinity.co_purchase_pairs(shop.lines, shop.products), "product_a", "product_b", "co_purchase_count")
    assert got == [("p1", "p2", 2), ("p1", "p3", 1), ("p2", "p3", 1)]
    without = affinity.co_purchase_pairs(shop.lines, shop.products, exclude_status="shipped")
    assert rows(without, "product_a", "product_b", "co_purchase_count") == [("p1", "p2", 1)]


def test_cohorts(shop):
    table = cohorts.cohort_analysis(shop.transactions, shop.users)
    assert rows(table) == [
        ("2024-12", 1, 2, 439.98, 219.99, 1), ("2025-01", 1, 1, 370.0, 370.0, 1), ("2025-02", 0, 1, 1001.0, 1001.0, 1),
    ]
    assert rows(cohorts.cohort_pivot(table)) == [
        ("2024-12", None, 439.98, None), ("2025-01", None, 370.0, None), ("2025-02", 1001.0, None, None),
    ]
    matrix = cohorts.cohort_revenue_matrix(table)
    assert matrix.columns == ["reg_month", "Month +0", "Month +1"]
    assert rows(matrix) == [("2024-12", 0.0, 439.98), ("2025-01", 0.0, 370.0), ("2025-02", 1001.0, 0.0)]
    assert cohorts.cohort_revenue_matrix(table, offsets=[0, 1, 2]).columns[-1] == "Month +2"


def test_revenue_by_category(shop):
    table = products.revenue_by_category(shop.lines, shop.products)
    assert rows(table) == [("cat_b", 3, 3, 620.0, 206.67), ("cat_a", 2, 2, 209.98, 52.5)]
    assert rows(products.top_categories(table, 1), "category_id") == [("cat_b",)]


def test_conversion_funnel(shop):
    funnel = funnels.conversion_funnel(shop.sessions)
    assert rows(funnel) == [(6, 4, 4, 3, 50.0)]
    assert rows(funnels.conversion_funnel(shop.sessions, cart_source="cart")) == [(6, 4, 3, 3, 50.0)]
    with pytest.raises(ValueError):
        funnels.conversion_funnel(shop.sessions, cart_source="guess")
    shares = rows(funnels.funnel_percentages(funnel), "stage", "sessions", "pct_of_total")
    assert shares == [
        ("All sessions", 6, 100.0), ("Viewed product", 4, 400 / 6), ("Added to cart", 4, 400 / 6), ("Purchased", 3, 50.0),
    ]


def test_views_and_purchases(shop):
    assert by_key(products.product_views(shop.views)) == {"p1": (3,), "p2": (2,), "p3": (2,)}
    assert by_key(products.product_purchases(shop.lines)) == {
        "p1": (3, 59.98), "p2": (3, 150.0), "p3": (1, 300.0), "p9": (1, 1001.0),
    }
    table = products.product_performance(shop.views, shop.lines, shop.products)
    assert rows(table, "product_id", "total_views", "units_sold", "revenue", "view_to_purchase_rate") == [
        ("p3", 2, 1, 300.0, 0.5), ("p2", 2, 3, 150.0, 1.5), ("p1", 3, 3, 59.98, 1.0),
    ]
    assert products.views_vs_revenue(table).count() == 3


def test_user_segments(shop):
    got = by_key(customers.user_segments(shop.users, shop.transactions), "user_id", "num_orders", "lifetime_value",
                 "avg_order_value", "max_order_value", "customer_segment")
    assert got == {
        "u1": (2, 439.98, 219.99, 300.0, "mid_value"), "u2": (1, 370.0, 370.0, 370.0, "mid_value"),
        "u3": (1, 1001.0, 1001.0, 1001.0, "high_value"), "u4": (0, None, None, None, "low_value"),
    }


def test_age_payment_matrix(shop):
    segments = customers.user_segments(shop.users, shop.transactions)
    matrix = customers.age_payment_spend_matrix(segments)
    assert matrix.columns == ["age_group", "credit_card", "paypal", "unknown"]
    assert rows(matrix) == [
        ("18-24", 0.0, 439.98, 0.0), ("25-34", 0.0, 0.0, 0.0), ("55+", 0.0, 0.0, 1001.0), ("unknown", 370.0, 0.0, 0.0),
    ]
    by_gender = customers.age_payment_spend_matrix(segments.drop("preferred_payment"))
    assert by_gender.columns == ["age_group", "F", "M", "Other"]


def test_weekly(shop):
    assert rows(trends.weekly_trend(shop.transactions)) == [
        ("2025-01", 1, 139.98, 1, 139.98, 1.0), ("2025-07", 1, 370.0, 1, 254.99, 1.0),
        ("2025-08", 1, 1001.0, 1, 503.66, 1.0),
    ]
    assert rows(trends.weekly_revenue(shop.transactions))[0] == ("2025-01", 1, 139.98, 139.98, 1)


def test_session_metrics(shop):
    assert by_key(customers.session_metrics(shop.sessions)) == {
        "u1": (2, 15.0, 30.0, 2, 3), "u2": (2, 10.0, 20.0, 1, 3), "u3": (1, 2.0, 2.0, 0, 1), "u9": (1, 1.0, 1.0, 0, 0),
    }


def test_txn_metrics(shop):
    got = by_key(customers.txn_metrics(shop.transactions))
    assert got["u1"] == (1, 139.98, 139.98, D(2025, 1, 4), D(2025, 1, 4), 0)
    assert set(got) == {"u1", "u2", "u3"}


def test_clv(shop):
    clv = customers.clv_scores(shop.users, shop.transactions, shop.sessions)
    assert len(clv.columns) == 20
    assert by_key(clv, "user_id", "engagement_score", "clv_score", "clv_segment") == {
        "u1": (7.7, 77.53, "silver"), "u2": (4.7, 191.94, "silver"), "u3": (0.7, 506.64, "platinum"),
        "u4": (None, None, "bronze"),
    }
    filled = customers.clv_scores(shop.users, shop.transactions, shop.sessions, fill_converted=True)
    assert by_key(filled, "user_id", "clv_score")["u4"] == (0.0,)
    assert by_key(customers.clv_segment_distribution(clv), "clv_segment", "num_users", "avg_spend") == {
        "platinum": (1, 1001.0), "silver": (2, 254.99), "bronze": (1, 0.0),
    }
    assert rows(customers.clv_segment_dense(clv)) == [
        ("platinum", 1, 1001.0), ("gold", 0, 0.0), ("silver", 2, 254.99), ("bronze", 1, 0.0),
    ]
    assert rows(customers.top_customers(clv, 2), "user_id") == [("u3",), ("u2",)]


def test_product_affinity(shop):
    got = rows(affinity.product_affinity(shop.lines, shop.views, shop.products), "prod_a", "prod_b",
               "purchase_together", "viewed_together", "affinity_score")
    assert got == [("p1", "p2", 2, 2, 8.0), ("p1", "p3", 1, 1, 4.0), ("p2", "p3", 1, 1, 4.0)]


def test_funnel_breakdowns(shop):
    funnel = funnels.funnel_analysis(shop.sessions)
    assert len(funnel.columns) == 11
    assert by_key(funnel, "session_id", "reached_product_view", "reached_cart", "reached_purchase")["s6"] == (0, 0, None)
    assert rows(funnels.funnel_totals(funnel)) == [(6, 4, 4, 3)]
    assert rows(funnels.funnel_by_device(funnel)) == [
        ("mobile", 3, 2, 2, 2, 66.67), ("desktop", 2, 2, 2, 1, 50.0), ("tablet", 1, 0, 0, None, None),
    ]
    assert rows(funnels.funnel_by_referrer(funnel)) == [
        (None, 1, 1, 100.0), ("email", 3, 2, 66.67), ("direct", 2, 0, 0.0),
    ]
    assert by_key(funnels.device_conversion(funnel))["tablet"] == (1, 0, 0.0)
    stats = rows(funnels.device_referrer_stats(shop.sessions))
    assert (None in {r[2] for r in stats}) and sum(r[3] for r in stats) == 6


def test_revenue_by_referrer(shop):
    assert rows(funnels.revenue_by_referrer(shop.sessions, shop.transactions)) == [
        ("email", 2, 1371.0, 685.5), (None, 1, 139.98, 139.98),
    ]


def test_monthly_category_revenue(shop):
    assert rows(products.monthly_category_revenue(shop.lines, shop.products)) == [
        ("2025-01", "cat_a", 2, 139.98), ("2025-02", "cat_b", 1, 300.0), ("2025-02", "cat_a", 2, 70.0),
    ]


def test_session_weekly_trend(shop):
    assert rows(funnels.session_weekly_trend(shop.sessions)) == [
        ("2025-01", 2, 2, 100.0), ("2025-07", 3, 1, 33.33), ("2025-08", 1, 0, 0.0),
    ]


def test_product_daily_metrics(shop):
    metrics = trends.product_daily_metrics(shop.views, shop.carts, shop.lines)
    got = {(r[0], r[1]): tuple(r[2:]) for r in rows(metrics)}
    assert got["p1", D(2025, 1, 4)] == (1, 1, 2, 39.98)
    assert got["p3", D(2025, 1, 4)] == (1, 1, 0, 0.0)
    assert got["p9", D(2025, 2, 20)] == (0, 0, 1, 1001.0)
    assert ("p3", D(2025, 1, 5)) not in got  # a refund


def test_latest_sessions(shop):
    newest = keyed.latest_sessions(shop.sessions, 1)
    assert by_key(newest, "user_id", "session_id") == {"u1": ("s2",), "u2": ("s4",), "u3": ("s7",), "u9": ("s6",)}
    assert rows(keyed.user_sessions(shop.sessions, "u1"), "session_id") == [("s2",), ("s1",)]


def test_wide_sessions(shop):
    wide = by_key(keyed.wide_sessions(shop.sessions), "session_id", "referrer", "viewed", "cart", "page_count", "ip")
    assert wide["s1"] == ("", '["p1","p2"]', '{"p1":{"quantity":1,"price":1.5},"p2":{"quantity":1,"price":1.5}}', "2",
                          "10.0.0.1")
    assert wide["s6"][1] == "[]"


def test_sql_views(shop, spark):
    documents.register_views(shop)
    assert spark.sql("select count(*) from sessions join users using (user_id)").first()[0] == 5


def test_csv_result_keeps_nested_columns(shop, spark, tmp_path):
    funnel = funnels.funnel_analysis(shop.sessions)
    results.write_csv(funnel, str(tmp_path / "funnel"))
    back = results.read_csv(spark, str(tmp_path / "funnel"), funnel.schema)
    assert sorted(rows(back, "session_id", "viewed_products", "referrer"))[2] == ("s3", '["p1","p2","p3"]', "email")
    assert back.count() == 6


def test_key_violations(shop):
    assert documents.key_violations(shop).count() == 0
