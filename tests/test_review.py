"""Rules that the test tables alone do not trigger."""

import pytest
from pyspark.sql import functions as F

from shopscope.functions import rowkeys
from shopscope.operators import keyed
from shopscope.plans import cohorts, funnels, products
from shopscope.sources.documents import Store


@pytest.fixture
def new_york(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", zone)


def test_row_keys_do_not_depend_on_the_zone(new_york):
    """Also for a time that the zone skips."""
    for text, millis in (("2024-01-03 12:30:15.25", 1704285015250), ("2024-03-10 02:30:00", 1710037800000)):
        key = new_york.range(1).select(rowkeys.session_key(F.lit(7), F.lit(text).cast("timestamp_ntz"))).first()[0]
        assert key == f"7#{2**63 - 1 - millis:019d}"


def test_a_redelivered_transaction_counts_once(spark):
    sessions = spark.createDataFrame([("s1", "email"), ("s2", "email")], "session_id string, referrer string")
    sales = spark.createDataFrame(
        [("t1", "s1", "completed", 10.0), ("t1", "s1", "completed", 10.0), ("t2", "s2", "completed", 4.0)],
        "transaction_id string, session_id string, status string, total double")
    row = funnels.revenue_by_referrer(sessions, sales).first()
    assert (row.num_transactions, row.total_revenue, row.avg_order_value) == (2, 24.0, 8.0)


def test_a_transaction_of_two_users_counts_once(spark):
    lines = spark.createDataFrame(
        [("t1", "u1", "p1", 5.0), ("t1", "u2", "p1", 5.0), ("t2", "u2", "p1", 2.0)],
        "transaction_id string, user_id string, product_id string, subtotal double")
    catalogue = spark.createDataFrame([("p1", "c1")], "product_id string, category_id string")
    row = products.revenue_by_category(lines, catalogue).first()
    assert (row.num_transactions, row.num_customers, row.total_revenue) == (2, 2, 12.0)


def test_cohort_columns_come_in_number_order(spark):
    rows = [("2024-01", k, 1.0 * k) for k in (0, 1, 2, 10, 11, 12)]
    table = spark.createDataFrame(rows, "reg_month string, months_since_reg int, total_revenue double")
    matrix = cohorts.cohort_revenue_matrix(table, max_offset=12)
    assert matrix.columns == ["reg_month", *(f"Month +{k}" for k in (0, 1, 2, 10, 11, 12))]
    assert matrix.first()["Month +10"] == 10.0


def test_lenient_store_serves_every_frame(spark, tmp_path):
    """Sessions without a user stay, with their carts and wide rows."""
    spark.createDataFrame(
        [("s1", None, "2024-01-01T10:00:00", 5, ["p1"], {"p1": (2, 3.5)})],
        "session_id string, user_id string, start_time string, duration_seconds bigint, viewed_products array<string>, "
        "cart_contents map<string,struct<quantity:int,price:double>>").write.parquet(str(tmp_path / "sessions"))
    store = Store(spark, str(tmp_path), strict=False)
    assert [(r.product_id, r.quantity) for r in store.carts.collect()] == [("p1", 2)]
    assert [r.product_id for r in store.views.collect()] == ["p1"]
    assert keyed.wide_sessions(store.sessions).first().viewed == '["p1"]'
