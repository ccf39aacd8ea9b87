import datetime

import pytest
from pyspark.sql import functions as F

from shopscope.functions import bands, calendar, money, rowkeys
from shopscope.operators import cleaning
from shopscope.plans import customers

# A Tuesday to a Monday round the turn of the year, and a quarter's end.
WEEKS = {
    "2024-12-28": "2024-52", "2024-12-29": "2025-01", "2024-12-31": "2025-01", "2025-01-04": "2025-01",
    "2025-01-05": "2025-02", "2025-03-31": "2025-14",
}


def column(spark, values, type_, expr):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {type_}")
    return [r[0] for r in df.orderBy("n").select(expr(F.col("v"))).collect()]


def test_us_week(spark):
    got = column(spark, list(WEEKS), "string", lambda v: calendar.us_week(v.cast("date")))
    assert got == list(WEEKS.values())
    assert column(spark, [None], "date", calendar.us_week) == [None]


def test_us_week_of_every_day(spark):
    """Week 1 holds 1 January and weeks start on Sunday."""
    days = spark.sql("select explode(sequence(date'1990-01-01', date'2030-12-31')) as d")
    for day, label in days.select("d", calendar.us_week("d")).collect():
        sunday = day - datetime.timedelta(days=(day.weekday() + 1) % 7)
        year = (sunday + datetime.timedelta(days=6)).year
        new_year = datetime.date(year, 1, 1)
        first = new_year - datetime.timedelta(days=(new_year.weekday() + 1) % 7)
        assert label == f"{year}-{(sunday - first).days // 7 + 1:02d}"


def test_age_bands(spark):
    ages = [24, 25, 44, 45, 54, 55, None]
    assert column(spark, ages, "int", bands.age_band) == ["18-24", "25-34", "35-44", "45-54", "45-54", "55+", "unknown"]
    assert column(spark, [None], "int", lambda a: bands.age_band(a, "18-24")) == ["18-24"]


def test_price_tiers(spark):
    prices = [19.99, 20.0, 99.99, 100.0, 299.99, 300.0]
    tiers = ["budget", "mid-range", "mid-range", "premium", "premium", "luxury"]
    assert column(spark, prices, "double", bands.price_tier) == tiers


def test_spend_and_value_tiers(spark):
    spend = [1000.0, 1000.01, 300.0, None]
    assert column(spark, spend, "double", bands.spend_tier) == ["mid_value", "high_value", "low_value", "low_value"]
    scores = [500.0, 200.0, 50.0, None]
    assert column(spark, scores, "double", bands.clv_tier) == ["gold", "silver", "bronze", "bronze"]


def test_money_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1.15,), (2.675,)], "v double")
    assert df.limit(10).agg(money.amount(money.sum_units("v"))).first()[0] == 1.0
    assert column(spark, [2_010_000], "bigint", lambda c: F.round(money.mean_amount(c, F.lit(2)), 2)) == [1.01]
    assert column(spark, [2_010_000, 2_030_000], "bigint", lambda c: F.bround(money.mean_amount(c, F.lit(2)), 2)) == [1.0, 1.02]
    assert column(spark, [1], "bigint", lambda c: money.ratio(c, F.lit(0), 2)) == [None]


def test_parts_of_a_cent_add_up(spark):
    """0.004 a thousand times is 4.00, however the rows lie, and rounding comes after the sum."""
    rows = [(0.004, k % 7) for k in range(1000)] + [(1e9 + 0.01, 1), (-1e9, 1)]
    df = spark.createDataFrame(rows, "v double, k int")
    for parts in (1, 3, 8):
        shuffled = df.orderBy(F.rand(parts)).repartition(parts)
        assert shuffled.filter("v < 1 AND v > 0").agg(money.amount(money.sum_units("v"))).first()[0] == 4.0
        twice = shuffled.groupBy("k").agg(money.sum_units("v").alias("u")).agg(money.amount(money.total("u")), money.exact_amount(money.total("u"))).first()
        assert tuple(twice) == (4.01, 4.01)
    assert df.filter("k = 0 AND v = 0.004").limit(1).agg(money.amount(money.sum_units("v")), money.exact_amount(money.sum_units("v"))).first()[:] == (0.0, 0.004)


def test_totals_do_not_overflow(spark):
    df = spark.createDataFrame([(9e12,)] * 50, "v double").withColumn("k", F.monotonically_increasing_id())
    assert df.groupBy("k").agg(money.sum_units("v").alias("u")).agg(money.exact_amount(money.total("u"))).first()[0] == 4.5e14


def test_means_of_users_do_not_depend_on_tasks(spark):
    rows = [(u, 0.1 * (u % 13) + 0.37 * k, "completed") for u in range(200) for k in range(3)]
    users = spark.createDataFrame([(u, 30) for u in range(200)], "user_id bigint, age int")
    txns = spark.createDataFrame(rows, "user_id bigint, total double, status string")
    found = {str(customers.user_segmentation_by_age(txns.orderBy(F.rand(s)).repartition(s), users).collect()) for s in (1, 2, 5, 8)}
    assert len(found) == 1


def test_months_apart(spark):
    df = spark.createDataFrame([("2025-02-01", "2024-12-31"), ("2024-11-30", "2025-01-01")], "a string, b string")
    got = df.select(calendar.months_apart(F.col("a").cast("date"), F.col("b").cast("date"))).collect()
    assert [r[0] for r in got] == [2, -2]


def test_row_keys_sort_newest_first(spark):
    df = spark.createDataFrame([("u", "2025-01-01T00:00:00"), ("u", "2025-03-01T10:15:31")], "u string, t string")
    keys = [r[0] for r in df.select(rowkeys.session_key("u", F.col("t").cast("timestamp"))).collect()]
    assert sorted(keys) == keys[::-1]
    assert keys[1] == f"u#{2**63 - 1 - 1740824131000:019d}"
    day = spark.sql("select 'prod_00123' as p, date'2025-03-12' as d").select(rowkeys.product_day_key("p", "d"))
    assert day.first()[0] == "prod_00123#2025-03-12"


def test_bad_timestamps_become_null(spark):
    df = spark.createDataFrame([("2025-01-01T10:00:00",), ("yesterday",), (None,)], "t string")
    got = [r[0] for r in cleaning.parse_timestamp(df, "t").collect()]
    assert got == [datetime.datetime(2025, 1, 1, 10), None, None]


def test_required_keeps_unparseable_dates(spark):
    df = spark.createDataFrame([("u1", "yesterday"), (None, "2025-01-01T10:00:00")], "user_id string, registration_date string")
    got = cleaning.clean_users(df).select("user_id", "registration_date", "name", "age_group", "city").collect()
    assert [tuple(r) for r in got] == [("u1", None, None, "unknown", None)]


def test_required_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert cleaning.required(df, "v").count() == 1


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), (None,)], "v string")
    assert [r[0] for r in cleaning.coerce_numeric(df, {"v": "double"}).collect()] == [1.5, None, None]
    assert dict(cleaning.coerce_numeric(spark.range(1), {"id": "double"}).dtypes) == {"id": "bigint"}


@pytest.mark.parametrize("typed", [True, False])
def test_transactions_take_text_or_timestamps(spark, typed):
    df = spark.createDataFrame([("t", "u", "2025-01-05T00:00:00", 1.0, "X")],
                               "transaction_id string, user_id string, timestamp string, total double, payment_method string")
    if typed:
        df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    assert cleaning.clean_transactions(df).first()["txn_week"] == "2025-02"
