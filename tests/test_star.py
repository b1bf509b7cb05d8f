import datetime as dt

import pytest
from conftest import one, plan, rows
from mini import raw_tables
from pyspark.sql import functions as F

from gleanstar.operators import serve as g
from gleanstar.plans import cleaning, star
from gleanstar.session import stage

ITEM_KEY = ("order_id", "order_item_id", "shipping_limit_date", "price")
FACT = "fact_order_item_fulfillment"


@pytest.fixture(scope="module")
def clean(spark):
    return cleaning.clean_all(raw_tables(spark), lambda name, df: stage(df, name))


@pytest.fixture(scope="module")
def serving(clean):
    return star.build_star(clean, lambda name, df: stage(df, name), ITEM_KEY)


def test_calendar(serving):
    d = serving["dim_date"]
    assert d.count() == 532
    assert one(d.filter("date_key = 20170108")) == {
        "date_key": 20170108,
        "full_date": dt.date(2017, 1, 8),
        "year": 2017,
        "quarter": 1,
        "month": 1,
        "month_name": "January",
        "week_of_year": 1,
        "day_of_month": 8,
        "day_of_week": 1,
        "day_name": "Sunday",
        "is_weekend": True,
    }


def test_products(serving):
    assert rows(serving["dim_product"]) == [
        (1, "d1", "toys", "toys"),
        (2, "d2", "books", "books"),
        (3, "d3", "toys", "toys"),
        (4, "d4", "cool_stuff", "cool_stuff"),
        (5, "d5", "unknown", "unknown"),
        (6, "d6", "toys", "toys"),
        (7, "d7", "books", "books"),
    ]


def test_sellers(serving):
    assert rows(serving["dim_seller"], "seller_key", "seller_id", "seller_tenure_bucket", "seller_volume_tier") == [
        (1, "s1", "established", "high"),
        (2, "s2", "established", "medium"),
        (3, "s3", "established", "low"),
        (4, "s4", "new", "low"),
        (5, "s5", None, None),
    ]


def test_seller_with_only_undated_orders_is_established(spark, clean):
    orders = clean["orders"].withColumn(
        "order_purchase_timestamp", F.when(F.col("order_id") != "o7", F.col("order_purchase_timestamp"))
    )
    got = dict(rows(g.dim_seller(clean["sellers"], clean["order_items"], orders), "seller_id", "seller_tenure_bucket"))
    assert got["s4"] == "established" and got["s5"] is None


def test_customers(serving):
    assert rows(
        serving["dim_customer"],
        "customer_key",
        "customer_unique_id",
        "customer_state",
        "customer_zip_code_prefix",
        "first_purchase_category",
    ) == [
        (1, "p1", "RJ", "20040", "toys"),
        (2, "p2", "SP", "01310", "toys"),
        (3, "p3", "MG", "30110", "toys"),
        (4, "p4", "XX", "99999", "cool_stuff"),
        (5, "p5", "SP", "01310", "books"),
        (6, "p6", "SP", "01310", "unknown"),
        (7, "p8", "SP", "00123", "books"),
    ]


def test_first_category_ties_and_missing_prices(spark):
    people = spark.createDataFrame([("p", "o"), ("q", "u"), ("r", "w")], "customer_unique_id string, first_order_id string")
    items = spark.createDataFrame(
        [("o", "b", 5.0), ("o", "a", 5.0), ("o", "c", None), ("u", "a", 5.0), ("u", "n", 5.0)],
        "order_id string, product_id string, price double",
    )
    products = spark.createDataFrame(
        [("a", "apples"), ("b", "bread"), ("c", "aaa"), ("n", None)], "product_id string, product_category_name string"
    )
    # equal price: category ascending, NULL first; a NULL price comes last; no items: no row
    assert rows(g.first_categories(people, items, products)) == [("p", "apples"), ("q", None)]


def test_quality_flags(serving):
    f, t = False, True
    assert rows(serving["data_quality_flags"]) == [
        (1, f, f, f, f, f, None),
        (2, f, f, f, f, f, f),
        (3, f, f, f, f, t, f),
        (4, f, f, f, t, f, t),
        (5, f, t, t, f, f, f),
        (6, t, f, f, f, f, f),
    ]


def fact_row(fact, order, line=1):
    return one(fact.filter((F.col("order_id") == order) & (F.col("order_item_id") == line)))


def test_fact_grain_and_keys(serving):
    fact = serving[FACT]
    assert fact.columns == g.FACT_COLUMNS
    assert rows(fact, "order_item_key", "order_id", "order_item_id") == sorted(
        [
            (1, "o1", 1),
            (2, "o1", 2),
            (3, "o10", 1),
            (4, "o10", 2),
            (5, "o10", 2),
            (6, "o2", 1),
            (7, "o3", 1),
            (8, "o4", 1),
            (9, "o5", 1),
            (10, "o6", 1),
            (11, "o7", 1),
            (12, "o8", 1),
        ],
        key=repr,
    )


def test_fact_measures(serving):
    fact = serving[FACT]
    first = fact_row(fact, "o1")
    assert first == {
        "order_item_key": 1,
        "order_id": "o1",
        "order_item_id": 1,
        "customer_key": 1,
        "seller_key": 1,
        "product_key": 1,
        "order_date_key": 20170105,
        "data_quality_key": 2,
        "price": 100.0,
        "freight_value": 10.0,
        "freight_to_price_ratio": 0.1,
        "approval_to_carrier_hours": 25,
        "carrier_to_customer_days": 3,
        "is_delivered_on_time": True,
        "delivery_estimate_error_days": -2,
        "review_score": 1,  # same date: the higher review id
        "has_review": True,
        "has_fulfillment_anomaly": False,
        "order_status": "delivered",
    }
    late = fact_row(fact, "o2")
    assert (late["is_delivered_on_time"], late["delivery_estimate_error_days"]) == (False, 0)
    early = fact_row(fact, "o3")
    assert early["carrier_to_customer_days"] == -1  # -42 hours, toward zero
    assert early["freight_to_price_ratio"] is None
    assert (early["review_score"], early["has_fulfillment_anomaly"], early["data_quality_key"]) == (2, True, 6)
    assert fact_row(fact, "o4")["approval_to_carrier_hours"] == -11
    unsure = fact_row(fact, "o5")
    assert unsure["has_fulfillment_anomaly"] is None and unsure["data_quality_key"] is None
    assert unsure["is_delivered_on_time"] is None and unsure["delivery_estimate_error_days"] is None
    assert fact_row(fact, "o8")["has_review"] is False


def test_null_safe_junk_lookup_finds_the_null_flag(clean, serving):
    fact = g.fact_order_item(
        clean["order_items"],
        clean["orders"],
        clean["order_reviews"],
        clean["customers"],
        serving["dim_customer"],
        serving["dim_seller"],
        serving["dim_product"],
        serving["dim_date"],
        serving["data_quality_flags"],
        order_by=ITEM_KEY,
        null_safe_flags=True,
    )
    assert fact_row(fact, "o5")["data_quality_key"] == 1


def test_fact_plan_has_no_cross_join(clean, serving, no_auto_broadcast):
    text = plan(star.build_fact(clean, serving, ITEM_KEY))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_zip_centroid_and_payment_rollup(clean):
    assert rows(g.zip_centroid(clean["geolocation"].filter("geolocation_zip_code_prefix = '20040'"))) == [
        ("20040", -22.9, -43.2, 2)
    ]
    assert rows(g.payment_rollup(clean["order_payments"].filter("order_id = 'o1'"))) == [("o1", 160.0, 2)]


def test_summary(serving):
    summary = star.fulfilment_summary(serving[FACT], serving["data_quality_flags"])
    got = one(summary.filter("data_quality_key = 2"))
    assert (got["items"], got["on_time"], got["late"], got["anomalies"]) == (7, 5, 1, 0)
    assert got["on_time_pct"] == 83.33
