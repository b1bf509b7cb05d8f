import datetime as dt

import pytest
from conftest import one, rows
from mini import raw_tables
from pyspark.sql import functions as F

from gleanstar.functions import text as tx
from gleanstar.operators import clean as k
from gleanstar.operators import joins
from gleanstar.plans import cleaning


@pytest.fixture(scope="module")
def clean(spark):
    return {n: df.cache() for n, df in cleaning.clean_all(raw_tables(spark)).items()}


def flagged(df, flag, key="order_id"):
    return sorted(r[0] for r in df.filter(F.col(flag)).select(key).collect())


def test_lifecycle_flags(clean):
    o = clean["orders"]
    assert o.count() == 10
    assert flagged(o, "is_expected_null_delivery") == ["o8"]
    assert flagged(o, "is_delivered_missing_final_date_only") == ["o5"]
    assert flagged(o, "is_delivered_missing_multiple_dates_anomaly") == ["o6"]
    assert flagged(o, "is_delivered_missing_approval_anomaly") == ["o6"]
    assert flagged(o, "is_delivered_missing_carrier_anomaly") == ["o6"]
    assert flagged(o, "is_canceled_with_delivery_date_anomaly") == ["o7"]
    assert flagged(o, "is_delivery_before_carrier_anomaly") == ["o3"]
    assert flagged(o, "is_carrier_before_approval_anomaly") == ["o4"]


def test_null_status_gives_null_or_false_flags(clean):
    row = one(clean["orders"].filter("order_id = 'o9'"))
    assert row["is_expected_null_delivery"] is None
    assert row["is_delivered_missing_multiple_dates_anomaly"] is None
    assert row["is_canceled_with_delivery_date_anomaly"] is False
    assert row["is_carrier_before_approval_anomaly"] is False


def test_status_is_trimmed_and_lowered(clean):
    assert rows(clean["orders"].filter("order_id = 'o2'"), "order_status") == [("delivered",)]


def test_customers(clean):
    c = clean["customers"]
    assert flagged(c, "has_multiple_addresses_on_record", "customer_id") == ["c1", "c10"]
    assert rows(c.filter("customer_id in ('c1', 'c8')"), "customer_zip_code_prefix", "customer_city", "customer_state") == [
        ("00123", "santos", "SP"),
        ("01310", "sao paulo", "SP"),
    ]


def test_items(clean):
    i = clean["order_items"]
    assert rows(i.filter("order_id = 'o2'"), "seller_id") == [("s1",)]
    assert flagged(i, "is_zero_freight") == ["o1"]
    assert flagged(i, "is_shipping_date_anomaly") == ["o4"]
    assert rows(i.filter("order_id = 'o5'"), "is_shipping_date_anomaly") == [(None,)]


def test_payments(clean):
    y = clean["order_payments"]
    assert flagged(y, "has_missing_sequential_start") == ["o2"]
    assert flagged(y, "is_zero_payment_value") == ["o3", "o4"]
    assert flagged(y, "is_undefined_payment_type") == ["o3"]
    assert flagged(y, "is_zero_installments") == ["o3"]
    assert rows(y.filter("order_id = 'o5'"), "is_zero_payment_value") == [(None,)]


def test_missing_start_treats_null_keys_as_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 2)], "k string, s int")
    assert rows(k.missing_sequence_start(df, "k", "s", "late")) == [("a", 2, True), (None, 1, False), (None, 2, False)]


def test_reviews(clean):
    r = clean["order_reviews"]
    assert rows(r.filter("review_id = 'r1'"), "review_comment_title", "review_comment_message") == [(None, "great")]
    assert r.filter("review_comment_message is null").count() == 4


def test_products(clean):
    d = clean["products"]
    weights = dict(rows(d, "product_id", "product_weight_g"))
    # toys weigh 500 and 700: the lower middle value
    assert weights["d3"] == 500
    assert weights["d5"] == 0
    assert weights["d7"] is None
    assert flagged(d, "had_zero_weight_imputed", "product_id") == ["d3", "d5"]
    assert flagged(d, "had_null_category", "product_id") == ["d5"]
    assert rows(d.filter("product_id = 'd5'"), "product_category_name") == [("unknown",)]
    assert rows(d.filter("product_id = 'd7'"), "had_zero_weight_imputed") == [(None,)]


def test_sellers(clean):
    s = clean["sellers"]
    assert rows(s, "seller_id", "seller_city", "city_was_corrected", "has_wrong_attribute_city") == [
        ("s1", "guarulhos", True, False),
        ("s2", "sao paulo", True, False),
        ("s3", "sp", False, True),
        ("s4", "rio de janeiro", False, False),
        ("s5", "rio de janeiro", True, False),
    ]
    assert rows(s.filter("seller_id = 's1'"), "seller_zip_code_prefix", "seller_state") == [("01310", "SP")]


def test_corrections_list_is_a_function():
    assert len(k.CITY_CORRECTIONS) == 24
    assert len({a for a, _ in k.CITY_CORRECTIONS}) == 24


def test_geolocation(clean):
    g = clean["geolocation"]
    assert g.count() == 6  # box edges stay; outside and NULL rows go
    assert set(rows(g, "geolocation_zip_code_prefix", "has_unresolved_city_ambiguity")) == {
        ("01310", False),
        ("20040", True),
        ("30110", False),
    }
    assert g.filter(tx.has_accent("geolocation_city")).count() == 0


def test_folding_before_lowering_keeps_upper_case_accents(spark):
    raw = raw_tables(spark)["geolocation"]
    df = cleaning.clean_geolocation(raw, lower_first=False)
    assert ("são paulo",) in rows(df, "geolocation_city")
    assert df.filter("geolocation_zip_code_prefix = '01310' and has_unresolved_city_ambiguity").count() == 3


def test_translation(clean):
    assert rows(clean["category_translation"]) == [("books", "books"), ("toys", "toys"), ("unused", "never")]


def test_trim_strips_all_white_space(spark):
    df = spark.createDataFrame([("\t  a b 　\n",)], "s string")
    assert rows(df.select(tx.trimmed("s"))) == [("a b",)]


def test_fold_maps_every_listed_letter(spark):
    assert len(tx.ACCENTED) == len(tx.PLAIN) == 23
    df = spark.createDataFrame([("Ênfase ÁÉÍÓÚ çãõ",)], "s string")
    assert rows(df.select(tx.folded("s"))) == [("enfase aeiou cao",)]


def test_pad_code_truncates_longer_codes(spark):
    df = spark.createDataFrame([(1,), (123456,), (None,)], "c int")
    assert rows(df.select(tx.padded_code("c"))) == [("00001",), ("12345",), (None,)]


def test_strict_timestamps_fail_on_bad_text(spark):
    df = spark.createDataFrame([("n/a",)], "t string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        k.typed_timestamps(df, ["t"]).collect()
    good = spark.createDataFrame([("2018-01-02 03:04:05",)], "t string")
    assert rows(k.typed_timestamps(good, ["t"])) == [(dt.datetime(2018, 1, 2, 3, 4, 5),)]


def test_flags_survive_a_hot_key(spark, no_auto_broadcast):
    """One key with a third of all rows."""
    df = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 0 when id % 50 = 0 then null else id div 4 end as k", "id % 7 as v"
    )
    got = rows(k.multi_value_flag(df, "k", ["v"], "several"))
    values = {}
    for r in df.collect():
        values.setdefault(r.k, set()).add(r.v)
    want = [(r.id, r.k, r.v, None if r.k is None else len(values[r.k]) > 1) for r in df.collect()]
    assert got == sorted(want, key=repr)
    assert sum(1 for r in want if r[3] is None) == 40
