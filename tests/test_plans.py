"""Physical plans, as planned for tables too large to broadcast."""

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from gleanstar.operators import audit as a
from gleanstar.operators import clean as k
from gleanstar.operators import profile as p
from gleanstar.operators import serve as g
from gleanstar.functions import timeparts as tp

pytestmark = pytest.mark.usefixtures("no_auto_broadcast")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("plans")
    spark.range(1000).selectExpr(
        "id", "id % 10 as k", "id % 7 as v", "cast(id as string) as name", "timestamp_seconds(id * 86400) as ts"
    ).write.parquet(str(base / "t"))
    spark.range(12).selectExpr("id as k", "id * 2 as w").write.parquet(str(base / "ref"))
    return spark.read.parquet(str(base / "t")), spark.read.parquet(str(base / "ref"))


def test_orphans_combine_before_the_anti_join(stored):
    t, ref = stored
    text = plan(a.orphan_count(t, ref, "k"))
    assert "LeftAnti" in text and "LeftOuter" not in text
    assert "ReadSchema: struct<k:bigint>" in text
    # the child's exchange carries counts per key, which the join then reuses
    assert "partial_count(1)" in text and text.count("Exchange hashpartitioning(k#") == 2


def test_not_in_does_not_broadcast_the_list(spark, stored):
    t, ref = stored
    text = plan(a.not_in_null_aware(t, ref, "k"))
    assert "BroadcastNestedLoopJoin" not in text and "isNullAware" not in text and "SortMergeJoin" in text
    with_null = ref.unionByName(spark.sql("select cast(null as bigint) as k, 1L as w"))
    assert a.not_in_null_aware(t, with_null, "k").count() == 0
    empty = ref.limit(0)
    nulls = spark.sql("select cast(null as bigint) as k")
    assert rows(a.not_in_null_aware(nulls, empty, "k")) == [(None,)]
    assert a.not_in_null_aware(nulls, ref, "k").count() == 0


def test_period_filter_reaches_the_scan(stored):
    t, _ = stored
    text = plan(t.filter(tp.in_month("ts", "1970-02")).select("id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text and "LessThan(ts," in text
    assert t.filter(tp.in_month("ts", "1970-02")).count() == 28


def test_bounds_filter_reaches_the_scan(stored):
    t, _ = stored
    text = plan(k.drop_out_of_bounds(t, {"v": (1, 3)}))
    assert "GreaterThanOrEqual(v,1)" in text and "LessThanOrEqual(v,3)" in text


def test_profile_reads_only_its_columns_once_and_does_not_expand(stored):
    """Several distinct counts come from one scan of their columns."""
    t, _ = stored
    text = plan(p.table_profile(t, ["id", "k", "v"], ["name"]))
    assert "Expand" not in text and text.count("FileScan parquet") == 1
    assert "ReadSchema: struct<id:bigint,k:bigint,v:bigint,name:string>" in text


def test_share_of_total_needs_no_window(stored):
    t, _ = stored
    assert "Window" not in plan(p.freq_distribution(t, "k"))


def test_flags_need_no_window_over_a_key(stored):
    t, _ = stored
    text = plan(k.multi_value_flag(t, "k", ["v"], "several"))
    assert "Window" not in text and "partial_min" in text


def test_first_and_latest_aggregates_once(spark, stored):
    t, _ = stored
    people = t.selectExpr(
        "k as customer_unique_id",
        "name as customer_state",
        "name as customer_city",
        "name as customer_zip_code_prefix",
        "id as order_id",
        "ts as order_purchase_timestamp",
    )
    text = plan(g.first_and_latest(people))
    assert text.count("Exchange hashpartitioning") == 1 and "partial_max_by" in text


def test_quality_flags_reduce_items_before_the_join(stored):
    t, _ = stored
    items = t.selectExpr("id as order_id", "v = 1 as is_shipping_date_anomaly")
    orders = t.select(F.col("id").alias("order_id"), *[(F.col("v") == i).alias(c) for i, c in enumerate(g.ORDER_FLAGS)])
    text = plan(g.flagged_orders(items, orders))
    assert "HashAggregate" in text.split("SortMergeJoin")[1]


def test_no_python_in_the_plans(stored):
    t, _ = stored
    for df in (p.fd_variants(t, "k", "name"), p.duration_histogram(t, "ts", "ts"), k.fold_diacritics(t, ["name"])):
        assert "Python" not in plan(df) and "MapInPandas" not in plan(df)
