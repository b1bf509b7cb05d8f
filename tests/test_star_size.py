"""What the star schema reads, shuffles and stores."""

import time

import pytest
from conftest import one, plan, rows
from pyspark.sql import functions as F

from contract.tables import FACT, Tables
from gleanstar.operators import ranking
from gleanstar.operators import serve as g
from gleanstar.operators import validate as v
from gleanstar.operators.joins import lookup_join
from gleanstar.session import TASK_BYTES, configure_star, stage

SF = "/root/testdata/sf0.001"


def test_a_dimension_builds_only_what_it_needs(spark):
    t = Tables(spark, SF)
    t.star("dim_customer")  # two_hop_key, row_parity_of_keys
    assert set(t._stored) == {"customers", "orders", "order_items", "products", "dim_customer"}
    t = Tables(spark, SF)
    t.star("data_quality_flags")  # unmatched_combinations
    assert set(t._stored) == {"orders", "order_items", "data_quality_flags"}
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == TASK_BYTES
    # cleaned row by row, hence read from the source
    assert all("orders.parquet" in f for f in t.kept("orders").inputFiles())


@pytest.fixture
def tables(spark):
    return Tables(spark, SF)


def test_one_pass_over_the_fact_stores_nothing_wide(tables, monkeypatch):
    staged = []
    real = ranking.stage
    monkeypatch.setattr(ranking, "stage", lambda df, name: staged.append(df.columns) or real(df, name))
    fact = tables.fact_rows()
    assert FACT not in tables._stored and "order_item_key" not in fact.columns
    numbered = tables.fact()
    assert staged and not any("price" in columns for columns in staged)
    assert rows(fact) == rows(numbered.drop("order_item_key"))
    assert sorted(r[0] for r in numbered.select("order_item_key").collect()) == list(range(1, fact.count() + 1))


def test_numbers_follow_the_order(tables):
    fact = tables.fact().join(tables.kept("order_items").select("order_id", "order_item_id").distinct(), ["order_id", "order_item_id"])
    placed = [r[0] for r in fact.orderBy("order_item_key").select(F.struct("order_id", "order_item_id")).collect()]
    assert placed == sorted(placed)


def test_other_leading_columns_number_the_same_items(tables, spark):
    clean = {n: tables.kept(n) for n in ("order_items", "orders", "order_reviews", "customers")}
    d = tables.dims()
    by = ["price", "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date"]
    fact = g.fact_order_item(
        *[clean[n] for n in ("order_items", "orders", "order_reviews", "customers")],
        *[d[n] for n in ("dim_customer", "dim_seller", "dim_product", "dim_date", "data_quality_flags")],
        order_by=by,
    )
    prices = [r[0] for r in fact.orderBy("order_item_key").select("price").collect()]
    assert prices == sorted(prices) and rows(fact.drop("order_item_key")) == rows(tables.fact_rows())


def test_sellers_orders_shuffle_once(tables, no_auto_broadcast):
    text = plan(g.seller_activity(tables.kept("order_items"), tables.kept("orders")))
    # items by order, orders by order, sellers
    assert text.count("Exchange hashpartitioning") == 3


def test_flags_meet_orders_without_a_second_shuffle(spark, no_auto_broadcast):
    items = spark.sql("select * from values (1L, true), (1L, true), (1L, false), (2L, null), (3L, true), (4L, null), (4L, false) as t(order_id, is_shipping_date_anomaly)")
    orders = spark.createDataFrame([(i, *[i == 2] * 5) for i in (1, 2, 4)], ["order_id", *g.ORDER_FLAGS])
    got = g.flagged_orders(items, orders)
    assert plan(got).count("Exchange hashpartitioning") == 2
    assert rows(got, "order_id", "is_shipping_anomaly") == [(1, False), (1, True), (2, None), (4, False), (4, None)]


def test_null_reconcile_reads_the_children_once(spark):
    parent = spark.sql("select * from values (1, null), (2, 5), (3, null), (null, null), (3, null) as t(k, d)")
    child = spark.sql("select * from values (1, null), (1, 7), (2, null), (3, 1), (3, 2), (null, 4), (9, null) as t(k, c)")
    got = v.grain_null_reconcile(parent, child.hint("rebalance"), "k", "d", "c")
    assert plan(got).count("REBALANCE_PARTITIONS") == 1
    assert one(got) == {"parent_nulls": 4, "child_nulls": 3, "mismatched_rows": 3}
    none = v.grain_null_reconcile(parent.limit(0), child.limit(0), "k", "d", "c")
    assert one(none) == {"parent_nulls": 0, "child_nulls": 0, "mismatched_rows": 0}


def test_many_rows_in_a_small_file_are_not_broadcast(spark):
    configure_star(spark)
    items = spark.range(0, 2_000_000, 2, 8)

    def joined(n):
        dim = stage(spark.range(n).withColumn("key", F.col("id") + 1).sort("id"), "dim")
        # small for the optimizer
        assert dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10 << 20
        out = lookup_join(items, dim, "id", "inner").agg(F.count("key"))
        return out.collect()[0][0], plan(out)

    found, text = joined(1_000_000)  # 24 MB of rows in a file of a few
    assert found == 500_000 and "BroadcastHashJoin" not in text
    found, text = joined(1_000)
    assert found == 500 and "BroadcastHashJoin" in text


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName() for f in (blocks.apply(i) for i in range(blocks.size())) if f.getName().startswith("shuffle_")}

    before = files()
    df = spark.range(0, 100_000, 1, 4).groupBy((F.col("id") % 5000).alias("k")).agg(F.count("*").alias("n"))
    stored = stage(df, "counts")
    for _ in range(50):
        if not (left := files() - before):
            break
        time.sleep(0.1)
    # df is still there, so no garbage collection has taken them
    assert not left and stored.count() == df.count() == 5000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
