import re

import pytest
from conftest import plan, rows
from mini import raw_tables

from gleanstar.operators import serve as g
from gleanstar.plans import cleaning, star
from gleanstar.sources.tables import Warehouse


@pytest.fixture
def store(spark, tmp_path):
    out = Warehouse(spark, prefix="bucketed_", location=str(tmp_path / "db"))
    out.create_namespaces()
    yield out
    for layer in ("raw", "clean", "serving"):
        spark.sql(f"drop database bucketed_{layer} cascade")


def exchanges(df, key):
    return re.findall(rf"Exchange hashpartitioning\({key}#\d+", plan(df))


def test_order_grain_joins_need_no_exchange(spark, store, no_auto_broadcast):
    raw = raw_tables(spark)
    clean = cleaning.clean_all(raw, star.bucketed_save(store, "clean", 4))
    plain = cleaning.clean_all(raw, lambda name, df: Warehouse(spark, store.location).save("clean", f"{name}_plain", df))
    serving = star.build_bucketed_star(clean, store, 4)
    keys, days = store.read("serving", "order_customers"), serving["dim_date"]
    bucketed = g.order_grain_items(clean["order_items"], clean["orders"], clean["order_reviews"], keys, days)
    assert not exchanges(bucketed, "order_id") and "Exchange hashpartitioning" not in plan(bucketed)
    other = g.order_customers(plain["orders"], plain["customers"], serving["dim_customer"])
    shuffled = g.order_grain_items(plain["order_items"], plain["orders"], plain["order_reviews"], other, days)
    assert len(exchanges(shuffled, "order_id")) >= 3
    assert rows(bucketed, *sorted(bucketed.columns)) == rows(shuffled, *sorted(bucketed.columns))
    # grouping by order as well
    assert not exchanges(g.payment_rollup(clean["order_payments"]), "order_id")
    # the whole fact equals that of tables without buckets
    dims = {n: serving[n] for n in ("dim_date", "dim_product", "dim_seller", "dim_customer", "data_quality_flags")}
    assert rows(serving["fact_order_item_fulfillment"]) == rows(star.build_fact(plain, dims))


def test_a_bucket_is_one_file(spark, store):
    saved = store.save("clean", "t", spark.range(1000).selectExpr("id % 37 as k", "id"), bucket_by="k", buckets=3)
    assert len(saved.inputFiles()) == 3 and saved.count() == 1000
    with pytest.raises(ValueError):
        store.save("clean", "t", spark.range(3), bucket_by="id", order_by="id")
    with pytest.raises(ValueError):
        Warehouse(spark, store.location).save("clean", "u", spark.range(3), bucket_by="id")
