"""Queries through the sources and sinks: CSV ingest, table store, report files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.adapters import ITEM_KEY
from contract.registry import query
from gleanstar.operators import checks as c
from gleanstar.operators.profile import freq_distribution
from gleanstar.plans import star
from gleanstar.plans.checks import CHECKS, FACT_KEYS, ORDER_FLAGS
from gleanstar.plans.cleaning import CLEANERS
from gleanstar.session import staging_folder
from gleanstar.sources import tables as src


def _folder(t) -> str:
    return staging_folder(t.spark)


def _as_csv(df: DataFrame, path: str) -> str:
    """A CSV file set as a data provider would land it."""
    df.write.options(
        header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


@query(
    "csv_ingest",
    """select order_id, payment_sequential, trim(payment_type) as payment_type, payment_installments, payment_value
    from x_order_payments""",
)
def _(t):
    path = _as_csv(t.raw("order_payments"), os.path.join(_folder(t), "payments.csv"))
    back = src.read_raw_csv(t.spark, "order_payments", path)
    return back.withColumn("order_id", F.col("order_id").cast("bigint")).withColumn(
        "payment_type", F.trim("payment_type")
    )


@query("csv_ingest_inferred", "select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem")
def _(t):
    items = t.src("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    back = src.read_csv(t.spark, _as_csv(items, os.path.join(_folder(t), "items.csv")), infer=True)
    return back.withColumn("l_orderkey", F.col("l_orderkey").cast("bigint"))


@query(
    "csv_ingest_multiline",
    "select conv_id, turn, md5(text) as digest from conversations",
)
def _(t):
    texts = t.src("conversations").select("conv_id", "turn", "text")
    path = _as_csv(texts, os.path.join(_folder(t), "texts.csv"))
    back = src.read_csv(t.spark, path, texts.schema, multiline=True)
    return back.select("conv_id", "turn", F.md5("text").alias("digest"))


@query(
    "table_store_replace",
    "select c_custkey, upper(c_name) as c_name, c_acctbal from customer",
)
def _(t):
    store = src.Warehouse(t.spark, _folder(t))
    store.create_namespaces()
    first = store.save("raw", "customer", t.src("customer").select("c_custkey", "c_name", "c_acctbal"))
    store.save("clean", "customer", first)
    store.save("clean", "customer", first.withColumn("c_name", F.upper("c_name")))
    return store.read("clean", "customer")


def _databases(t) -> src.Warehouse:
    folder = _folder(t)
    store = src.Warehouse(t.spark, prefix=f"shop_{os.path.basename(folder)}_", location=folder)
    store.create_namespaces()
    return store


def _replaced(t, store: src.Warehouse) -> DataFrame:
    """A table saved three times: from raw, from itself, and by a write that fails."""
    first = store.save("raw", "customer", t.src("customer").select("c_custkey", "c_name", "c_acctbal"))
    store.save("clean", "customer", first)
    store.save("clean", "customer", store.read("clean", "customer").withColumn("c_name", F.upper("c_name")))
    try:
        store.save("clean", "customer", first.withColumn("c_name", F.when(F.length("c_name") > 0, F.raise_error(F.lit("stopped"))).cast("string")))
    except Exception as e:  # noqa: BLE001
        if "stopped" not in str(e):
            raise
    store.vacuum("clean", "customer")
    return store.read("clean", "customer")


@query("table_store_failed_write", "select c_custkey, upper(c_name) as c_name, c_acctbal from customer")
def _(t):
    return _replaced(t, src.Warehouse(t.spark, _folder(t)))


@query("table_store_replace_database", "select c_custkey, upper(c_name) as c_name, c_acctbal from customer")
def _(t):
    return _replaced(t, _databases(t))


def _saved(t, name: str, df: DataFrame, store: src.Warehouse | None = None) -> DataFrame:
    """The results of a table's standard checks, computed while it is written."""
    store = store or src.Warehouse(t.spark, _folder(t))
    store.save("clean", name, df, checks=CHECKS[name]())
    return c.as_frame(t.spark, store.checks("clean", name))


def _counted(**rules: str) -> str:
    return ", ".join(f"count(*) filter ({rule}) as {name}" for name, rule in rules.items())


@query(
    "saved_orders_checks",
    "select count(*) as row_count, "
    + _counted(
        null_order_approved_at="order_approved_at is null",
        null_order_delivered_carrier_date="order_delivered_carrier_date is null",
        null_order_delivered_customer_date="order_delivered_customer_date is null",
        **{f"n_{f}": f for f in ORDER_FLAGS},
        overlap_rows=f"{ORDER_FLAGS[0]} and {ORDER_FLAGS[1]}",
        combined=f"{ORDER_FLAGS[0]} or {ORDER_FLAGS[1]}",
        baseline="order_status = 'delivered' and order_delivered_customer_date is null",
        unstandardized_rows="order_status <> lower(trim(order_status))",
    )
    + " from c_orders",
)
def _(t):
    return _saved(t, "orders", t.clean("orders"))


@query(
    "saved_customers_checks",
    "select count(*) as row_count, "
    + _counted(
        null_customer_id="customer_id is null",
        null_customer_unique_id="customer_unique_id is null",
        n_has_multiple_addresses_on_record="has_multiple_addresses_on_record",
        malformed="length(customer_zip_code_prefix) <> 5 or not regexp_matches(customer_zip_code_prefix, '^[0-9]{5}$')",
    )
    + " from c_customers",
)
def _(t):
    return _saved(t, "customers", t.clean("customers"), _databases(t))


@query(
    "saved_items_checks",
    "select count(*) as row_count, "
    + _counted(
        n_is_zero_freight="is_zero_freight",
        n_is_shipping_date_anomaly="is_shipping_date_anomaly",
        negative_price="price < 0",
        negative_freight_value="freight_value < 0",
        zero_price="price = 0",
    )
    + " from c_order_items",
)
def _(t):
    return _saved(t, "order_items", t.clean("order_items"))


@query(
    "saved_payments_checks",
    "select count(*) as row_count, "
    + _counted(
        n_is_undefined_payment_type="is_undefined_payment_type",
        n_is_zero_payment_value="is_zero_payment_value",
        n_is_zero_installments="is_zero_installments",
        n_has_missing_sequential_start="has_missing_sequential_start",
        unexplained_zero_value_rows="is_zero_payment_value and not is_undefined_payment_type and payment_type <> 'voucher'",
    )
    + " from c_order_payments",
)
def _(t):
    return _saved(t, "order_payments", t.clean("order_payments"))


@query(
    "saved_fact_checks",
    "select count(*) as row_count, "
    + _counted(
        **{f"null_{k}": f"{k} is null" for k in FACT_KEYS},
        null_mismatch="(delivery_estimate_error_days is null) <> (is_delivered_on_time is null)",
        late_but_on_time="delivery_estimate_error_days > 0 and is_delivered_on_time",
        early_but_late="delivery_estimate_error_days < 0 and not is_delivered_on_time",
        unexpected_ratio="price = 0 and freight_to_price_ratio is not null",
        missing_ratio="price <> 0 and freight_to_price_ratio is null",
    )
    + " from fact",
)
def _(t):
    return _saved(t, "fact_order_item_fulfillment", t.fact())


@query(
    "fact_order_item_bucketed",
    "select * replace (round(freight_to_price_ratio, 8) as freight_to_price_ratio) from fact",
)
def _(t):
    """Clean tables stored in buckets of their order, then the star from them."""
    store, buckets = _databases(t), int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    save = star.bucketed_save(store, "clean", buckets)
    clean = {name: save(name, t.clean(name)) for name in CLEANERS}
    fact = star.build_bucketed_star(clean, store, buckets, ITEM_KEY)["fact_order_item_fulfillment"]
    return fact.withColumn("freight_to_price_ratio", F.round("freight_to_price_ratio", 8))


@query(
    "saved_row_parity",
    """select (select count(*) from x_geolocation) as source_rows, (select count(*) from c_geolocation) as target_rows,
    (select count(*) from x_geolocation) - (select count(*) from c_geolocation) as removed""",
)
def _(t):
    store = src.Warehouse(t.spark, _folder(t))
    raw = store.save("raw", "geolocation", t.raw("geolocation"), checks=c.row_count())
    store.save("clean", "geolocation", CLEANERS["geolocation"](raw), checks=CHECKS["geolocation"]())
    return c.parity(t.spark, store.checks("raw", "geolocation"), store.checks("clean", "geolocation"))


@query(
    "saved_domain",
    "select order_status, count(*) as n from x_orders where order_status not in ('delivered', 'shipped', 'canceled') group by 1",
)
def _(t):
    store, allowed = src.Warehouse(t.spark, _folder(t)), ["delivered", "shipped", "canceled"]
    orders = store.save("raw", "orders", t.raw("orders"), checks=c.outside_domain("order_status", allowed))
    return c.domain_listing(orders, "order_status", allowed, store.checks("raw", "orders"))


@query(
    "refused_write",
    "select l_orderkey, l_linenumber, l_quantity from lineitem",
)
def _(t):
    store = src.Warehouse(t.spark, _folder(t))
    wanted = c.counts({"large_quantity": F.col("l_quantity") > 100})
    good = store.save("clean", "items", t.src("lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), checks=wanted, require=["large_quantity"])
    try:
        store.save("clean", "items", good.withColumn("l_quantity", F.col("l_quantity") * 10), checks=wanted, require=["large_quantity"])
    except c.ChecksFailed as e:
        if not e.failed["large_quantity"]:
            raise
        return store.read("clean", "items")
    raise ValueError("a table that fails a required check was made current")


@query(
    "ordered_table_range",
    """select o_orderkey, o_custkey, o_totalprice from orders
    where o_totalprice between 100000 and 120000""",
)
def _(t):
    store = src.Warehouse(t.spark, _folder(t))
    orders = t.src("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    store.save("clean", "orders", orders, order_by=["o_totalprice", "o_orderkey"])
    return store.read_range("clean", "orders", 100000, 120000)


@query(
    "ordered_calendar_range",
    "select date_key, cast(full_date as varchar) as full_date, month_name from dim_date where date_key between 19950301 and 19950430",
)
def _(t):
    store = _databases(t)
    store.save("serving", "dim_date", t.star("dim_date"), order_by="date_key")
    return store.read_range("serving", "dim_date", 19950301, 19950430).select("date_key", "full_date", "month_name")


@query(
    "report_file",
    """select event_type, cast(count(*) as varchar) as n,
    cast(round(count(*) / (select count(*) from events) * 100, 4) as varchar) as pct from events group by event_type""",
)
def _(t):
    path = os.path.join(_folder(t), "report")
    src.write_report(freq_distribution(t.src("events"), "event_type", 4), path)
    return src.read_csv(t.spark, path)
