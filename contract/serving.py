"""Star schema queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import query
from gleanstar.functions import timeparts as tp
from gleanstar.operators import serve as g
from gleanstar.operators.ranking import global_row_number, ntile_tier, pick_one_per_key
from gleanstar.plans.star import fulfilment_summary

FLAG_LIST = ", ".join(g.QUALITY_FLAGS)


@query("dim_date", "select * from dim_date", "full_date")
def _(t):
    return g.dim_date(t.kept("orders"))


@query("dim_product", "select * from dim_product")
def _(t):
    return g.dim_product(t.kept("products"), t.kept("category_translation"))


@query("dim_seller", "select * from dim_seller")
def _(t):
    return g.dim_seller(t.kept("sellers"), t.kept("order_items"), t.kept("orders"))


@query("dim_customer", "select * from dim_customer")
def _(t):
    return g.dim_customer(t.kept("customers"), t.kept("orders"), t.kept("order_items"), t.kept("products"))


@query("data_quality_flags", "select * from data_quality_flags")
def _(t):
    return g.data_quality_flags(t.kept("order_items"), t.kept("orders"))


@query(
    "fact_order_item",
    "select * replace (round(freight_to_price_ratio, 8) as freight_to_price_ratio) from fact",
)
def _(t):
    return t.fact().withColumn("freight_to_price_ratio", F.round("freight_to_price_ratio", 8))


@query(
    "global_row_number_text_key",
    """select row_number() over (order by c_name) as row_no, c_name, c_custkey from customer""",
)
def _(t):
    return global_row_number(t.src("customer").select("c_name", "c_custkey"), "c_name", "row_no")


@query(
    "pick_one_per_key",
    """select l_suppkey, l_orderkey, l_linenumber, l_extendedprice from lineitem
    qualify row_number() over (partition by l_suppkey
      order by l_extendedprice desc, l_orderkey, l_linenumber, l_partkey) = 1""",
)
def _(t):
    return pick_one_per_key(
        t.src("lineitem"),
        "l_suppkey",
        [F.desc("l_extendedprice"), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")],
        ["l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"],
    )


@query(
    "first_and_latest",
    """select l.customer_unique_id, l.customer_state, l.customer_city, l.customer_zip_code_prefix,
    e.order_id as first_order_id from person_orders l join person_orders e
    on l.customer_unique_id = e.customer_unique_id and l.latest = 1 and e.earliest = 1""",
)
def _(t):
    return g.first_and_latest(g.customer_orders(t.kept("customers"), t.kept("orders")))


@query(
    "ntile_tier",
    "select l_partkey, n, cast(ntile(7) over (order by n, l_partkey) as int) as tier"
    " from (select l_partkey, count(*) as n from lineitem group by l_partkey)",
)
def _(t):
    volume = t.src("lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return ntile_tier(volume, ["n", "l_partkey"], 7, "tier")


@query(
    "tenure_bucket",
    """select seller_id, order_count, first_ts as first_order_ts,
    case when datediff('day', cast(first_ts as date),
      (select cast(max(order_purchase_timestamp) as date) from c_orders)) <= 2300 then 'new' else 'established' end as bucket
    from seller_volume""",
    "first_order_ts",
)
def _(t):
    latest = t.kept("orders").select(F.max("order_purchase_timestamp")).scalar()
    activity = g.seller_activity(t.kept("order_items"), t.kept("orders"))
    return activity.select(
        "seller_id", "order_count", "first_order_ts",
        g.tenure_bucket(F.col("first_order_ts"), latest, 2300).alias("bucket"),
    )


@query(
    "order_measures",
    f"""select order_id, order_status, cast(order_purchase_timestamp as date) as full_date,
    date_sub('hour', order_approved_at, order_delivered_carrier_date) as approval_to_carrier_hours,
    date_sub('day', order_delivered_carrier_date, order_delivered_customer_date) as carrier_to_customer_days,
    order_delivered_customer_date <= order_estimated_delivery_date as is_delivered_on_time,
    cast(datediff('day', cast(order_estimated_delivery_date as date), cast(order_delivered_customer_date as date)) as int)
      as delivery_estimate_error_days,
    {' or '.join(g.ORDER_FLAGS)} as has_order_level_anomaly from c_orders""",
    "full_date",
)
def _(t):
    return g.order_measures(t.kept("orders")).drop("customer_id", *g.ORDER_FLAGS)


@query("latest_reviews", "select * from latest_review")
def _(t):
    return g.latest_reviews(t.kept("order_reviews"))


@query(
    "junk_key_lookup",
    """select i.order_id, i.order_item_id, data_quality_key from item_flags i
    left join data_quality_flags q on (q.is_delivery_before_carrier_anomaly, q.is_delivered_missing_approval_anomaly,
      q.is_delivered_missing_multiple_dates_anomaly, q.is_carrier_before_approval_anomaly,
      q.is_canceled_with_delivery_date_anomaly) = (i.is_delivery_before_carrier_anomaly,
      i.is_delivered_missing_approval_anomaly, i.is_delivered_missing_multiple_dates_anomaly,
      i.is_carrier_before_approval_anomaly, i.is_canceled_with_delivery_date_anomaly)
      and q.is_shipping_anomaly = i.is_shipping_anomaly
      and not (i.is_delivered_missing_approval_anomaly is null or i.is_delivered_missing_multiple_dates_anomaly is null
        or i.is_canceled_with_delivery_date_anomaly is null)""",
)
def _(t):
    items = t.kept("order_items").select(
        "order_id", "order_item_id", F.col("is_shipping_date_anomaly").alias("is_shipping_anomaly")
    )
    flagged = items.join(t.kept("orders").select("order_id", *g.ORDER_FLAGS), "order_id")
    return g.junk_key_lookup(flagged, t.star("data_quality_flags")).select(
        "order_id", "order_item_id", "data_quality_key"
    )


@query(
    "junk_key_lookup_null_safe",
    " ".join(
        [
            "select i.order_id, i.order_item_id, data_quality_key from item_flags i left join data_quality_flags q on",
            " and ".join(f"q.{f} is not distinct from i.{f}" for f in g.QUALITY_FLAGS),
        ]
    ),
)
def _(t):
    items = t.kept("order_items").select(
        "order_id", "order_item_id", F.col("is_shipping_date_anomaly").alias("is_shipping_anomaly")
    )
    flagged = items.join(t.kept("orders").select("order_id", *g.ORDER_FLAGS), "order_id")
    return g.junk_key_lookup(flagged, t.star("data_quality_flags"), null_safe=True).select(
        "order_id", "order_item_id", "data_quality_key"
    )


@query("two_hop_key", "select customer_id, customer_key from c_customers join dim_customer using (customer_unique_id)")
def _(t):
    return g.two_hop_key(t.kept("customers"), t.star("dim_customer"))


@query(
    "safe_ratio",
    """select order_id, order_item_id, price, round(freight_value / nullif(price, 0), 8) as ratio from x_order_items""",
)
def _(t):
    return t.raw("order_items").select(
        "order_id", "order_item_id", "price", F.round(g.safe_ratio("freight_value", "price"), 8).alias("ratio")
    )


@query(
    "zip_centroid",
    """select geolocation_zip_code_prefix, round(avg(geolocation_lat), 6) as lat, round(avg(geolocation_lng), 6) as lng,
    count(*) as points from c_geolocation group by geolocation_zip_code_prefix""",
)
def _(t):
    return g.zip_centroid(t.kept("geolocation"), 6)


@query(
    "payment_rollup",
    """select order_id, round(sum(payment_value), 2) as total_paid, count(*) as payment_rows
    from c_order_payments group by order_id""",
)
def _(t):
    return g.payment_rollup(t.kept("order_payments"))


@query(
    "date_spine",
    """select cast(unnest(generate_series(cast(min(o_orderdate) as date), cast(max(o_orderdate) as date),
    interval 1 day)) as date) as full_date from orders""",
    "full_date",
)
def _(t):
    bounds = t.src("orders").agg(F.to_date(F.min("o_orderdate")).alias("lo"), F.to_date(F.max("o_orderdate")).alias("hi"))
    return g.date_spine(bounds, "lo", "hi")


@query(
    "calendar_attributes",
    """select date_key, month_name, week_of_year, day_of_week, day_name, is_weekend, count(*) as orders
    from dim_date join orders on full_date = cast(o_orderdate as date) group by all""",
)
def _(t):
    names = ["date_key", "month_name", "week_of_year", "day_of_week", "day_name", "is_weekend"]
    days = t.src("orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count(F.lit(1)).alias("orders"))
    columns = tp.calendar_columns("d")
    return days.select(*[columns[n].alias(n) for n in names], "orders")


@query(
    "fulfilment_summary",
    f"""select data_quality_key, count(*) as items, count(*) filter (is_delivered_on_time) as on_time,
    count(*) filter (not is_delivered_on_time) as late, count(*) filter (has_fulfillment_anomaly) as anomalies,
    round(sum(price), 2) as total_price, {', '.join(f'any_value({f}) as {f}' for f in g.QUALITY_FLAGS)},
    round(count(*) filter (is_delivered_on_time) / nullif(count(is_delivered_on_time), 0) * 100, 2) as on_time_pct
    from fact left join data_quality_flags using (data_quality_key) group by data_quality_key""",
)
def _(t):
    return fulfilment_summary(t.star("fact_order_item_fulfillment"), t.star("data_quality_flags"))
