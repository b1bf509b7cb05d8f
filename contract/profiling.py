"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import five, query
from gleanstar.functions import measures as m
from gleanstar.functions import text as tx
from gleanstar.functions import timeparts as tp
from gleanstar.operators import profile as p
from gleanstar.operators import sketches as sk
from gleanstar.operators.ranking import exact_quantiles, global_row_number
from gleanstar.session import stage

ORDER_TS = (
    "order_purchase_timestamp order_approved_at order_delivered_carrier_date "
    "order_delivered_customer_date order_estimated_delivery_date"
)
Q5 = "[0.0, 0.25, 0.5, 0.75, 1.0]"
UNPACK = "q[1] as q0, q[2] as q1, q[3] as q2, q[4] as q3, q[5] as q4"


@query(
    "table_profile",
    """select count(*) as row_count, count(distinct order_id) as distinct_order_id,
    count(*) filter (customer_id is null) as null_customer_id, count(*) filter (order_status is null) as null_order_status,
    count(*) filter (order_approved_at is null) as null_order_approved_at,
    count(*) filter (order_delivered_carrier_date is null) as null_order_delivered_carrier_date,
    count(*) filter (order_delivered_customer_date is null) as null_order_delivered_customer_date from x_orders""",
)
def _(t):
    return p.table_profile(
        t.raw("orders"),
        keys=["order_id"],
        nulls=["customer_id", "order_status", "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"],
    )


@query(
    "table_profile_several_keys",
    """select count(*) as row_count, count(distinct l_orderkey) as distinct_l_orderkey,
    count(distinct l_partkey) as distinct_l_partkey, count(distinct l_suppkey) as distinct_l_suppkey,
    (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as distinct_l_orderkey_l_linenumber
    from lineitem""",
)
def _(t):
    return p.table_profile(
        t.src("lineitem"), keys=["l_orderkey", "l_partkey", "l_suppkey", ["l_orderkey", "l_linenumber"]]
    )


@query(
    "table_profile_approx",
    """select count(*) as row_count, count(distinct l_orderkey) as distinct_l_orderkey, true as near_l_orderkey,
    count(distinct l_partkey) as distinct_l_partkey, true as near_l_partkey,
    count(distinct l_suppkey) as distinct_l_suppkey, true as near_l_suppkey from lineitem""",
)
def _(t):
    """Estimates lie within three standard errors (0.05 each) of the exact counts."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    near = p.table_profile(t.src("lineitem"), keys=keys, approx=True)
    exact = p.table_profile(t.src("lineitem"), keys=keys)
    near = near.withColumnsRenamed({f"distinct_{k}": f"near_{k}" for k in keys})
    # one row each
    both = exact.join(near, "row_count")
    flags = {f"near_{k}": F.abs(F.col(f"near_{k}") - F.col(f"distinct_{k}")) <= 0.15 * F.col(f"distinct_{k}") for k in keys}
    return both.withColumns(flags)


def _ranks(df, column, quantiles, probs, accuracy):
    """Whether each quantile's rank is as near as the sketch promises."""
    found = df.filter(F.col(column).isNotNull())
    n = found.select(F.count("*")).scalar()
    at = [quantiles[i] for i in range(len(probs))]
    below = [F.count_if(F.col(column) < q) for q in at]
    upto = [F.count_if(F.col(column) <= q) for q in at]
    slack = F.ceil(n / F.lit(accuracy)) + 1
    return found.agg(
        F.count("*").alias("n"),
        *[((b <= F.lit(p) * n + slack) & (u >= F.lit(p) * n - slack)).alias(f"near_{i}") for i, (p, b, u) in enumerate(zip(probs, below, upto))],
    )


@query(
    "numeric_summary_sketch",
    """select count(l_extendedprice) as n, true as near_0, true as near_1, true as near_2, true as near_3, true as near_4
    from lineitem""",
)
def _(t):
    """Ranks of the sketch's quartiles against the exact counts."""
    items = t.src("lineitem")
    found = p.numeric_summary(items, ["l_extendedprice"])
    return _ranks(items, "l_extendedprice", found.select("quartiles").scalar(), [0, 0.25, 0.5, 0.75, 1], 10_000)


def _near(df, column, found, probs):
    """The ranks of quantiles from a stored sketch against the exact counts; the sketch keeps
    its rank error in 99 of 100 cases, so twice that is allowed."""
    return _ranks(df, column, found.select("quantiles").scalar(), probs, int(1 / (2 * sk.rank_error())))


def _kept_sketches(t, df, columns, by=()):
    """A sketch table as the store keeps it."""
    return stage(sk.sketch_table(df, columns, by), "sketches")


@query(
    "numeric_summary_stored",
    """select count(l_extendedprice) as n, true as near_0, true as near_1, true as near_2, true as near_3, true as near_4,
    min(l_extendedprice) as min_val, max(l_extendedprice) as max_val, round(avg(l_extendedprice), 2) as avg_val from lineitem""",
)
def _(t):
    """Quartiles merged from the sketches of each return flag and status."""
    items = t.src("lineitem")
    kept = _kept_sketches(t, items, ["l_extendedprice", "l_quantity"], ["l_returnflag", "l_linestatus"])
    found = sk.numeric_summary(kept).filter("column_name = 'l_extendedprice'").withColumnRenamed("quartiles", "quantiles")
    ranks = _near(items, "l_extendedprice", found, [0, 0.25, 0.5, 0.75, 1])
    return ranks.select("*", *[found.select(c).scalar().alias(c) for c in ("min_val", "max_val", "avg_val")])


@query(
    "numeric_summary_added",
    "select count(l_quantity) as n, true as near_0, true as near_1, true as near_2 from lineitem",
)
def _(t):
    """Sketches of the items of odd orders, with those of even ones added."""
    items = t.src("lineitem")
    halves = [_kept_sketches(t, items.filter(F.col("l_orderkey") % 2 == k), ["l_quantity"]) for k in (1, 0)]
    found = sk.added(*halves).select(sk.quantile([0.1, 0.5, 0.9]).alias("quantiles"))
    return _near(items, "l_quantity", found, [0.1, 0.5, 0.9])


@query(
    "duration_distribution_stored",
    """select count(*) as n, true as near_0, true as near_1, min(d) as min_val, max(d) as max_val
    from (select cast(date_sub('hour', order_approved_at, order_delivered_carrier_date) as double) as d from x_orders) where d is not null""",
)
def _(t):
    """Median and 95th percentile merged from the sketches of each month."""
    hours = tp.elapsed("order_delivered_carrier_date", "order_approved_at", "hour")
    orders = t.raw("orders").select(hours.alias("d"), tp.year_month("order_purchase_timestamp").alias("month"))
    found = sk.duration_distribution(_kept_sketches(t, orders, ["d"], ["month"]))
    ranks = _near(orders, "d", found.select(F.array("p50", "p95").alias("quantiles")), [0.5, 0.95])
    return ranks.select("*", *[found.select(c).scalar().alias(c) for c in ("min_val", "max_val")])


@query(
    "group_median_stored",
    """select p_type, count(p_retailprice) as n, true as near from part where p_size > 10 group by p_type""",
)
def _(t):
    """Medians from the sketches of each type and size against the exact counts."""
    parts = t.src("part").filter(F.col("p_size") > 10)
    kept = _kept_sketches(t, parts, ["p_retailprice"], ["p_type", "p_size"])
    medians = sk.group_median(kept, ["p_type"]).select("p_type", "median")
    per_type = parts.join(medians, "p_type").groupBy("p_type").agg(
        F.count("p_retailprice").alias("n"),
        F.count_if(F.col("p_retailprice") < F.col("median")).alias("_below"),
        F.count_if(F.col("p_retailprice") <= F.col("median")).alias("_upto"),
    )
    slack = F.ceil(F.col("n") * 2 * sk.rank_error()) + 1
    near = (F.col("_below") <= 0.5 * F.col("n") + slack) & (F.col("_upto") >= 0.5 * F.col("n") - slack)
    return per_type.select("p_type", "n", near.alias("near"))


@query(
    "duration_distribution_sketch",
    """select count(*) as n, count(*) > 0 as ordered from x_orders
    where order_approved_at is not null and order_delivered_carrier_date is not null""",
)
def _(t):
    """Ranks of the sketch's median and 95th percentile against the exact counts."""
    start, end = "order_approved_at", "order_delivered_carrier_date"
    out = p.duration_distribution(t.raw("orders"), start, end, "hour")
    durations = t.raw("orders").select(tp.elapsed(end, start, "hour").alias("d"))
    ranks = _ranks(durations, "d", out.select(F.array("p50", "p95")).scalar(), [0.5, 0.95], m.ACCURACY)
    inside = (F.col("min_val") <= F.col("p50")) & (F.col("p50") <= F.col("p95")) & (F.col("p95") <= F.col("max_val"))
    # one row each
    return out.join(ranks, "n").select("n", (inside & F.col("near_0") & F.col("near_1")).alias("ordered"))


@query(
    "null_rates",
    """select round(count(*) filter (order_approved_at is null) / count(*) * 100, 4) as pct_null_order_approved_at,
    round(count(*) filter (order_delivered_carrier_date is null) / count(*) * 100, 4) as pct_null_order_delivered_carrier_date,
    round(count(*) filter (order_delivered_customer_date is null) / count(*) * 100, 4) as pct_null_order_delivered_customer_date
    from x_orders""",
)
def _(t):
    cols = ["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]
    return p.null_rates(t.raw("orders"), cols, 4)


@query(
    "freq_distribution",
    """select order_status, count(*) as n, round(count(*) / (select count(*) from x_orders) * 100, 4) as pct
    from x_orders group by order_status""",
)
def _(t):
    return p.freq_distribution(t.raw("orders"), "order_status", 4)


@query(
    "freq_distribution_two_columns",
    """select o_orderstatus, o_orderpriority, count(*) as n,
    round(count(*) / (select count(*) from orders) * 100, 4) as pct from orders group by all""",
)
def _(t):
    return p.freq_distribution(t.src("orders"), ["o_orderstatus", "o_orderpriority"], 4)


@query("freq_distribution_counts", "select lang, source, count(*) as n from documents group by all")
def _(t):
    return p.freq_distribution(t.src("documents"), ["lang", "source"], share=False)


@query(
    "null_by_group",
    """select order_status, count(*) as n, count(*) filter (order_delivered_customer_date is null) as null_n,
    round(count(*) filter (order_delivered_customer_date is null) / count(*) * 100, 4) as pct_null
    from x_orders group by order_status""",
)
def _(t):
    return p.null_by_group(t.raw("orders"), "order_status", "order_delivered_customer_date", 4)


@query(
    "null_share_by_group",
    """select review_score, count(*) filter (review_comment_message is null) as null_n,
    round(count(*) filter (review_comment_message is null)
      / (select count(*) from x_order_reviews where review_comment_message is null) * 100, 4) as pct_of_nulls
    from x_order_reviews group by review_score""",
)
def _(t):
    return p.null_share_by_group(t.raw("order_reviews"), "review_score", "review_comment_message", 4)


@query(
    "filtered_group_count",
    "select order_status, count(*) as n from x_orders where order_approved_at is null group by order_status",
)
def _(t):
    return p.filtered_group_count(t.raw("orders"), F.col("order_approved_at").isNull(), "order_status")


@query(
    "filtered_group_count_two_columns",
    """select payment_type, payment_installments, count(*) as n from x_order_payments
    where payment_installments = 0 group by all""",
)
def _(t):
    return p.filtered_group_count(
        t.raw("order_payments"), F.col("payment_installments") == 0, ["payment_type", "payment_installments"]
    )


@query(
    "cardinality_ratio",
    """select count(*) as row_count, round(avg(payment_value), 4) as avg_payment_value,
    count(distinct order_id) as distinct_order_id, round(count(*) / count(distinct order_id), 4) as ratio
    from x_order_payments""",
)
def _(t):
    return p.cardinality_ratio(
        t.raw("order_payments"), "order_id", digits=4,
        extra={"avg_payment_value": F.round(F.avg("payment_value"), 4)},
    )


@query(
    "cardinality_ratio_of_distincts",
    """select count(*) as row_count, count(distinct customer_id) as distinct_customer_id,
    count(distinct customer_unique_id) as distinct_customer_unique_id,
    round(count(distinct customer_id) / count(distinct customer_unique_id), 4) as ratio from x_customers""",
)
def _(t):
    return p.cardinality_ratio(t.raw("customers"), "customer_unique_id", "customer_id", 4)


@query(
    "fanout_distribution",
    """select rows_per_key, count(*) as num_keys, round(count(*) / sum(count(*)) over () * 100, 4) as pct
    from (select count(*) as rows_per_key from x_order_items group by order_id) group by rows_per_key""",
)
def _(t):
    return p.fanout_distribution(t.raw("order_items"), "order_id", 4)


@query(
    "fanout_distribution_counts",
    """select rows_per_key, count(*) as num_keys
    from (select count(*) as rows_per_key from x_order_reviews group by order_id) group by rows_per_key""",
)
def _(t):
    return p.fanout_distribution(t.raw("order_reviews"), "order_id", share=False)


@query(
    "numeric_summary",
    f"""select column_name, lo as min_val, hi as max_val, mean as avg_val, {UNPACK} from (
    select 'price' as column_name, min(price) as lo, max(price) as hi, round(avg(price), 4) as mean,
      quantile_disc(price, {Q5}) as q from x_order_items
    union all select 'freight_value', min(freight_value), max(freight_value), round(avg(freight_value), 4),
      quantile_disc(freight_value, {Q5}) from x_order_items)""",
)
def _(t):
    return five(p.numeric_summary(t.raw("order_items"), ["price", "freight_value"], 4, accuracy=None))


@query(
    "numeric_summary_with_rules",
    f"""select 'payment_value' as column_name, lo as min_val, hi as max_val, mean as avg_val, {UNPACK}, negative, zero from (
    select min(payment_value) as lo, max(payment_value) as hi, round(avg(payment_value), 4) as mean,
      quantile_disc(payment_value, {Q5}) as q, count(*) filter (payment_value < 0) as negative,
      count(*) filter (payment_value = 0) as zero from x_order_payments)""",
)
def _(t):
    v = F.col("payment_value")
    out = five(p.numeric_summary(t.raw("order_payments"), ["payment_value"], 4, rules={"negative": v < 0, "zero": v == 0}, accuracy=None))
    return out.select("column_name", "min_val", "max_val", "avg_val", "q0", "q1", "q2", "q3", "q4", "negative", "zero")


@query(
    "numeric_summary_text_length",
    f"""select 'n_chars' as column_name, lo as min_val, hi as max_val, mean as avg_val, {UNPACK} from (
    select cast(min(length(text)) as double) as lo, cast(max(length(text)) as double) as hi,
      round(avg(length(text)), 4) as mean,
      cast(quantile_disc(length(text), {Q5}) as double[]) as q from documents)""",
)
def _(t):
    return five(p.numeric_summary(t.src("documents"), {"n_chars": F.char_length("text")}, 4, accuracy=None))


@query(
    "value_range",
    """select min(order_purchase_timestamp) as min_purchase, max(order_purchase_timestamp) as max_purchase,
    min(length(order_status)) as min_status_length, max(length(order_status)) as max_status_length,
    min(order_status) as min_order_status, max(order_status) as max_order_status,
    count(*) filter (order_purchase_timestamp is null) as null_purchase from x_orders""",
    "min_purchase max_purchase",
)
def _(t):
    ts = F.col("order_purchase_timestamp")
    return p.value_range(
        t.raw("orders"),
        {"purchase": ts, "status_length": F.char_length("order_status"), "order_status": F.col("order_status")},
        extra={"null_purchase": m.null_count(ts)},
    )


@query(
    "value_range_numbers",
    """select min(product_weight_g) as min_product_weight_g, max(product_weight_g) as max_product_weight_g,
    min(product_length_cm) as min_product_length_cm, max(product_length_cm) as max_product_length_cm,
    min(product_photos_qty) as min_product_photos_qty, max(product_photos_qty) as max_product_photos_qty,
    count(*) filter (product_weight_g = 0) as zero_weight from x_products""",
)
def _(t):
    return p.value_range(
        t.raw("products"),
        ["product_weight_g", "product_length_cm", "product_photos_qty"],
        extra={"zero_weight": F.count_if(F.col("product_weight_g") == 0)},
    )


def _duration_sql(start: str, end: str, unit: str) -> str:
    return f"""select count(*) as n, min(d) as min_val, quantile_disc(d, 0.5) as p50, quantile_disc(d, 0.95) as p95,
    max(d) as max_val from (select date_sub('{unit}', {start}, {end}) as d from x_orders
    where {start} is not null and {end} is not null)"""


@query(
    "duration_distribution",
    _duration_sql("order_approved_at", "order_delivered_carrier_date", "hour"),
)
def _(t):
    return p.duration_distribution(t.raw("orders"), "order_approved_at", "order_delivered_carrier_date", "hour", None)


@query(
    "duration_distribution_days",
    _duration_sql("order_delivered_carrier_date", "order_delivered_customer_date", "day"),
)
def _(t):
    return p.duration_distribution(
        t.raw("orders"), "order_delivered_carrier_date", "order_delivered_customer_date", "day", accuracy=None
    )


@query(
    "duration_histogram",
    """select date_sub('hour', order_delivered_carrier_date, order_approved_at) as diff, count(*) as n
    from x_orders where order_delivered_carrier_date < order_approved_at group by 1""",
)
def _(t):
    return p.duration_histogram(
        t.raw("orders"), "order_delivered_carrier_date", "order_approved_at", "hour",
        F.col("order_delivered_carrier_date") < F.col("order_approved_at"),
    )


@query(
    "period_volume",
    "select strftime(order_purchase_timestamp, '%Y-%m') as year_month, count(*) as n from x_orders group by 1",
)
def _(t):
    return p.period_volume(t.raw("orders"), "order_purchase_timestamp")


@query(
    "period_volume_parts",
    """select cast(year(order_purchase_timestamp) as int) as year, cast(month(order_purchase_timestamp) as int) as month,
    count(*) as n from x_orders where order_delivered_customer_date < order_delivered_carrier_date group by 1, 2""",
)
def _(t):
    late = F.col("order_delivered_customer_date") < F.col("order_delivered_carrier_date")
    return p.period_volume(t.raw("orders"), "order_purchase_timestamp", late, by="parts")


@query(
    "parse_audit",
    """select min(try_cast(v as timestamp)) as min_val, max(try_cast(v as timestamp)) as max_val,
    count(*) filter (v is not null and try_cast(v as timestamp) is null) as unparseable
    from (select case when o_orderkey % 89 = 0 then 'n/a' when o_orderkey % 83 = 0 then null
      else cast(cast(o_orderdate as date) as varchar) end as v from orders)""",
    "min_val max_val",
)
def _(t):
    k = F.col("o_orderkey")
    v = F.when(k % 89 == 0, "n/a").when(k % 83 != 0, F.to_date("o_orderdate").cast("string"))
    return p.parse_audit(t.src("orders").select(v.alias("v")), "v")


@query(
    "temporal_order_violations",
    """select count(*) filter (order_approved_at < order_purchase_timestamp) as approved_before_purchase,
    count(*) filter (order_delivered_customer_date < order_purchase_timestamp) as delivered_before_purchase,
    count(*) filter (order_delivered_customer_date < order_delivered_carrier_date) as delivered_before_carrier,
    count(*) filter (order_delivered_carrier_date < order_approved_at) as carrier_before_approved from x_orders""",
)
def _(t):
    return p.temporal_order_violations(
        t.raw("orders"),
        {
            "approved_before_purchase": ("order_purchase_timestamp", "order_approved_at"),
            "delivered_before_purchase": ("order_purchase_timestamp", "order_delivered_customer_date"),
            "delivered_before_carrier": ("order_delivered_carrier_date", "order_delivered_customer_date"),
            "carrier_before_approved": ("order_approved_at", "order_delivered_carrier_date"),
        },
    )


@query(
    "temporal_order_violations_reviews",
    """select count(*) filter (review_answer_timestamp < review_creation_date) as answered_before_created
    from x_order_reviews""",
)
def _(t):
    return p.temporal_order_violations(
        t.raw("order_reviews"), {"answered_before_created": ("review_creation_date", "review_answer_timestamp")}
    )


@query(
    "inspect_rows",
    "select * from x_orders where order_status = 'canceled' and order_delivered_customer_date is not null",
    ORDER_TS,
)
def _(t):
    return p.inspect_rows(
        t.raw("orders"),
        (F.col("order_status") == "canceled") & F.col("order_delivered_customer_date").isNotNull(),
    )


@query(
    "inspect_rows_negative_duration",
    """select order_id, order_status, date_sub('hour', order_approved_at, order_delivered_carrier_date) as hours
    from x_orders where date_sub('hour', order_approved_at, order_delivered_carrier_date) < 0""",
)
def _(t):
    hours = tp.elapsed("order_delivered_carrier_date", "order_approved_at", "hour")
    return p.inspect_rows(t.raw("orders"), hours < 0, ["order_id", "order_status", hours.alias("hours")])


@query(
    "inspect_rows_exact_duration",
    """select order_id, order_status from x_orders
    where date_sub('day', order_delivered_carrier_date, order_delivered_customer_date) = 20""",
)
def _(t):
    days = tp.elapsed("order_delivered_customer_date", "order_delivered_carrier_date", "day")
    return p.inspect_rows(t.raw("orders"), days == 20, ["order_id", "order_status"])


@query("inspect_rows_bad_value", "select * from x_order_payments where payment_value <= 0")
def _(t):
    return p.inspect_rows(t.raw("order_payments"), F.col("payment_value") <= 0)


@query(
    "fd_violations",
    """select seller_zip_code_prefix, count(distinct seller_city) as n_distinct, count(*) as rows from x_sellers
    group by seller_zip_code_prefix having count(distinct seller_city) > 1""",
)
def _(t):
    return p.fd_violations(t.raw("sellers"), "seller_zip_code_prefix", "seller_city")


@query(
    "fd_violations_several",
    """select customer_unique_id, count(distinct customer_city) as n_customer_city,
    count(distinct customer_state) as n_customer_state from x_customers group by customer_unique_id
    having count(distinct customer_city) > 1 or count(distinct customer_state) > 1""",
)
def _(t):
    return p.fd_violations(t.raw("customers"), "customer_unique_id", ["customer_city", "customer_state"])


@query(
    "fd_variants",
    """select geolocation_zip_code_prefix, count(distinct geolocation_city) as n_distinct, count(*) as rows,
    cast(0 as bigint) as page, array_to_string(list_sort(list(distinct geolocation_city)), ',') as variants
    from x_geolocation group by geolocation_zip_code_prefix having count(distinct geolocation_city) > 1""",
)
def _(t):
    return p.fd_variants(t.raw("geolocation"), "geolocation_zip_code_prefix", "geolocation_city")


@query(
    "fd_variants_long_lists",
    """select o_orderstatus, n_distinct, rows, page, string_agg(cast(o_orderkey as varchar), ',' order by o_orderkey) as variants
    from (select o_orderstatus, o_orderkey, count(*) over w as n_distinct, cast(sum(n) over w as bigint) as rows,
        (row_number() over (partition by o_orderstatus order by o_orderkey) - 1) // 1000 as page
        from (select o_orderstatus, o_orderkey, count(*) as n from orders group by all) window w as (partition by o_orderstatus))
    group by o_orderstatus, n_distinct, rows, page""",
)
def _(t):
    """Lists of thousands of values: pages follow each other in the list's order."""
    found = p.fd_variants(t.src("orders"), "o_orderstatus", "o_orderkey")
    return found.withColumn("rows", F.col("rows").cast("bigint"))


@query(
    "fd_variants_by_city",
    """select geolocation_city, count(distinct geolocation_state) as n_distinct, count(*) as rows,
    cast(0 as bigint) as page, array_to_string(list_sort(list(distinct geolocation_state)), ',') as variants
    from x_geolocation group by geolocation_city having count(distinct geolocation_state) > 1""",
)
def _(t):
    return p.fd_variants(t.raw("geolocation"), "geolocation_city", "geolocation_state")


@query(
    "normalization_effect",
    f"""select count(distinct geolocation_city) as original, count(distinct
    translate(lower(trim(geolocation_city)), '{tx.ACCENTED}', '{tx.PLAIN}')) as normalized from x_geolocation""",
)
def _(t):
    return p.normalization_effect(t.raw("geolocation"), "geolocation_city", tx.folded)


@query(
    "normalization_effect_case_only",
    """select count(distinct product_category_name) as original,
    count(distinct lower(trim(product_category_name))) as normalized from x_products""",
)
def _(t):
    return p.normalization_effect(t.raw("products"), "product_category_name", tx.lower_trimmed)


@query(
    "normalization_effect_texts",
    f"""select count(distinct text) as original, count(distinct translate(lower(trim(text,
    chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ')), '{tx.ACCENTED}', '{tx.PLAIN}')) as normalized
    from documents""",
)
def _(t):
    return p.normalization_effect(t.src("documents"), "text", tx.folded)


@query(
    "normalization_variants",
    f"""select translate(lower(trim(geolocation_city)), '{tx.ACCENTED}', '{tx.PLAIN}') as normalized,
    count(distinct geolocation_city) as n_distinct, count(*) as rows, cast(0 as bigint) as page,
    array_to_string(list_sort(list(distinct geolocation_city)), ',') as variants
    from x_geolocation group by 1 having count(distinct geolocation_city) > 1""",
)
def _(t):
    return p.normalization_variants(t.raw("geolocation"), "geolocation_city", tx.folded)


@query(
    "normalization_reduction",
    f"""select count(*) as keys_with_variants, count(*) filter (raw > norm) as reduced from (
    select count(distinct geolocation_city) as raw, count(distinct
      translate(lower(trim(geolocation_city)), '{tx.ACCENTED}', '{tx.PLAIN}')) as norm
    from x_geolocation group by geolocation_zip_code_prefix) where raw > 1""",
)
def _(t):
    return p.normalization_reduction(
        t.raw("geolocation"), "geolocation_zip_code_prefix", "geolocation_city", tx.folded
    )


@query(
    "bounds_check",
    """select min(geolocation_lat) as min_geolocation_lat, max(geolocation_lat) as max_geolocation_lat,
    min(geolocation_lng) as min_geolocation_lng, max(geolocation_lng) as max_geolocation_lng,
    count(*) filter (geolocation_lat not between -34 and 6 or geolocation_lng not between -75 and -33) as out_of_bounds
    from x_geolocation""",
)
def _(t):
    return p.bounds_check(t.raw("geolocation"), {"geolocation_lat": (-34, 6), "geolocation_lng": (-75, -33)})


@query(
    "sequence_gaps",
    """select order_id, count(*) as rows, max(payment_sequential) as max_seq from x_order_payments
    group by order_id having max(payment_sequential) <> count(*)""",
)
def _(t):
    return p.sequence_gaps(t.raw("order_payments"), "order_id", "payment_sequential")


@query(
    "sequence_gaps_single_kind",
    """select order_id, count(*) as rows, max(payment_sequential) as max_seq,
    count(distinct payment_type) as distinct_payment_type from c_order_payments
    group by order_id having max(payment_sequential) <> count(*) and count(distinct payment_type) = 1""",
)
def _(t):
    gaps = p.sequence_gaps(t.kept("order_payments"), "order_id", "payment_sequential", "payment_type")
    return gaps.filter(F.col("distinct_payment_type") == 1)


@query(
    "sequence_gap_lists",
    """select order_id, count(*) as rows, max(payment_sequential) as max_seq, cast(0 as bigint) as page,
    array_to_string(list_sort(list(payment_sequential)), ',') as sequences from x_order_payments
    group by order_id having max(payment_sequential) <> count(*)""",
)
def _(t):
    return p.sequence_gap_lists(t.raw("order_payments"), "order_id", "payment_sequential")


@query("domain_listing", "select distinct lower(trim(seller_city)) as seller_city from x_sellers")
def _(t):
    return p.domain_listing(t.raw("sellers").select(tx.lower_trimmed("seller_city").alias("seller_city")), "seller_city")


@query(
    "domain_listing_filtered",
    "select distinct seller_id from c_order_items where is_shipping_date_anomaly",
)
def _(t):
    return p.domain_listing(t.kept("order_items"), "seller_id", F.col("is_shipping_date_anomaly"))


@query(
    "domain_joined",
    """select cast(0 as bigint) as page, count(distinct customer_state) as total,
    array_to_string(list_sort(list(distinct customer_state)), ',') as "values" from x_customers""",
)
def _(t):
    return p.domain_joined(t.raw("customers"), "customer_state")


@query(
    "top_k_values",
    """select p_brand, count(*) as n from part group by p_brand order by n desc, p_brand limit 10""",
)
def _(t):
    return p.top_k_values(t.src("part"), "p_brand", 10)


@query(
    "semi_lookup",
    """select distinct product_id from x_order_items
    where product_id in (select product_id from x_products where product_category_name is null)""",
)
def _(t):
    nameless = t.raw("products").filter(F.col("product_category_name").isNull())
    sold = t.raw("order_items").select("product_id").distinct()
    return p.semi_lookup(sold, nameless, "product_id")


@query(
    "semi_lookup_period",
    """select i.order_id, i.order_item_id, i.product_id, i.price from c_order_items i where i.order_id in (
    select order_id from c_orders where strftime(order_purchase_timestamp, '%Y-%m') = '1998-10')""",
)
def _(t):
    items = t.kept("order_items").select("order_id", "order_item_id", "product_id", "price")
    month = t.kept("orders").filter(tp.in_month("order_purchase_timestamp", "1998-10"))
    return p.semi_lookup(items, month, "order_id")


@query(
    "repeated_key_rows",
    """select * from x_order_reviews
    where order_id in (select order_id from x_order_reviews group by order_id having count(*) > 1)""",
    "review_creation_date review_answer_timestamp",
)
def _(t):
    return p.repeated_key_rows(t.raw("order_reviews"), "order_id")


@query(
    "join_inspect",
    """select i.order_id, i.order_item_id, i.seller_id, i.shipping_limit_date, o.order_status, o.order_purchase_timestamp
    from x_order_items i join x_orders o on o.order_id = i.order_id
    where i.shipping_limit_date >= timestamp '2001-08-02'""",
    "shipping_limit_date order_purchase_timestamp",
)
def _(t):
    items = t.raw("order_items")
    return p.join_inspect(
        items,
        t.raw("orders"),
        "order_id",
        F.col("shipping_limit_date") >= F.to_timestamp(F.lit("2001-08-02")),
        ["order_id", "order_item_id", "seller_id", "shipping_limit_date", "order_status", "order_purchase_timestamp"],
        [F.desc("shipping_limit_date"), F.col("order_id"), F.col("order_item_id")],
    )


def _summary_sql(source: str, metrics: list[str]) -> str:
    """Sample skewness and excess kurtosis are DuckDB's own; fences from the quartiles."""
    parts = " union all ".join(
        f"""select '{c}' as metric, count(v) as n, avg(v) as mean, quantile_cont(v, 0.5) as median,
        stddev_samp(v) as sd, any_value(q3 - q1) as iqr, skewness(v) as skew, kurtosis(v) as kurtosis,
        any_value(lo) as lower_fence, any_value(hi) as upper_fence,
        count(*) filter (v < lo or v > hi) / count(v) * 100 as pct_outside_fence
        from (select cast({c} as double) as v from {source}),
          (select *, round(q1 - 1.5 * (q3 - q1), 9) as lo, round(q3 + 1.5 * (q3 - q1), 9) as hi
           from (select quantile_cont(cast({c} as double), 0.25) as q1, quantile_cont(cast({c} as double), 0.75) as q3
             from {source}))"""
        for c in metrics
    )
    rounded = ", ".join(
        f"round({c}, 6) as {c}"
        for c in "mean median sd iqr skew kurtosis lower_fence upper_fence pct_outside_fence".split()
    )
    return f"select metric, n, {rounded} from ({parts})"


def _rounded(df):
    return df.select(
        "metric", "n", *[F.round(c, 6).alias(c) for c in df.columns if c not in ("metric", "n")]
    )


@query(
    "distribution_summary",
    _summary_sql(
        """(select round(sum(price), 4) as order_value, round(sum(freight_value), 4) as freight_total,
        any_value(date_sub('day', order_purchase_timestamp, order_delivered_customer_date)) as delivery_days,
        any_value(datediff('day', cast(order_estimated_delivery_date as date), cast(order_delivered_customer_date as date)))
          as delay_days
        from c_order_items join c_orders using (order_id) where order_status = 'delivered'
        and order_delivered_customer_date is not null group by order_id)""",
        ["order_value", "freight_total", "delivery_days", "delay_days"],
    ),
)
def _(t):
    totals = t.kept("order_items").groupBy("order_id").agg(
        F.round(F.sum("price"), 4).alias("order_value"), F.round(F.sum("freight_value"), 4).alias("freight_total")
    )
    done = t.kept("orders").filter(
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNotNull()
    )
    per_order = totals.join(done, "order_id").select(
        "order_value",
        "freight_total",
        tp.elapsed("order_delivered_customer_date", "order_purchase_timestamp", "day").alias("delivery_days"),
        tp.calendar_days("order_delivered_customer_date", "order_estimated_delivery_date").alias("delay_days"),
    )
    names = ["order_value", "freight_total", "delivery_days", "delay_days"]
    return _rounded(p.distribution_summary(per_order, names, digits=6))


@query("distribution_summary_items", _summary_sql("lineitem", ["l_extendedprice", "l_quantity"]))
def _(t):
    return _rounded(
        p.distribution_summary(
            t.src("lineitem").select("l_extendedprice", "l_quantity"), ["l_extendedprice", "l_quantity"], digits=6
        )
    )


@query(
    "exact_quantiles",
    """select 'value' as metric, count(value) as n, p as prob,
    round(quantile_cont(value, p), 6) as value from events, (values (0.05::double), (0.5), (0.95)) v(p) group by p""".replace(
        "quantile_cont(value, p)",
        "case p when 0.05 then quantile_cont(value, 0.05) when 0.5 then quantile_cont(value, 0.5)"
        " else quantile_cont(value, 0.95) end",
    ),
)
def _(t):
    out = exact_quantiles(t.src("events").select("value"), ["value"], [0.05, 0.5, 0.95])
    return out.withColumn("value", F.round("value", 6))


@query(
    "group_median",
    """select p_type, quantile_disc(p_retailprice, 0.5) as median from part where p_size > 10 group by p_type""",
)
def _(t):
    return p.group_median(t.src("part"), "p_type", "p_retailprice", F.col("p_size") > 10)


@query(
    "rule_counts",
    """select count(*) filter (price < 0) as negative_price, count(*) filter (price <= 0) as non_positive_price,
    count(*) filter (freight_value < 0) as negative_freight, count(*) filter (freight_value = 0) as free_shipping
    from x_order_items""",
)
def _(t):
    return p.rule_counts(
        t.raw("order_items"),
        {
            "negative_price": F.col("price") < 0,
            "non_positive_price": F.col("price") <= 0,
            "negative_freight": F.col("freight_value") < 0,
            "free_shipping": F.col("freight_value") == 0,
        },
    )


@query(
    "complete_period_trim",
    """select strftime(order_purchase_timestamp, '%Y-%m') as year_month, count(*) as n from x_orders
    where order_purchase_timestamp >= timestamp '1997-01-01' and order_purchase_timestamp < timestamp '1998-09-01'
    group by 1""",
)
def _(t):
    kept = p.complete_period_trim(t.raw("orders"), "order_purchase_timestamp", "1997-01", "1998-08")
    return p.period_volume(kept, "order_purchase_timestamp")


@query(
    "global_row_number",
    """select row_number() over (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)
    as row_no, l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem""",
)
def _(t):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    items = t.src("lineitem").select(*order)
    return global_row_number(items, order, "row_no").select(
        "row_no", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
