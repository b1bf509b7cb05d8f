"""Validation queries over the stored clean and serving tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import five, query
from gleanstar.functions import text as tx
from gleanstar.operators import audit as a
from gleanstar.operators import serve as g
from gleanstar.operators import validate as v
from gleanstar.session import stage

FACT = "fact_order_item_fulfillment"


@query(
    "row_parity",
    """select (select count(*) from x_geolocation) as source_rows, (select count(*) from c_geolocation) as target_rows,
    (select count(*) from x_geolocation) - (select count(*) from c_geolocation) as removed""",
)
def _(t):
    return v.row_parity(t.raw("geolocation"), t.kept("geolocation"))


@query(
    "row_parity_of_keys",
    """select (select count(distinct customer_unique_id) from c_customers) as source_rows,
    (select count(*) from dim_customer) as target_rows,
    (select count(distinct customer_unique_id) from c_customers) - (select count(*) from dim_customer) as removed""",
)
def _(t):
    return v.row_parity(t.kept("customers"), t.star("dim_customer"), "customer_unique_id")


@query(
    "row_parity_fact",
    """select (select count(*) from c_order_items) as source_rows, (select count(*) from fact) as target_rows,
    (select count(*) from c_order_items) - (select count(*) from fact) as removed""",
)
def _(t):
    return v.row_parity(t.kept("order_items"), t.star(FACT))


@query(
    "pk_unique",
    """select count(*) as total_rows, count(distinct product_key) as distinct_product_key,
    count(distinct product_id) as distinct_product_id from dim_product""",
)
def _(t):
    return v.pk_unique(t.star("dim_product"), "product_key", "product_id")


@query(
    "pk_unique_fact",
    """select count(*) as total_rows, count(distinct order_item_key) as distinct_order_item_key,
    (select count(*) from (select distinct order_id, order_item_id from fact)) as distinct_order_id_order_item_id from fact""",
)
def _(t):
    return v.pk_unique(t.star(FACT), "order_item_key", ["order_id", "order_item_id"])


@query(
    "null_or_duplicate_keys",
    """select count(*) as null_or_duplicate_keys from (select review_id from c_order_reviews group by review_id
    having review_id is null or count(*) > 1)""",
)
def _(t):
    return v.null_or_duplicate_keys(t.kept("order_reviews"), "review_id")


@query(
    "null_profile",
    """select count(*) filter (customer_key is null) as null_customer_key, count(*) filter (seller_key is null) as null_seller_key,
    count(*) filter (product_key is null) as null_product_key, count(*) filter (order_date_key is null) as null_order_date_key,
    count(*) filter (data_quality_key is null) as null_data_quality_key from fact""",
)
def _(t):
    return v.null_profile(
        t.fact_rows(), ["customer_key", "seller_key", "product_key", "order_date_key", "data_quality_key"]
    )


@query(
    "standardized",
    """select count(*) filter (review_comment_title <> trim(review_comment_title)
    or review_comment_message <> trim(review_comment_message)) as unstandardized_rows from x_order_reviews""",
)
def _(t):
    cols = ["review_comment_title", "review_comment_message"]
    return v.standardized(t.raw("order_reviews"), {c: tx.trimmed(c) for c in cols})


@query(
    "standardized_pattern",
    f"select count(*) filter (regexp_matches(text, '[{tx.ACCENTED}]')) as matching_rows from documents",
)
def _(t):
    return v.pattern_rows(t.src("documents"), "text", f"[{tx.ACCENTED}]")


@query(
    "domain",
    "select order_status, count(*) as n from x_orders where order_status not in ('delivered', 'shipped', 'canceled') group by 1",
)
def _(t):
    return v.domain(t.raw("orders"), "order_status", ["delivered", "shipped", "canceled"])


@query(
    "code_format",
    """select count(*) filter (length(code) <> 5 or not regexp_matches(code, '^[0-9]{5}$')) as malformed
    from (select cast(customer_zip_code_prefix as varchar) as code from x_customers)""",
)
def _(t):
    raw = t.raw("customers").select(F.col("customer_zip_code_prefix").cast("string").alias("code"))
    return v.code_format(raw, "code")


@query(
    "flag_counts",
    """select count(*) filter (is_delivered_missing_final_date_only) as n_is_delivered_missing_final_date_only,
    count(*) filter (is_delivered_missing_multiple_dates_anomaly) as n_is_delivered_missing_multiple_dates_anomaly,
    count(*) filter (is_delivered_missing_approval_anomaly) as n_is_delivered_missing_approval_anomaly,
    count(*) filter (is_delivered_missing_carrier_anomaly) as n_is_delivered_missing_carrier_anomaly,
    count(*) filter (is_canceled_with_delivery_date_anomaly) as n_is_canceled_with_delivery_date_anomaly,
    count(*) filter (is_delivery_before_carrier_anomaly) as n_is_delivery_before_carrier_anomaly,
    count(*) filter (is_carrier_before_approval_anomaly) as n_is_carrier_before_approval_anomaly from c_orders""",
)
def _(t):
    return v.flag_counts(
        t.kept("orders"),
        [
            "is_delivered_missing_final_date_only",
            "is_delivered_missing_multiple_dates_anomaly",
            "is_delivered_missing_approval_anomaly",
            "is_delivered_missing_carrier_anomaly",
            "is_canceled_with_delivery_date_anomaly",
            "is_delivery_before_carrier_anomaly",
            "is_carrier_before_approval_anomaly",
        ],
    )


@query(
    "flagged_keys",
    "select count(distinct order_id) filter (has_missing_sequential_start) as flagged_keys from c_order_payments",
)
def _(t):
    return v.flagged_keys(t.kept("order_payments"), "has_missing_sequential_start", "order_id")


@query(
    "flagged_by_group",
    "select seller_city, count(*) as n from c_sellers where has_wrong_attribute_city group by seller_city",
)
def _(t):
    return v.flagged_by_group(t.kept("sellers"), "has_wrong_attribute_city", "seller_city")


@query(
    "mutually_exclusive",
    """select count(*) filter (is_delivered_missing_final_date_only and is_delivered_missing_multiple_dates_anomaly)
    as overlap_rows from c_orders""",
)
def _(t):
    return v.mutually_exclusive(
        t.kept("orders"), "is_delivered_missing_final_date_only", "is_delivered_missing_multiple_dates_anomaly"
    )


@query(
    "reconcile",
    """select count(*) filter (is_delivered_missing_final_date_only or is_delivered_missing_multiple_dates_anomaly)
    as combined, count(*) filter (order_status = 'delivered' and order_delivered_customer_date is null) as baseline
    from c_orders""",
)
def _(t):
    return v.reconcile(
        t.kept("orders"),
        ["is_delivered_missing_final_date_only", "is_delivered_missing_multiple_dates_anomaly"],
        (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNull(),
    )


@query(
    "reconcile_first_category",
    """select (select count(*) from person_orders p where earliest = 1 and not exists
      (from c_order_items i where i.order_id = p.order_id)) as expected_nulls,
    (select count(*) from dim_customer where first_purchase_category is null) as actual_nulls""",
)
def _(t):
    people = g.first_and_latest(g.customer_orders(t.kept("customers"), t.kept("orders")))
    firsts = people.select(F.col("first_order_id").alias("order_id"))
    expected = a.parents_without_children(firsts, t.kept("order_items"), "order_id")
    nulls = v.null_profile(t.star("dim_customer"), ["first_purchase_category"])
    return expected.select(
        F.col("n").alias("expected_nulls"), nulls.scalar().alias("actual_nulls")
    )


@query(
    "unexplained_flagged_rows",
    """select count(*) filter (is_zero_payment_value and not is_undefined_payment_type and payment_type <> 'voucher')
    as unexplained_zero_value_rows from c_order_payments""",
)
def _(t):
    odd = F.col("is_zero_payment_value") & ~F.col("is_undefined_payment_type") & (F.col("payment_type") != "voucher")
    return v.implication(t.kept("order_payments"), {"unexplained_zero_value_rows": odd})


@query(
    "flagged_groups_with_variety",
    """select order_id, count(distinct payment_type) as n_distinct from c_order_payments
    where has_missing_sequential_start group by order_id having count(distinct payment_type) > 1""",
)
def _(t):
    return v.flagged_groups_with_variety(
        t.kept("order_payments"), "has_missing_sequential_start", "order_id", "payment_type"
    )


@query(
    "non_negative",
    """select count(*) filter (price < 0) as negative_price, count(*) filter (freight_value < 0) as negative_freight_value,
    count(*) filter (price = 0) as zero_price from c_order_items""",
)
def _(t):
    return v.non_negative(t.kept("order_items"), ["price", "freight_value"], zero=["price"])


@query(
    "null_equivalence",
    """select count(*) filter ((delivery_estimate_error_days is null) <> (is_delivered_on_time is null)) as null_mismatch
    from fact""",
)
def _(t):
    return v.null_equivalence(t.star(FACT), "delivery_estimate_error_days", "is_delivered_on_time")


@query(
    "implication",
    """select count(*) filter (delivery_estimate_error_days > 0 and is_delivered_on_time) as late_but_on_time,
    count(*) filter (delivery_estimate_error_days < 0 and not is_delivered_on_time) as early_but_late,
    count(*) filter (delivery_estimate_error_days = 0 and not is_delivered_on_time) as same_day_boundary_rows,
    count(*) filter (price = 0 and freight_to_price_ratio is not null) as unexpected_ratio,
    count(*) filter (price <> 0 and freight_to_price_ratio is null) as missing_ratio from fact""",
)
def _(t):
    days, on_time = F.col("delivery_estimate_error_days"), F.col("is_delivered_on_time")
    price, ratio = F.col("price"), F.col("freight_to_price_ratio")
    return v.implication(
        t.star(FACT),
        {
            "late_but_on_time": (days > 0) & on_time,
            "early_but_late": (days < 0) & ~on_time,
            "same_day_boundary_rows": (days == 0) & ~on_time,
            "unexpected_ratio": (price == 0) & ratio.isNotNull(),
            "missing_ratio": (price != 0) & ratio.isNull(),
        },
    )


@query(
    "forbidden_in_lookup",
    """select count(*) filter (is_delivered_on_time = false and order_id in
      (select order_id from c_orders where order_delivered_carrier_date is null)) as forbidden_rows from fact""",
)
def _(t):
    no_carrier = t.kept("orders").filter(F.col("order_delivered_carrier_date").isNull())
    return v.forbidden_in_lookup(t.fact_rows(), ~F.col("is_delivered_on_time"), no_carrier, "order_id")


@query(
    "denormalized_consistency",
    """select count(*) as inconsistent_keys from (select order_id from c_order_items group by order_id
    having count(distinct shipping_limit_date) > 1)""",
)
def _(t):
    return v.denormalized_consistency(t.kept("order_items"), "order_id", "shipping_limit_date")


@query(
    "denormalized_consistency_fact",
    """select count(*) as inconsistent_keys from (select order_id from fact group by order_id
    having count(distinct delivery_estimate_error_days) > 1)""",
)
def _(t):
    return v.denormalized_consistency(t.star(FACT), "order_id", "delivery_estimate_error_days")


@query(
    "dimension_coverage",
    """select count(*) as unmatched_rows from c_order_items
    where product_id is not null and product_id not in (select product_id from dim_product)""",
)
def _(t):
    return v.dimension_coverage(t.kept("order_items"), t.star("dim_product"), "product_id")


@query(
    "dimension_coverage_fact_keys",
    """select (select count(*) from fact where customer_key is not null
      and customer_key not in (select customer_key from dim_customer)) as customer,
    (select count(*) from fact where seller_key is not null and seller_key not in (select seller_key from dim_seller)) as seller,
    (select count(*) from fact where product_key is not null
      and product_key not in (select product_key from dim_product)) as product,
    (select count(*) from fact where order_date_key is not null
      and order_date_key not in (select date_key from dim_date)) as date,
    (select count(*) from fact where data_quality_key is not null
      and data_quality_key not in (select data_quality_key from data_quality_flags)) as quality""",
)
def _(t):
    checks = {
        "customer": ("dim_customer", "customer_key", "customer_key"),
        "seller": ("dim_seller", "seller_key", "seller_key"),
        "product": ("dim_product", "product_key", "product_key"),
        "date": ("dim_date", "order_date_key", "date_key"),
        "quality": ("data_quality_flags", "data_quality_key", "data_quality_key"),
    }
    # Five passes, so the keys are stored: no other column is.
    fact = stage(t.fact_rows().select([k for _, k, _ in checks.values()]), "fact_keys")
    counts = {n: v.dimension_coverage(fact, t.star(d), k, dk, n) for n, (d, k, dk) in checks.items()}
    first, *rest = counts
    return counts[first].select("*", *[counts[n].scalar().alias(n) for n in rest])


@query(
    "dimension_coverage_dates",
    """select count(*) as unmatched_rows from c_orders where order_delivered_customer_date is not null
    and cast(order_delivered_customer_date as date) not in (select full_date from dim_date)""",
)
def _(t):
    days = t.kept("orders").select(F.to_date("order_delivered_customer_date").alias("full_date"))
    return v.dimension_coverage(days, t.star("dim_date"), "full_date")


@query(
    "unmatched_combinations",
    f"""select count(*) as unmatched_rows from item_flags
    where not coalesce({' and '.join(f'{f} is not null' for f in g.QUALITY_FLAGS)}, false)""",
)
def _(t):
    return v.unmatched_combinations(
        _item_flags(t), t.star("data_quality_flags"), g.QUALITY_FLAGS
    )


def _item_flags(t):
    items = t.kept("order_items").select(
        "order_id", F.col("is_shipping_date_anomaly").alias("is_shipping_anomaly")
    )
    return items.join(t.kept("orders").select("order_id", *g.ORDER_FLAGS), "order_id")


@query(
    "duplicate_combinations",
    """select customer_unique_id, customer_state, count(*) as n from c_customers group by all having count(*) > 1""",
)
def _(t):
    return a.duplicate_combinations(t.kept("customers"), ["customer_unique_id", "customer_state"])


@query(
    "duplicate_combinations_flags",
    f"""select {', '.join(g.QUALITY_FLAGS)}, count(*) as n from data_quality_flags group by all having count(*) > 1""",
)
def _(t):
    return a.duplicate_combinations(t.star("data_quality_flags"), g.QUALITY_FLAGS)


@query(
    "schema_excludes",
    """select 'review_score' as column_name, count(review_score) as filled_rows from fact
    union all select 'has_review', count(has_review) from fact""",
)
def _(t):
    return v.schema_excludes(t.fact_rows(), "%review%")


@query(
    "calendar_complete",
    """select count(*) as actual_rows, datediff('day', min(full_date), max(full_date)) + 1 as expected_rows,
    count(*) filter (year <> year(full_date)) as inconsistent_rows,
    count(*) filter (is_weekend <> (day_of_week in (1, 7))) as inconsistent_weekend from dim_date""",
)
def _(t):
    return v.calendar_complete(t.star("dim_date"))


@query(
    "calendar_bounds",
    """select (select min(full_date) from dim_date) as dim_min,
    (select cast(min(order_purchase_timestamp) as date) from c_orders) as source_min,
    (select max(full_date) from dim_date) as dim_max,
    (select cast(max(order_estimated_delivery_date) as date) from c_orders) as source_max""",
    "dim_min source_min dim_max source_max",
)
def _(t):
    return v.calendar_bounds(t.star("dim_date"), t.kept("orders"))


@query("tier_sizes", "select seller_volume_tier, count(*) as n from dim_seller group by 1")
def _(t):
    return v.tier_sizes(t.star("dim_seller"), "seller_volume_tier")


@query("tenure_sizes", "select seller_tenure_bucket, count(*) as n from dim_seller group by 1")
def _(t):
    return v.tier_sizes(t.star("dim_seller"), "seller_tenure_bucket")


@query(
    "tier_monotonic",
    """select seller_volume_tier, min(order_count) as min_val, max(order_count) as max_val,
    round(avg(order_count), 4) as avg_val from dim_seller join seller_volume using (seller_id) group by 1""",
)
def _(t):
    volume = g.seller_activity(t.kept("order_items"), t.kept("orders"))
    return v.tier_monotonic(t.star("dim_seller"), volume, "seller_id", "seller_volume_tier", "order_count")


@query(
    "fallback_fired",
    """select category_name, count(*) as n from dim_product
    where category_name_english = category_name and category_name <> 'unknown' group by 1""",
)
def _(t):
    return v.fallback_fired(t.star("dim_product"), "category_name", "category_name_english")


@query(
    "placeholder_fallback",
    """select count(*) as placeholder_rows, count(*) filter (category_name_english = 'unknown') as correctly_resolved
    from dim_product where category_name = 'unknown'""",
)
def _(t):
    return v.placeholder_fallback(t.star("dim_product"), "category_name", "category_name_english")


@query(
    "translated_sample",
    """select distinct category_name, category_name_english from dim_product
    where category_name <> category_name_english order by 1, 2 limit 10""",
)
def _(t):
    return v.translated_sample(t.star("dim_product"), "category_name", "category_name_english", 10)


@query(
    "rollup_equals_or",
    f"""select count(*) filter (has_fulfillment_anomaly <> ({' or '.join(g.QUALITY_FLAGS)})) as inconsistent_rows
    from fact join data_quality_flags using (data_quality_key)""",
)
def _(t):
    return v.rollup_equals_or(
        t.star(FACT), t.star("data_quality_flags"), "data_quality_key", "has_fulfillment_anomaly", g.QUALITY_FLAGS
    )


@query(
    "resolution_spot_check",
    """select f.order_id, f.order_item_key, f.review_score as chosen_score, r.review_score as candidate_score, r.review_id
    from fact f join c_order_reviews r on r.order_id = f.order_id
    where f.order_id in (select order_id from c_order_reviews group by order_id having count(*) > 1)
    order by f.order_id, f.order_item_key, r.review_id limit 20""",
)
def _(t):
    chosen = t.star(FACT).select("order_id", "order_item_key", F.col("review_score").alias("chosen_score"))
    candidates = t.kept("order_reviews").select(
        "order_id", "review_id", F.col("review_score").alias("candidate_score")
    )
    return v.resolution_spot_check(
        chosen,
        candidates,
        "order_id",
        ["order_id", "order_item_key", "chosen_score", "candidate_score", "review_id"],
        [F.col("order_item_key")],
        [F.col("review_id")],
        20,
    )


@query(
    "grain_null_reconcile",
    """select (select count(*) from c_orders where order_delivered_customer_date is null) as parent_nulls,
    (select count(*) from fact where is_delivered_on_time is null) as child_nulls,
    (select count(*) from fact f join c_orders o on o.order_id = f.order_id
      where o.order_delivered_customer_date is null and f.is_delivered_on_time is not null) as mismatched_rows""",
)
def _(t):
    return v.grain_null_reconcile(
        t.kept("orders"), t.fact_rows(), "order_id", "order_delivered_customer_date", "is_delivered_on_time"
    )


@query(
    "distribution_sanity",
    """select nulls, min_val, max_val, q[1] as q0, q[2] as q1, q[3] as q2, q[4] as q3, q[5] as q4 from (
    select count(*) filter (delivery_estimate_error_days is null) as nulls, min(delivery_estimate_error_days) as min_val,
    max(delivery_estimate_error_days) as max_val,
    cast(quantile_disc(delivery_estimate_error_days, [0.0, 0.25, 0.5, 0.75, 1.0]) as double[]) as q from fact)""",
)
def _(t):
    return five(v.distribution_sanity(t.star(FACT), "delivery_estimate_error_days"))


@query(
    "first_category_discrepancies",
    """with expected as (select customer_unique_id from person_orders p where earliest = 1 and not exists
      (from c_order_items i where i.order_id = p.order_id)),
    actual as (select customer_unique_id from dim_customer where first_purchase_category is null)
    select 'expected_but_not_actual' as discrepancy_type, customer_unique_id
    from expected where customer_unique_id not in (select customer_unique_id from actual)
    union all select 'actual_but_not_expected', customer_unique_id
    from actual where customer_unique_id not in (select customer_unique_id from expected)""",
)
def _(t):
    people = g.first_and_latest(g.customer_orders(t.kept("customers"), t.kept("orders")))
    firsts = people.select("customer_unique_id", F.col("first_order_id").alias("order_id"))
    expected = a.childless_rows(firsts, t.kept("order_items"), "order_id")
    actual = t.star("dim_customer").filter(F.col("first_purchase_category").isNull())
    return a.symmetric_discrepancy(expected, actual, "customer_unique_id")
