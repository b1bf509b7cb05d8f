"""Integrity audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.registry import query
from gleanstar.operators import audit as a
from gleanstar.operators import register as g
from gleanstar.operators.joins import full_outer, lookup_join


def issues():
    return {
        "orphan_items_no_order": g.Relation("order_items", "orders", "order_id"),
        "orphan_payments_no_order": g.Relation("order_payments", "orders", "order_id"),
        "orphan_reviews_no_order": g.Relation("order_reviews", "orders", "order_id"),
        "delivered_before_purchase": g.Rule("orders", F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")),
        "non_positive_price": g.Rule("order_items", F.col("price") <= 0),
        "invalid_review_score": g.Rule("order_reviews", ~F.col("review_score").between(1, 5)),
        "duplicate_order_ids": g.Duplicates("orders", "order_id"),
        "categories_missing_translation": g.Relation("products", "category_translation", "product_category_name", "string_field_0"),
    }


REGISTERED = ("orders", "order_items", "order_payments", "order_reviews", "products", "category_translation")
# child, parent, key, parent's key
RELATIONS = {
    "items_orders": ("order_items", "orders", "order_id", "order_id"),
    "payments_orders": ("order_payments", "orders", "order_id", "order_id"),
    "reviews_orders": ("order_reviews", "orders", "order_id", "order_id"),
    "orders_customers": ("orders", "customers", "customer_id", "customer_id"),
    "items_products": ("order_items", "products", "product_id", "product_id"),
    "items_sellers": ("order_items", "sellers", "seller_id", "seller_id"),
    "products_categories": ("products", "category_translation", "product_category_name", "string_field_0"),
}


@query(
    "orphan_count",
    """select count(*) as orphans from x_order_items i
    where not exists (from x_orders o where o.order_id = i.order_id)""",
)
def _(t):
    return a.orphan_count(t.raw("order_items"), t.raw("orders"), "order_id")


@query(
    "orphan_counts_per_relation",
    """select
    (select count(*) from x_order_payments p anti join x_orders using (order_id)) as payments_without_order,
    (select count(*) from x_order_reviews r anti join x_orders using (order_id)) as reviews_without_order,
    (select count(*) from x_orders o anti join x_customers using (customer_id)) as orders_without_customer,
    (select count(*) from x_order_items i anti join x_products using (product_id)) as items_without_product,
    (select count(*) from x_order_items i anti join x_sellers using (seller_id)) as items_without_seller""",
)
def _(t):
    relations = {
        "payments_without_order": g.Relation("order_payments", "orders", "order_id"),
        "reviews_without_order": g.Relation("order_reviews", "orders", "order_id"),
        "orders_without_customer": g.Relation("orders", "customers", "customer_id"),
        "items_without_product": g.Relation("order_items", "products", "product_id"),
        "items_without_seller": g.Relation("order_items", "sellers", "seller_id"),
    }
    names = ("order_payments", "order_reviews", "orders", "customers", "order_items", "products", "sellers")
    return g.evidence_columns(g.integrity_register({n: t.raw(n) for n in names}, relations), list(relations))


@query(
    "parents_without_children",
    "select count(*) as n from x_orders anti join x_order_items using (order_id)",
)
def _(t):
    return a.parents_without_children(t.raw("orders"), t.raw("order_items"), "order_id")


@query(
    "parents_without_children_pct",
    """select count(*) as n, round(count(*) / (select count(*) from x_orders) * 100, 4) as pct
    from x_orders anti join x_order_reviews using (order_id)""",
)
def _(t):
    return a.parents_without_children(t.raw("orders"), t.raw("order_reviews"), "order_id", pct=True, digits=4)


@query(
    "parents_without_children_by_group",
    """select order_status, count(*) as n, round(count(*) / sum(count(*)) over () * 100, 4) as pct
    from x_orders anti join x_order_items using (order_id) group by order_status""",
)
def _(t):
    return a.parents_without_children(
        t.raw("orders"), t.raw("order_items"), "order_id", group="order_status", pct=True, digits=4
    )


@query(
    "childless_rows",
    """select order_id, order_status, order_purchase_timestamp from x_orders anti join x_order_payments using (order_id)
    where order_status in ('canceled', 'delivered')""",
    "order_purchase_timestamp",
)
def _(t):
    return a.childless_rows(
        t.raw("orders"),
        t.raw("order_payments"),
        "order_id",
        F.col("order_status").isin("canceled", "delivered"),
        ["order_id", "order_status", "order_purchase_timestamp"],
    )


@query(
    "coverage_gap",
    """select count(distinct customer_zip_code_prefix) as missing_keys, count(*) as affected_rows from x_customers
    where customer_zip_code_prefix not in (select geolocation_zip_code_prefix from x_geolocation)""",
)
def _(t):
    return a.coverage_gap(
        t.raw("customers"), t.raw("geolocation"), "customer_zip_code_prefix", "geolocation_zip_code_prefix"
    )


@query(
    "coverage_gap_by_group",
    """select seller_state, count(distinct seller_zip_code_prefix) as missing_keys, count(*) as affected_rows
    from x_sellers where seller_zip_code_prefix not in (select geolocation_zip_code_prefix from x_geolocation)
    group by seller_state""",
)
def _(t):
    return a.coverage_gap(
        t.raw("sellers"), t.raw("geolocation"), "seller_zip_code_prefix", "geolocation_zip_code_prefix", "seller_state"
    )


@query(
    "coverage_gap_of_present_keys",
    """select count(distinct product_category_name) as missing_keys, count(*) as affected_rows from c_products
    where product_category_name <> 'unknown'
    and product_category_name not in (select category_name_portuguese from c_category_translation)""",
)
def _(t):
    return a.coverage_gap(
        t.kept("products"),
        t.kept("category_translation"),
        "product_category_name",
        "category_name_portuguese",
        predicate=F.col("product_category_name") != "unknown",
    )


@query(
    "missing_keys",
    """select distinct product_category_name from x_products where product_category_name is not null
    and product_category_name not in (select string_field_0 from x_category_translation)""",
)
def _(t):
    return a.missing_keys(
        t.raw("products"),
        t.raw("category_translation"),
        "product_category_name",
        "string_field_0",
        F.col("product_category_name").isNotNull(),
    )


@query(
    "unused_reference",
    """select * from x_category_translation
    where string_field_0 not in (select product_category_name from x_products where product_category_name is not null)""",
)
def _(t):
    return a.unused_reference(
        t.raw("category_translation"), t.raw("products"), "string_field_0", "product_category_name"
    )


@query(
    "not_in_null_aware",
    """select order_id, order_status from x_orders where order_id not in (select order_id from x_order_payments)""",
)
def _(t):
    return a.not_in_null_aware(t.raw("orders").select("order_id", "order_status"), t.raw("order_payments"), "order_id")


@query(
    "not_in_null_aware_null_in_list",
    """select string_field_0, string_field_1 from x_category_translation
    where string_field_0 not in (select product_category_name from x_products)""",
)
def _(t):
    return a.not_in_null_aware(
        t.raw("category_translation"), t.raw("products"), "string_field_0", "product_category_name"
    )


@query(
    "duplicate_keys",
    """select count(*) as total_rows, count(distinct review_id) as distinct_keys,
    count(*) - count(distinct review_id) as duplicates from x_order_reviews""",
)
def _(t):
    return a.duplicate_keys(t.raw("order_reviews"), "review_id")


@query(
    "duplicate_keys_composite",
    """select count(*) as total_rows,
    count(distinct case when order_id is not null and order_item_id is not null then (order_id, order_item_id) end)
      as distinct_keys,
    count(*) - count(distinct case when order_id is not null and order_item_id is not null
      then (order_id, order_item_id) end) as duplicates from x_order_items""",
)
def _(t):
    return a.duplicate_keys(t.raw("order_items"), ["order_id", "order_item_id"])


@query(
    "duplicate_rows",
    """select count(*) as duplicate_groups from (select 1 from lineitem
    group by l_orderkey, l_linenumber, l_returnflag having count(*) > 1)""",
)
def _(t):
    return a.duplicate_rows(t.src("lineitem"), ["l_orderkey", "l_linenumber", "l_returnflag"])


@query(
    "future_dated",
    """select count(*) filter (o_orderdate > timestamp '2000-01-01') as future_dated from orders""",
)
def _(t):
    return a.future_dated(t.src("orders"), "o_orderdate", F.to_timestamp(F.lit("2000-01-01")))


@query(
    "future_dated_inside",
    "select count(*) filter (o_orderdate > timestamp '1995-06-01') as future_dated from orders",
)
def _(t):
    return a.future_dated(t.src("orders"), "o_orderdate", F.to_timestamp(F.lit("1995-06-01")))


@query("future_dated_now", "select count(*) filter (o_orderdate > now()::timestamp) as future_dated from orders")
def _(t):
    return a.future_dated(t.src("orders"), "o_orderdate")


@query(
    "range_rule",
    "select count(*) filter (review_score not between 1 and 5) as invalid_score from x_order_reviews",
)
def _(t):
    return a.range_rule(t.raw("order_reviews"), "review_score", 1, 5, "invalid_score")


@query(
    "issue_register",
    """select 'orphan_items_no_order' as issue, count(*) as evidence_count from x_order_items anti join x_orders using (order_id)
    union all select 'orphan_payments_no_order', count(*) from x_order_payments anti join x_orders using (order_id)
    union all select 'orphan_reviews_no_order', count(*) from x_order_reviews anti join x_orders using (order_id)
    union all select 'delivered_before_purchase',
      count(*) filter (order_delivered_customer_date < order_purchase_timestamp) from x_orders
    union all select 'non_positive_price', count(*) filter (price <= 0) from x_order_items
    union all select 'invalid_review_score', count(*) filter (review_score not between 1 and 5) from x_order_reviews
    union all select 'duplicate_order_ids', count(*) - count(distinct order_id) from x_orders
    union all select 'categories_missing_translation', count(distinct product_category_name) from x_products
      where product_category_name not in (select string_field_0 from x_category_translation)""",
)
def _(t):
    return g.evidence_lines(
        g.integrity_register({n: t.raw(n) for n in REGISTERED}, issues()),
        {"categories_missing_translation": F.col("orphan_keys")},
    )


_SIDES = [(n, c, p, k, q) for n, (c, p, k, q) in RELATIONS.items()]


@query(
    "integrity_register",
    " union all ".join(
        f"""select '{name}' as issue, (select count({key}) from x_{child}) as child_rows, (select count(*) from x_{child} where {key} is null) as null_keys,
        (select count(distinct {key}) from x_{child}) as keys,
        (select count(*) from x_{child} where {key} is not null and {key} not in (select {parent_key} from x_{parent} where {parent_key} is not null)) as orphan_rows,
        (select count(distinct {key}) from x_{child} where {key} not in (select {parent_key} from x_{parent} where {parent_key} is not null)) as orphan_keys,
        (select count({parent_key}) from x_{parent}) as parents,
        (select count(*) from x_{parent} where {parent_key} is not null and {parent_key} not in (select {key} from x_{child} where {key} is not null)) as childless_parents"""
        for name, child, parent, key, parent_key in _SIDES
    ),
)
def _(t):
    names = dict.fromkeys(x for _, c, p, _, _ in _SIDES for x in (c, p))
    out = g.integrity_register({n: t.raw(n) for n in names}, {n: g.Relation(c, p, k, q) for n, c, p, k, q in _SIDES})
    return out.select(
        "issue", (F.col("checked_rows") - F.col("null_keys")).alias("child_rows"), "null_keys", "keys", "orphan_rows", "orphan_keys", "parents", "childless_parents"
    )


@query(
    "symmetric_discrepancy",
    """select 'expected_but_not_actual' as discrepancy_type, order_id
    from (select distinct order_id from x_order_payments) anti join x_order_reviews using (order_id)
    union all select 'actual_but_not_expected', order_id
    from (select distinct order_id from x_order_reviews) anti join x_order_payments using (order_id)""",
)
def _(t):
    return a.symmetric_discrepancy(t.raw("order_payments"), t.raw("order_reviews"), "order_id")


@query(
    "outer_compare",
    """select product_category_name as left_side, cast(length(product_category_name) as int) as left_length,
    category_name_portuguese as right_side, cast(length(category_name_portuguese) as int) as right_length
    from c_products full join c_category_translation on category_name_portuguese = product_category_name
    where product_category_name = 'promo' or product_category_name = 'small' or category_name_portuguese like 'brand#2%'""",
)
def _(t):
    return a.outer_compare(
        t.kept("products"),
        t.kept("category_translation"),
        "product_category_name",
        "category_name_portuguese",
        F.col("product_category_name").isin("promo", "small"),
        F.col("category_name_portuguese").like("brand#2%"),
        row_id=["product_id"],
    )


@query(
    "zero_value_audit",
    """select order_id, cast(0 as bigint) as page, count(*) as rows, round(sum(payment_value), 2) as total,
    array_to_string(list_sort(list(payment_type)), ', ') as kinds_used from c_order_payments
    where order_id in (select order_id from c_order_payments where payment_value = 0) group by order_id""",
)
def _(t):
    return a.zero_value_audit(t.kept("order_payments"), "order_id", "payment_value", "payment_type")


@query(
    "zero_value_parents",
    """select order_id, order_status, payment_type from c_orders join c_order_payments using (order_id)
    where payment_value = 0""",
)
def _(t):
    return a.zero_value_parents(
        t.kept("order_payments").select("order_id", "payment_sequential", "payment_type", "payment_value"),
        t.kept("orders").select("order_id", "order_status"),
        "order_id",
        "payment_value",
        ["order_id", "order_status", "payment_type"],
    )


_HOT = """select case when l_linenumber = 1 then 1 when l_linenumber = 2 then null else l_partkey end as k,
    l_quantity as q from lineitem"""


def _hot_items(t):
    """One key and NULL hold a large share of the rows each."""
    k = F.when(F.col("l_linenumber") == 1, F.lit(1)).when(F.col("l_linenumber") != 2, F.col("l_partkey"))
    return t.src("lineitem").select(k.cast("bigint").alias("k"), F.col("l_quantity").alias("q"))


def _orders_by_key(t):
    return t.src("orders").select(F.col("o_orderkey").cast("bigint").alias("k"), "o_totalprice")


def _per_key(df, priced):
    price = F.round(F.max("o_totalprice"), 2).alias("price")
    return df.groupBy("k").agg(F.count("*").alias("n"), F.round(F.sum("q"), 2).alias("q"), *([price] if priced else []))


for _how, _join, _priced in (
    ("left", "left join orders on k = o_orderkey", True),
    ("inner", "join orders on k = o_orderkey", True),
    ("semi", "semi join orders on k = o_orderkey", False),
    ("anti", "anti join orders on k = o_orderkey", False),
):

    @query(
        f"lookup_join_hot_{_how}",
        f"""select k, count(*) as n, round(sum(q), 2) as q{", round(max(o_totalprice), 2) as price" if _priced else ""}
        from ({_HOT}) {_join} group by k""",
    )
    def _(t, how=_how, priced=_priced):
        return _per_key(lookup_join(_hot_items(t), _orders_by_key(t), "k", how), priced)


@query(
    "lookup_join_hot_null_safe",
    f"""select k, count(*) as n, round(sum(q), 2) as q, round(max(o_totalprice), 2) as price from ({_HOT})
    left join (select o_orderkey, o_totalprice from orders union all select null, 5) r on k is not distinct from o_orderkey
    group by k""",
)
def _(t):
    right = _orders_by_key(t)
    extra = right.agg(F.lit(None).cast("bigint").alias("k"), F.lit(5).cast(right.schema["o_totalprice"].dataType).alias("o_totalprice"))
    return _per_key(lookup_join(_hot_items(t), right.union(extra), "k", null_safe=True), True)


@query(
    "full_outer_hot",
    f"""select coalesce(k, -1) as k, count(*) as n, round(sum(q), 2) as q, round(max(o_totalprice), 2) as price
    from ({_HOT}) full join orders on k = o_orderkey group by all""",
)
def _(t):
    both = full_outer(_hot_items(t), _orders_by_key(t).withColumnRenamed("k", "o"), "k", "o")
    return _per_key(both.withColumn("k", F.coalesce("k", F.lit(-1))), True)
