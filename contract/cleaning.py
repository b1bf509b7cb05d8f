"""Cleaning queries: single steps and the nine clean tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.adapters import CUTOFF
from contract.profiling import ORDER_TS
from contract.registry import query
from gleanstar.functions import text as tx
from gleanstar.operators import clean as k
from gleanstar.plans.cleaning import clean_geolocation

WHITE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"


@query(
    "standardize_text",
    "select s_suppkey, lower(trim(seller_city)) as seller_city, upper(trim(seller_state)) as seller_state"
    " from (select cast(substr(seller_id, 2) as bigint) as s_suppkey, seller_city, seller_state from x_sellers)",
)
def _(t):
    raw = t.raw("sellers").select(
        F.substr("seller_id", F.lit(2)).cast("bigint").alias("s_suppkey"), "seller_city", "seller_state"
    )
    return k.standardize_text(raw, lower=["seller_city"], upper=["seller_state"])


@query(
    "standardize_text_documents",
    f"select doc_id, md5(lower(trim(text, {WHITE}))) as digest, upper(lang) as lang from documents",
)
def _(t):
    docs = k.standardize_text(t.src("documents").select("doc_id", "text", "lang"), lower=["text"], upper=["lang"])
    return docs.select("doc_id", F.md5("text").alias("digest"), "lang")


@query("trim_ids", "select order_id, order_item_id, trim(seller_id) as seller_id, price from x_order_items")
def _(t):
    items = t.raw("order_items").select("order_id", "order_item_id", "seller_id", "price")
    return k.trim_ids(items, ["order_id", "seller_id"])


@query(
    "pad_code",
    """select customer_id, lpad(cast(customer_zip_code_prefix as varchar), 5, '0') as customer_zip_code_prefix
    from x_customers""",
)
def _(t):
    return k.pad_code(t.raw("customers").select("customer_id", "customer_zip_code_prefix"), "customer_zip_code_prefix")


@query(
    "typed_timestamps",
    "select o_orderkey, cast(cast(o_orderdate as varchar) as timestamp) as o_orderdate from orders",
    "o_orderdate",
)
def _(t):
    texts = t.src("orders").select("o_orderkey", F.col("o_orderdate").cast("string").alias("o_orderdate"))
    return k.typed_timestamps(texts, ["o_orderdate"])


@query(
    "null_preserving_trim",
    """select review_id, trim(review_comment_title) as review_comment_title,
    trim(review_comment_message) as review_comment_message from x_order_reviews""",
)
def _(t):
    cols = ["review_comment_title", "review_comment_message"]
    return k.null_preserving_trim(t.raw("order_reviews").select("review_id", *cols), cols)


@query(
    "placeholder_null",
    """select product_id, coalesce(product_category_name, 'unknown') as product_category_name,
    product_category_name is null as had_null_category from x_products""",
)
def _(t):
    return k.placeholder_null(
        t.raw("products").select("product_id", "product_category_name"), "product_category_name", "had_null_category"
    )


@query(
    "impute_group_median",
    """select product_id, cat, cast(case when product_weight_g = 0 then coalesce(med, 0) else product_weight_g end as int)
    as product_weight_g, product_weight_g = 0 as was_zero
    from (select product_id, lower(trim(product_category_name)) as cat, product_weight_g from x_products)
    left join (select lower(trim(product_category_name)) as g, quantile_disc(product_weight_g, 0.5) as med
      from x_products where product_weight_g > 0 group by 1) on g = cat""",
)
def _(t):
    p = t.raw("products").select(
        "product_id", tx.lower_trimmed("product_category_name").alias("cat"), "product_weight_g"
    )
    return k.impute_group_median(p, "cat", "product_weight_g", "was_zero")


@query(
    "lookup_correction",
    "select seller_id, seller_city, city_was_corrected from c_sellers",
)
def _(t):
    s = t.raw("sellers").select("seller_id", tx.lower_trimmed("seller_city").alias("seller_city"))
    return k.lookup_correction(s, "seller_city", "city_was_corrected")


@query(
    "wrong_attribute_flag",
    """select seller_id, lower(trim(seller_city)) as seller_city,
    lower(trim(seller_city)) in ('sp', 'minas gerais', 'santa catarina') as flagged from x_sellers""",
)
def _(t):
    s = t.raw("sellers").select("seller_id", tx.lower_trimmed("seller_city").alias("seller_city"))
    return k.wrong_attribute_flag(s, "seller_city", "flagged")


@query(
    "drop_out_of_bounds",
    """select * from x_geolocation
    where geolocation_lat between -34 and 6 and geolocation_lng between -75 and -33""",
)
def _(t):
    return k.drop_out_of_bounds(t.raw("geolocation"), {"geolocation_lat": k.LATITUDE, "geolocation_lng": k.LONGITUDE})


@query(
    "fold_diacritics",
    f"""select doc_id, md5(translate(lower(trim(text, {WHITE})), '{tx.ACCENTED}', '{tx.PLAIN}')) as digest from documents""",
)
def _(t):
    docs = k.fold_diacritics(t.src("documents").select("doc_id", "text"), ["text"])
    return docs.select("doc_id", F.md5("text").alias("digest"))


@query(
    "fold_diacritics_before_lowering",
    f"""select geolocation_lat, geolocation_lng,
    lower(translate(trim(geolocation_city), '{tx.ACCENTED}', '{tx.PLAIN}')) as geolocation_city from x_geolocation""",
)
def _(t):
    g = t.raw("geolocation").select("geolocation_lat", "geolocation_lng", "geolocation_city")
    return k.fold_diacritics(g, ["geolocation_city"], lower_first=False)


@query(
    "ambiguity_flag",
    """select *, count(distinct geolocation_city) over (partition by geolocation_zip_code_prefix) > 1 as ambiguous
    from x_geolocation""",
)
def _(t):
    return k.ambiguity_flag(t.raw("geolocation"), "geolocation_zip_code_prefix", "geolocation_city", "ambiguous")


@query(
    "multi_value_flag",
    """select *, count(distinct customer_city) over (partition by customer_unique_id) > 1
    or count(distinct customer_state) over (partition by customer_unique_id) > 1 as several from x_customers""",
)
def _(t):
    return k.multi_value_flag(
        t.raw("customers"), "customer_unique_id", ["customer_city", "customer_state"], "several"
    )


@query("lifecycle_flags", "select * from c_orders", ORDER_TS)
def _(t):
    return k.lifecycle_flags(k.standardize_text(t.raw("orders"), lower=["order_status"]))


@query(
    "payment_flags",
    """select order_id, payment_type, payment_value, is_undefined_payment_type, is_zero_payment_value,
    is_zero_installments, payment_installments from c_order_payments""",
)
def _(t):
    p = t.raw("order_payments").select("order_id", "payment_type", "payment_value", "payment_installments")
    return k.payment_flags(k.standardize_text(p, lower=["payment_type"]))


@query(
    "missing_sequence_start",
    """select order_id, payment_sequential, payment_type,
    min(payment_sequential) over (partition by order_id) > 1 as late_start from x_order_payments""",
)
def _(t):
    p = t.raw("order_payments").select("order_id", "payment_sequential", "payment_type")
    return k.missing_sequence_start(p, "order_id", "payment_sequential", "late_start")


@query(
    "item_flags",
    f"""select order_id, order_item_id, freight_value, shipping_limit_date, freight_value = 0 as is_zero_freight,
    shipping_limit_date >= timestamp '{CUTOFF}' as is_shipping_date_anomaly from x_order_items""",
    "shipping_limit_date",
)
def _(t):
    items = t.raw("order_items").select("order_id", "order_item_id", "freight_value", "shipping_limit_date")
    return k.item_flags(items, cutoff=CUTOFF)


@query("rename_columns", "select string_field_0 as local_name, string_field_1 as english_name from x_category_translation")
def _(t):
    return k.rename_columns(
        t.raw("category_translation"), {"string_field_0": "local_name", "string_field_1": "english_name"}
    )


@query("clean_orders", "select * from c_orders", ORDER_TS)
def _(t):
    return t.clean("orders")


@query("clean_customers", "select * from c_customers")
def _(t):
    return t.clean("customers")


@query("clean_order_items", "select * from c_order_items", "shipping_limit_date")
def _(t):
    return t.clean("order_items")


@query("clean_payments", "select * from c_order_payments")
def _(t):
    return t.clean("order_payments")


@query("clean_reviews", "select * from c_order_reviews", "review_creation_date review_answer_timestamp")
def _(t):
    return t.clean("order_reviews")


@query("clean_products", "select * from c_products")
def _(t):
    return t.clean("products")


@query("clean_sellers", "select * from c_sellers")
def _(t):
    return t.clean("sellers")


@query("clean_geolocation", "select * from c_geolocation")
def _(t):
    return t.clean("geolocation")


@query(
    "clean_geolocation_fold_first",
    f"""select *, count(distinct geolocation_city) over (partition by geolocation_zip_code_prefix) > 1
    as has_unresolved_city_ambiguity
    from (select * replace (lpad(cast(geolocation_zip_code_prefix as varchar), 5, '0') as geolocation_zip_code_prefix,
      upper(trim(geolocation_state)) as geolocation_state,
      lower(translate(trim(geolocation_city), '{tx.ACCENTED}', '{tx.PLAIN}')) as geolocation_city)
    from x_geolocation where geolocation_lat between -34 and 6 and geolocation_lng between -75 and -33)""",
)
def _(t):
    return clean_geolocation(t.raw("geolocation"), lower_first=False)


@query("clean_translation", "select * from c_category_translation")
def _(t):
    return t.clean("category_translation")
