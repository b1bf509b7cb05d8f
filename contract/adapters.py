"""Views of the driver's tables in the roles of the nine raw tables, with planted defects.

The driver's tables have no NULLs and no orphans, so each view plants some by rules on
the keys. The text runs unchanged in Spark SQL and DuckDB: `{orders}` stands for the
table, a DataFrame on one side and a view name on the other.
"""

ADAPTERS = {
    "x_orders": """
select o_orderkey as order_id,
  case when o_orderkey % 503 = 0 then -o_custkey - 1 else o_custkey end as customer_id,
  case when o_orderkey % 409 = 0 then null when o_orderkey % 97 = 0 then 'canceled'
    when o_orderstatus = 'O' then ' Shipped' else 'delivered' end as order_status,
  cast(o_orderdate as timestamp) as order_purchase_timestamp,
  case when o_orderkey % 101 = 0 then null
    else cast(o_orderdate as timestamp) + (o_orderkey % 72) * interval '1' hour end as order_approved_at,
  case when o_orderkey % 103 = 0 or (o_orderkey % 101 = 0 and o_orderkey % 2 = 0) then null
    else cast(o_orderdate as timestamp) + ((o_orderkey * 7) % 240) * interval '1' hour end
    as order_delivered_carrier_date,
  case when o_orderstatus = 'O' or o_orderkey % 53 = 0 then null
    else cast(o_orderdate as timestamp) + ((o_orderkey * 13) % 720) * interval '1' hour end
    as order_delivered_customer_date,
  cast(cast(o_orderdate as date) as timestamp) + (12 + o_orderkey % 10) * interval '1' day
    as order_estimated_delivery_date
from {orders}""",
    "x_order_items": """
select case when l_orderkey % 499 = 0 then -l_orderkey - 1 else l_orderkey end as order_id,
  l_linenumber as order_item_id,
  case when l_orderkey % 401 = 0 then -l_partkey - 1 else l_partkey end as product_id,
  concat(case when l_linenumber % 7 = 0 then ' S' else 'S' end,
    cast(case when l_orderkey % 307 = 0 then -l_suppkey - 1 else l_suppkey end as string)) as seller_id,
  case when l_orderkey % 311 = 0 then null else cast(l_shipdate as timestamp) end as shipping_limit_date,
  case when l_partkey % 211 = 0 then cast(0 as double) else l_extendedprice end as price,
  l_quantity * l_tax as freight_value
from {lineitem}""",
    "x_order_payments": """
select case when event_id % 500 = 7 then -event_id - 1 else
    cast((event_id - event_id % 10) / 10 as bigint) * 7 + case event_id % 10 when 0 then 0 when 1 then 0 when 2 then 0
      when 3 then 1 when 4 then 2 when 5 then 2 when 6 then 3 when 7 then 4 when 8 then 5 else 6 end end as order_id,
  cast(case event_id % 10 when 1 then 2 when 2 then 3 when 5 then 2 else 1 end
    + case when event_id % 130 > 119 then 1 else 0 end as int) as payment_sequential,
  concat(' ', case when event_type = 'error' then 'NOT_DEFINED' else upper(event_type) end) as payment_type,
  cast(case when event_type = 'error' and event_id % 5 = 0 then 0 else 1 + event_id % 10 end as int)
    as payment_installments,
  case when event_type = 'error' and event_id % 5 = 0 then cast(0 as double)
    when event_id % 97 = 0 then null else value end as payment_value
from {events}""",
    "x_order_reviews": """
select concat('R', cast(event_id - case when event_id % 100 = 99 then 1 else 0 end as string), ' ') as review_id,
  case when event_id % 700 = 5 then -event_id - 1
    else event_id - case when event_id % 50 = 49 then 2 when event_id % 20 = 19 then 1 else 0 end end as order_id,
  cast(case when event_id % 997 = 0 then 6 else 1 + event_id % 5 end as int) as review_score,
  case when event_id % 8 = 0 then event_type end as review_comment_title,
  case when event_id % 12 < 5 then concat('  ', event_type, ' ') end as review_comment_message,
  cast(cast(ts as date) as timestamp) as review_creation_date,
  cast(cast(ts as date) as timestamp) + (event_id % 72 - 2) * interval '1' hour as review_answer_timestamp
from {events}""",
    "x_products": """
select p_partkey as product_id,
  case when p_partkey % 50 = 0 then null when p_partkey % 3 = 0 then concat(' ', p_type)
    else lower(p_type) end as product_category_name,
  cast(length(p_name) as int) as product_name_lenght,
  cast(100 + p_partkey % 900 as int) as product_description_lenght,
  cast(p_size % 7 as int) as product_photos_qty,
  cast(case when p_partkey % 97 = 0 then 0 when p_partkey % 89 = 0 then null else p_size * 100 end as int)
    as product_weight_g,
  p_size as product_length_cm, cast(p_size % 11 as int) as product_height_cm,
  cast(p_size % 13 as int) as product_width_cm
from {part}""",
    "x_sellers": """
select concat('S', cast(s_suppkey as string)) as seller_id,
  cast(s_nationkey * 1000 + s_suppkey % 8 as int) as seller_zip_code_prefix,
  case s_suppkey % 25 when 0 then 'Sao Paulo SP' when 1 then ' sao paulo' when 2 then 'garulhos' when 3 then 'sp'
    when 4 then 'PORTOFERREIRA ' when 5 then 'minas gerais' else concat('City ', cast(s_nationkey as string)) end
    as seller_city,
  concat('n', cast(s_nationkey as string), ' ') as seller_state
from {supplier}""",
    "x_customers": """
select c_custkey as customer_id,
  case when c_custkey % 10 = 0 and c_custkey > 0 then c_custkey - 1 else c_custkey end as customer_unique_id,
  cast(c_nationkey * 1000 + c_custkey % 8 as int) as customer_zip_code_prefix,
  concat(' City ', cast(c_nationkey as string)) as customer_city,
  concat('n', cast(c_nationkey as string)) as customer_state
from {customer}""",
    "x_geolocation": """
select cast(c_nationkey * 1000 + case when c_custkey % 8 = 7 then 500 else c_custkey % 8 end as int)
    as geolocation_zip_code_prefix,
  case when c_custkey % 300 = 0 then cast(45 as double) when c_custkey % 290 = 0 then null
    else cast(-20 + c_custkey % 25 as double) end as geolocation_lat,
  cast(-60 + c_custkey % 20 as double) as geolocation_lng,
  case when c_custkey % 7 = 3 and c_nationkey % 2 = 0 then 'santo andré' when c_custkey % 7 = 1 then 'São Paulo'
    when c_custkey % 7 = 2 then 'SÃO PAULO ' else 'sao paulo' end as geolocation_city,
  concat('n', cast(c_nationkey as string)) as geolocation_state
from {customer}""",
    "x_category_translation": """
select distinct case when p_type = 'PROMO' then 'promo unlisted' else lower(p_type) end as string_field_0,
  concat(' ', p_type, ' Goods') as string_field_1
from {part}
union all
select distinct lower(p_brand) as string_field_0, concat(p_brand, ' Range') as string_field_1 from {part}""",
}
SOURCES = {
    "x_orders": ["orders"],
    "x_order_items": ["lineitem"],
    "x_order_payments": ["events"],
    "x_order_reviews": ["events"],
    "x_products": ["part"],
    "x_sellers": ["supplier"],
    "x_customers": ["customer"],
    "x_geolocation": ["customer"],
    "x_category_translation": ["part"],
}
# Shipping limits of the driver's tables end in 2001.
CUTOFF = "2001-08-02"
# These six columns identify an item in the driver's tables.
ITEM_KEY = ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price"]
