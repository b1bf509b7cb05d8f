"""DuckDB definitions of the clean and serving tables, used as CTEs by the oracles."""

from __future__ import annotations

import re

from contract.adapters import ADAPTERS, CUTOFF, SOURCES
from gleanstar.functions.text import ACCENTED, PLAIN
from gleanstar.operators.clean import CITY_CORRECTIONS, LATITUDE, LONGITUDE, WRONG_CITIES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_corrections = ", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in CITY_CORRECTIONS)
_wrong = ", ".join(_quoted(c) for c in WRONG_CITIES)

BASE = {
    "c_orders": """
select * exclude (a, c, d),
  order_status <> 'delivered' and d is null as is_expected_null_delivery,
  order_status = 'delivered' and d is null and a is not null and c is not null as is_delivered_missing_final_date_only,
  order_status = 'delivered' and d is null and (a is null or c is null) as is_delivered_missing_multiple_dates_anomaly,
  order_status = 'delivered' and a is null as is_delivered_missing_approval_anomaly,
  order_status = 'delivered' and c is null as is_delivered_missing_carrier_anomaly,
  order_status = 'canceled' and d is not null as is_canceled_with_delivery_date_anomaly,
  coalesce(d < c, false) as is_delivery_before_carrier_anomaly,
  coalesce(c < a, false) as is_carrier_before_approval_anomaly
from (select * replace (lower(trim(order_status)) as order_status), order_approved_at as a,
  order_delivered_carrier_date as c, order_delivered_customer_date as d from x_orders)""",
    "c_customers": """
select *, coalesce(min(customer_city) over p < max(customer_city) over p, false)
    or coalesce(min(customer_state) over p < max(customer_state) over p, false) as has_multiple_addresses_on_record
from (select * replace (lpad(cast(customer_zip_code_prefix as varchar), 5, '0') as customer_zip_code_prefix,
    lower(trim(customer_city)) as customer_city, upper(trim(customer_state)) as customer_state) from x_customers)
window p as (partition by customer_unique_id)""",
    "c_order_items": f"""
select * replace (trim(seller_id) as seller_id), freight_value = 0 as is_zero_freight,
  shipping_limit_date >= timestamp '{CUTOFF}' as is_shipping_date_anomaly
from x_order_items""",
    "c_order_payments": """
select * replace (lower(trim(payment_type)) as payment_type),
  lower(trim(payment_type)) = 'not_defined' as is_undefined_payment_type,
  payment_value = 0 as is_zero_payment_value, payment_installments = 0 as is_zero_installments,
  min(payment_sequential) over (partition by order_id) > 1 as has_missing_sequential_start
from x_order_payments""",
    "c_order_reviews": """
select * replace (trim(review_id) as review_id, trim(review_comment_title) as review_comment_title,
  trim(review_comment_message) as review_comment_message) from x_order_reviews""",
    "c_products": """
select p.* exclude (cat) replace (coalesce(cat, 'unknown') as product_category_name,
    cast(case when product_weight_g = 0 then coalesce(med, 0) else product_weight_g end as int) as product_weight_g),
  product_weight_g = 0 as had_zero_weight_imputed, cat is null as had_null_category
from (select *, lower(trim(product_category_name)) as cat from x_products) p
left join (select lower(trim(product_category_name)) as g, quantile_disc(product_weight_g, 0.5) as med
  from x_products where product_weight_g > 0 group by 1) on g = cat""",
    "c_sellers": f"""
select s.* exclude (city) replace (coalesce(good, city) as seller_city), good is not null as city_was_corrected,
  coalesce(good, city) in ({_wrong}) as has_wrong_attribute_city
from (select * replace (trim(seller_id) as seller_id, upper(trim(seller_state)) as seller_state,
    lpad(cast(seller_zip_code_prefix as varchar), 5, '0') as seller_zip_code_prefix),
    lower(trim(seller_city)) as city from x_sellers) s
left join (values {_corrections}) f(bad, good) on bad = city""",
    "c_geolocation": f"""
select *, coalesce(min(geolocation_city) over z < max(geolocation_city) over z, false) as has_unresolved_city_ambiguity
from (select * replace (lpad(cast(geolocation_zip_code_prefix as varchar), 5, '0') as geolocation_zip_code_prefix,
    upper(trim(geolocation_state)) as geolocation_state,
    translate(lower(trim(geolocation_city)), '{ACCENTED}', '{PLAIN}') as geolocation_city)
  from x_geolocation where geolocation_lat between {LATITUDE[0]} and {LATITUDE[1]}
    and geolocation_lng between {LONGITUDE[0]} and {LONGITUDE[1]})
window z as (partition by geolocation_zip_code_prefix)""",
    "c_category_translation": """
select lower(trim(string_field_0)) as category_name_portuguese, lower(trim(string_field_1)) as category_name_english
from x_category_translation""",
    "dim_date": """
select cast(strftime(d, '%Y%m%d') as bigint) as date_key, d as full_date, cast(year(d) as int) as year,
  cast(quarter(d) as int) as quarter, cast(month(d) as int) as month, strftime(d, '%B') as month_name,
  cast(week(d) as int) as week_of_year, cast(day(d) as int) as day_of_month,
  cast(dayofweek(d) + 1 as int) as day_of_week, strftime(d, '%A') as day_name, dayofweek(d) in (0, 6) as is_weekend
from (select cast(unnest(generate_series(cast(min(order_purchase_timestamp) as date),
  cast(max(order_estimated_delivery_date) as date), interval 1 day)) as date) as d from c_orders)""",
    "dim_product": """
select row_number() over (order by product_id) as product_key, product_id, product_category_name as category_name,
  coalesce(category_name_english, product_category_name) as category_name_english
from c_products left join c_category_translation on category_name_portuguese = product_category_name""",
    "seller_volume": """
select seller_id, count(distinct i.order_id) as order_count, count(o.order_id) > 0 as known,
  min(order_purchase_timestamp) as first_ts
from c_order_items i left join c_orders o on o.order_id = i.order_id group by seller_id""",
    "dim_seller": """
select row_number() over (order by seller_id) as seller_key, seller_id, seller_city, seller_state,
  case when known then case when datediff('day', cast(first_ts as date),
    (select cast(max(order_purchase_timestamp) as date) from c_orders)) <= 90 then 'new' else 'established' end end
    as seller_tenure_bucket,
  list_extract(['low', 'medium', 'high'], tier) as seller_volume_tier
from c_sellers left join (select *, ntile(3) over (order by order_count, seller_id) as tier from seller_volume)
  using (seller_id)""",
    "person_orders": """
select customer_unique_id, customer_state, customer_city, customer_zip_code_prefix, order_id, order_purchase_timestamp,
  row_number() over (partition by customer_unique_id order by order_purchase_timestamp desc, order_id desc) as latest,
  row_number() over (partition by customer_unique_id order by order_purchase_timestamp, order_id) as earliest
from c_orders join c_customers using (customer_id)""",
    "dim_customer": """
select row_number() over (order by a.customer_unique_id) as customer_key, a.customer_unique_id, customer_state,
  customer_city, customer_zip_code_prefix, first_purchase_category
from person_orders a left join (
  select e.customer_unique_id, product_category_name as first_purchase_category
  from person_orders e join c_order_items i on i.order_id = e.order_id and earliest = 1
  left join c_products p on p.product_id = i.product_id
  qualify row_number() over (partition by e.customer_unique_id
    order by price desc nulls last, product_category_name nulls first) = 1) f
  on f.customer_unique_id = a.customer_unique_id
where latest = 1""",
    "item_flags": """
select i.*, is_delivery_before_carrier_anomaly, is_delivered_missing_approval_anomaly,
  is_delivered_missing_multiple_dates_anomaly, is_carrier_before_approval_anomaly,
  is_canceled_with_delivery_date_anomaly, is_shipping_date_anomaly as is_shipping_anomaly
from c_order_items i join c_orders using (order_id)""",
    "data_quality_flags": """
select row_number() over (order by is_delivery_before_carrier_anomaly nulls first,
    is_delivered_missing_approval_anomaly nulls first, is_delivered_missing_multiple_dates_anomaly nulls first,
    is_carrier_before_approval_anomaly nulls first, is_canceled_with_delivery_date_anomaly nulls first,
    is_shipping_anomaly nulls first) as data_quality_key, *
from (select distinct is_delivery_before_carrier_anomaly, is_delivered_missing_approval_anomaly,
  is_delivered_missing_multiple_dates_anomaly, is_carrier_before_approval_anomaly,
  is_canceled_with_delivery_date_anomaly, is_shipping_anomaly from item_flags)""",
    "latest_review": """
select order_id, review_score from c_order_reviews
qualify row_number() over (partition by order_id order by review_creation_date desc, review_id desc) = 1""",
    "fact": """
select row_number() over (order by f.order_id, f.order_item_id, f.product_id, f.seller_id,
    f.shipping_limit_date nulls first, f.price) as order_item_key,
  f.order_id, f.order_item_id, customer_key, seller_key, product_key, date_key as order_date_key, data_quality_key,
  f.price, f.freight_value, f.freight_value / nullif(f.price, 0) as freight_to_price_ratio,
  date_sub('hour', order_approved_at, order_delivered_carrier_date) as approval_to_carrier_hours,
  date_sub('day', order_delivered_carrier_date, order_delivered_customer_date) as carrier_to_customer_days,
  order_delivered_customer_date <= order_estimated_delivery_date as is_delivered_on_time,
  cast(datediff('day', cast(order_estimated_delivery_date as date), cast(order_delivered_customer_date as date)) as int)
    as delivery_estimate_error_days,
  review_score, review_score is not null as has_review,
  f.is_delivery_before_carrier_anomaly or f.is_delivered_missing_approval_anomaly
    or f.is_delivered_missing_multiple_dates_anomaly or f.is_carrier_before_approval_anomaly
    or f.is_canceled_with_delivery_date_anomaly or f.is_shipping_anomaly as has_fulfillment_anomaly,
  order_status
from item_flags f join c_orders o on o.order_id = f.order_id
left join (select customer_id, customer_key from c_customers join dim_customer using (customer_unique_id)) k
  on k.customer_id = o.customer_id
left join dim_seller s on s.seller_id = f.seller_id
left join dim_product p on p.product_id = f.product_id
left join dim_date on full_date = cast(order_purchase_timestamp as date)
left join latest_review r on r.order_id = f.order_id
left join data_quality_flags q on q.is_delivery_before_carrier_anomaly = f.is_delivery_before_carrier_anomaly
  and q.is_delivered_missing_approval_anomaly = f.is_delivered_missing_approval_anomaly
  and q.is_delivered_missing_multiple_dates_anomaly = f.is_delivered_missing_multiple_dates_anomaly
  and q.is_carrier_before_approval_anomaly = f.is_carrier_before_approval_anomaly
  and q.is_canceled_with_delivery_date_anomaly = f.is_canceled_with_delivery_date_anomaly
  and q.is_shipping_anomaly = f.is_shipping_anomaly""",
}
CTES = {n: sql.format(**{s: s for s in SOURCES[n]}) for n, sql in ADAPTERS.items()} | BASE


def with_base(sql: str, text: str = "") -> str:
    """The statement with the CTEs it needs; columns named in `text` become text."""
    if text:
        casts = ", ".join(f"cast({c} as varchar) as {c}" for c in text.split())
        sql = f"select * replace ({casts}) from ({sql.strip()})"
    needed: list[str] = []

    def visit(body: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", body):
                visit_name(name)

    def visit_name(name: str) -> None:
        body = CTES[name]
        for other in CTES:
            if other != name and other not in needed and re.search(rf"\b{other}\b", body):
                visit_name(other)
        if name not in needed:
            needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    parts = ", ".join(f"{n} as materialized ({CTES[n].strip()})" for n in needed)
    body = sql.strip()
    # A statement with CTEs of its own continues the list.
    return f"with {parts}, {body[5:]}" if body.startswith("with ") else f"with {parts} {body}"
