"""The nine clean tables. Each reads one raw table; only geolocation loses rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from gleanstar.operators import clean as k

TIMESTAMPS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]


def clean_orders(raw: DataFrame) -> DataFrame:
    return k.lifecycle_flags(k.typed_timestamps(k.standardize_text(raw, lower=["order_status"]), TIMESTAMPS))


def clean_customers(raw: DataFrame) -> DataFrame:
    text = k.standardize_text(raw, lower=["customer_city"], upper=["customer_state"])
    coded = k.pad_code(text, "customer_zip_code_prefix")
    return k.multi_value_flag(
        coded, "customer_unique_id", ["customer_city", "customer_state"], "has_multiple_addresses_on_record"
    )


def clean_order_items(raw: DataFrame, cutoff: str = k.SHIPPING_CUTOFF) -> DataFrame:
    typed = k.typed_timestamps(k.trim_ids(raw, ["order_id", "product_id", "seller_id"]), ["shipping_limit_date"])
    return k.item_flags(typed, cutoff=cutoff)


def clean_payments(raw: DataFrame) -> DataFrame:
    text = k.standardize_text(k.trim_ids(raw, ["order_id"]), lower=["payment_type"])
    return k.missing_sequence_start(
        k.payment_flags(text), "order_id", "payment_sequential", "has_missing_sequential_start"
    )


def clean_reviews(raw: DataFrame) -> DataFrame:
    trimmed = k.null_preserving_trim(
        k.trim_ids(raw, ["review_id", "order_id"]), ["review_comment_title", "review_comment_message"]
    )
    return k.typed_timestamps(trimmed, ["review_creation_date", "review_answer_timestamp"])


def clean_products(raw: DataFrame) -> DataFrame:
    text = k.standardize_text(k.trim_ids(raw, ["product_id"]), lower=["product_category_name"])
    weighed = k.impute_group_median(text, "product_category_name", "product_weight_g", "had_zero_weight_imputed")
    return k.placeholder_null(weighed, "product_category_name", "had_null_category")


def clean_sellers(raw: DataFrame) -> DataFrame:
    text = k.standardize_text(k.trim_ids(raw, ["seller_id"]), lower=["seller_city"], upper=["seller_state"])
    coded = k.pad_code(text, "seller_zip_code_prefix")
    corrected = k.lookup_correction(coded, "seller_city", "city_was_corrected")
    return k.wrong_attribute_flag(corrected, "seller_city", "has_wrong_attribute_city")


def clean_geolocation(raw: DataFrame, lower_first: bool = True) -> DataFrame:
    """`lower_first=False` keeps the accent of upper-case letters (see `fold_diacritics`)."""
    inside = k.drop_out_of_bounds(raw, {"geolocation_lat": k.LATITUDE, "geolocation_lng": k.LONGITUDE})
    coded = k.standardize_text(k.pad_code(inside, "geolocation_zip_code_prefix"), upper=["geolocation_state"])
    folded = k.fold_diacritics(coded, ["geolocation_city"], lower_first)
    return k.ambiguity_flag(folded, "geolocation_zip_code_prefix", "geolocation_city", "has_unresolved_city_ambiguity")


def clean_translation(raw: DataFrame) -> DataFrame:
    named = k.rename_columns(
        raw, {"string_field_0": "category_name_portuguese", "string_field_1": "category_name_english"}
    )
    return k.standardize_text(named, lower=["category_name_portuguese", "category_name_english"])


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "orders": clean_orders,
    "customers": clean_customers,
    "order_items": clean_order_items,
    "order_payments": clean_payments,
    "order_reviews": clean_reviews,
    "products": clean_products,
    "sellers": clean_sellers,
    "geolocation": clean_geolocation,
    "category_translation": clean_translation,
}


def clean_all(
    raw: Mapping[str, DataFrame], save: Callable[[str, DataFrame], DataFrame] = lambda name, df: df
) -> dict[str, DataFrame]:
    """All clean tables; `save` stores each one and returns it as stored."""
    return {name: save(name, build(raw[name])) for name, build in CLEANERS.items()}
