"""The standard checks of clean and serving tables, for `Warehouse.save(..., checks=)`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanstar.functions import text as tx
from gleanstar.operators import checks as c

ORDER_FLAGS = [
    "is_delivered_missing_final_date_only",
    "is_delivered_missing_multiple_dates_anomaly",
    "is_delivered_missing_approval_anomaly",
    "is_delivered_missing_carrier_anomaly",
    "is_canceled_with_delivery_date_anomaly",
    "is_delivery_before_carrier_anomaly",
    "is_carrier_before_approval_anomaly",
]
FACT_KEYS = ["customer_key", "seller_key", "product_key", "order_date_key", "data_quality_key"]


def orders() -> dict[str, Column]:
    delivered = (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNull()
    return {
        **c.row_count(),
        **c.nulls(["order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"]),
        **c.flags(ORDER_FLAGS),
        **c.mutually_exclusive(ORDER_FLAGS[0], ORDER_FLAGS[1]),
        **c.reconcile(ORDER_FLAGS[:2], delivered),
        **c.standardized({"order_status": tx.lower_trimmed("order_status")}),
    }


def customers() -> dict[str, Column]:
    return {
        **c.row_count(),
        **c.nulls(["customer_id", "customer_unique_id"]),
        **c.flags(["has_multiple_addresses_on_record"]),
        **c.code_format("customer_zip_code_prefix"),
    }


def order_items() -> dict[str, Column]:
    return {
        **c.row_count(),
        **c.flags(["is_zero_freight", "is_shipping_date_anomaly"]),
        **c.non_negative(["price", "freight_value"], zero=["price"]),
    }


def order_payments() -> dict[str, Column]:
    odd = F.col("is_zero_payment_value") & ~F.col("is_undefined_payment_type") & (F.col("payment_type") != "voucher")
    return {
        **c.row_count(),
        **c.flags(["is_undefined_payment_type", "is_zero_payment_value", "is_zero_installments", "has_missing_sequential_start"]),
        **c.counts({"unexplained_zero_value_rows": odd}),
    }


def order_reviews() -> dict[str, Column]:
    texts = ["review_comment_title", "review_comment_message"]
    return {
        **c.row_count(),
        **c.nulls(["review_id", "order_id"]),
        **c.standardized({t: tx.trimmed(t) for t in texts}),
        **c.counts({"invalid_review_score": ~F.col("review_score").between(1, 5)}),
    }


def products() -> dict[str, Column]:
    return {**c.row_count(), **c.nulls(["product_category_name"]), **c.flags(["had_zero_weight_imputed", "had_null_category"])}


def sellers() -> dict[str, Column]:
    return {**c.row_count(), **c.flags(["city_was_corrected", "has_wrong_attribute_city"]), **c.code_format("seller_zip_code_prefix")}


def geolocation() -> dict[str, Column]:
    return {
        **c.row_count(),
        **c.flags(["has_unresolved_city_ambiguity"]),
        **c.code_format("geolocation_zip_code_prefix"),
        **c.pattern_rows("geolocation_city", f"[{tx.ACCENTED}]", "accented_cities"),
    }


def category_translation() -> dict[str, Column]:
    return {**c.row_count(), **c.nulls(["category_name_portuguese", "category_name_english"])}


def fact() -> dict[str, Column]:
    days, on_time = F.col("delivery_estimate_error_days"), F.col("is_delivered_on_time")
    price, ratio = F.col("price"), F.col("freight_to_price_ratio")
    return {
        **c.row_count(),
        **c.nulls(FACT_KEYS),
        **c.null_equivalence("delivery_estimate_error_days", "is_delivered_on_time"),
        **c.counts(
            {
                "late_but_on_time": (days > 0) & on_time,
                "early_but_late": (days < 0) & ~on_time,
                "unexpected_ratio": (price == 0) & ratio.isNotNull(),
                "missing_ratio": (price != 0) & ratio.isNull(),
            }
        ),
    }


# Table names to the function that builds their checks; columns need a running session.
CHECKS: dict[str, Callable[[], dict[str, Column]]] = {
    "orders": orders,
    "customers": customers,
    "order_items": order_items,
    "order_payments": order_payments,
    "order_reviews": order_reviews,
    "products": products,
    "sellers": sellers,
    "geolocation": geolocation,
    "category_translation": category_translation,
    "fact_order_item_fulfillment": fact,
}
# Those that no table may fail.
REQUIRED: dict[str, list[str]] = {
    "orders": ["overlap_rows", "unstandardized_rows"],
    "order_items": ["negative_price", "negative_freight_value"],
    "order_payments": [],
    "order_reviews": ["unstandardized_rows"],
    "geolocation": ["accented_cities"],
    "fact_order_item_fulfillment": ["null_mismatch", "late_but_on_time", "early_but_late", "unexpected_ratio", "missing_ratio"],
}


def checked_save(store, layer: str, strict: bool = False):
    """`save` for `clean_all` and `build_star` that stores every table with its standard checks,
    and with `strict` refuses a table that fails a required one."""

    def save(name: str, df):
        wanted = CHECKS[name]() if name in CHECKS else c.row_count()
        return store.save(layer, name, df, checks=wanted, require=REQUIRED.get(name, []) if strict else [])

    return save
