"""Raw table layouts (fixed values: table and column names as the CSV headers spell them)."""

from __future__ import annotations

RAW_SCHEMAS = {
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
        "customer_city string, customer_state string"
    ),
    "orders": (
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
        "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
        "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
    ),
    "order_items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp, price double, freight_value double"
    ),
    "order_payments": (
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"
    ),
    "order_reviews": (
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght int, "
        "product_description_lenght int, product_photos_qty int, product_weight_g int, "
        "product_length_cm int, product_height_cm int, product_width_cm int"
    ),
    "sellers": "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
    "geolocation": (
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"
    ),
    "category_translation": "string_field_0 string, string_field_1 string",
}
# Texts in these tables may contain line breaks.
MULTILINE = {"order_reviews"}
LAYERS = ("raw", "clean", "serving")
