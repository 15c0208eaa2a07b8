"""Fixed schemas of the raw tables and reports, as DDL (no inference pass over large files)."""

from __future__ import annotations

# Zip codes are text: as numbers they would lose their leading zeros. Times are text too and
# are parsed by the cleaning jobs, where a malformed value becomes null.
RAW = {
    "orders": (
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp string, order_approved_at string, "
        "order_delivered_carrier_date string, order_delivered_customer_date string, "
        "order_estimated_delivery_date string"
    ),
    "items": (
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date string, price double, freight_value double"
    ),
    "payments": (
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value double"
    ),
    "customers": (
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "geolocation": (
        "geolocation_zip_code_prefix string, geolocation_lat double, "
        "geolocation_lng double, geolocation_city string, geolocation_state string"
    ),
    "sellers": (
        "seller_id string, seller_zip_code_prefix string, seller_city string, "
        "seller_state string"
    ),
    "reviews": (
        "review_id string, order_id string, review_score int, "
        "review_comment_title string, review_comment_message string, "
        "review_creation_date string, review_answer_timestamp string"
    ),
    "products": (
        "product_id string, product_category_name string, product_name_lenght double, "
        "product_description_lenght double, product_photos_qty double, "
        "product_weight_g double, product_length_cm double, product_height_cm double, "
        "product_width_cm double"
    ),
    "translation": (
        "product_category_name string, product_category_name_english string"
    ),
}

REPORTS = {
    "ssl_bias_report": (
        "total_pseudo_positives bigint, positives_from_top_categories bigint, "
        "percentage_top_category double"
    ),
}
