"""Schemas of the nine raw tables as read, before staging types them."""

from __future__ import annotations

from pyspark.sql.types import StructType

RAW = {
    "orders": """
        order_id string, customer_id string, order_status string,
        order_purchase_timestamp string, order_approved_at string,
        order_delivered_carrier_date string, order_delivered_customer_date string,
        order_estimated_delivery_date string""",
    "order_items": """
        order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date string, price double, freight_value double""",
    "order_payments": """
        order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "order_reviews": """
        review_id string, order_id string, review_score string,
        review_comment_title string, review_comment_message string,
        review_creation_date string, review_answer_timestamp string""",
    "customers": """
        customer_id string, customer_unique_id string, customer_zip_code_prefix string,
        customer_city string, customer_state string""",
    "sellers": """
        seller_id string, seller_zip_code_prefix string, seller_city string,
        seller_state string""",
    "products": """
        product_id string, product_category_name string, product_name_lenght string,
        product_description_lenght string, product_photos_qty string,
        product_weight_g double, product_length_cm double, product_height_cm double,
        product_width_cm double""",
    "geolocation": """
        geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,
        geolocation_city string, geolocation_state string""",
    "category_translation": """
        product_category_name string, product_category_name_english string""",
}

# Only these hold free text that may span lines. A multi-line file is read by one task, so every
# other table keeps one record per line and stays splittable.
MULTILINE = {"order_reviews"}

# Text that staging reads as a time or a number: a row in which it is neither cannot be staged.
TIMES = {
    "orders": [
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ],
    "order_items": ["shipping_limit_date"],
    "order_reviews": ["review_creation_date", "review_answer_timestamp"],
}
NUMBERS = {
    "order_reviews": ["review_score"],
    "products": ["product_name_lenght", "product_description_lenght", "product_photos_qty"],
}

# What makes a row of a raw table one and the same when it arrives again. The first column decides the
# bucket, so all that belongs to an order lies in buckets of one number. Coordinates have no identity.
KEYS = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["order_id", "review_id"],
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "products": ["product_id"],
    "geolocation": [],
    "category_translation": ["product_category_name"],
}

ORDERS_MART = """
    order_id string, customer_id string, purchased_at timestamp_ntz, order_month timestamp_ntz,
    delivered_at timestamp_ntz, estimated_delivery_at timestamp_ntz, order_status string,
    delivery_days bigint, delay_days bigint, is_on_time boolean,
    order_revenue decimal(38,3), order_freight decimal(38,3), total_payment decimal(38,3),
    items_count bigint, recognized_revenue decimal(38,3),
    customer_city string, customer_state string, review_score int"""

SELLERS_MART = """
    seller_id string, seller_city string, seller_state string,
    total_orders bigint, total_items_sold bigint, total_revenue decimal(38,3),
    avg_revenue_per_item double, avg_delivery_days double, avg_delay_days double,
    on_time_pct double, avg_review_score double, total_reviews bigint"""


# Sums and counts that figures are made of, which can be added up over days, states and sellers.
_STATE_SUMS = """
    revenue decimal(38,3), orders bigint, paid decimal(38,3), paid_n bigint, paid_orders bigint,
    on_time bigint, known bigint, days_sum bigint, days_n bigint, score_sum bigint, score_n bigint,
    satisfied bigint"""
_SELLER_SUMS = """
    orders bigint, items bigint, revenue decimal(38,3), revenue_n bigint, on_time bigint,
    on_time_n bigint, delivery_days_sum bigint, delivery_days_n bigint, delay_days_sum bigint,
    delay_days_n bigint, review_score_sum bigint, review_score_n bigint"""
SUMS = {
    "day_states": f"order_month timestamp_ntz, day timestamp_ntz, customer_state string, {_STATE_SUMS}",
    "month_states": f"order_month timestamp_ntz, customer_state string, {_STATE_SUMS}",
    "day_sellers": f"order_month timestamp_ntz, day timestamp_ntz, seller_id string, {_SELLER_SUMS}",
    "month_sellers": f"order_month timestamp_ntz, seller_id string, {_SELLER_SUMS}",
}


# What every seller sold, one row a seller and order, and what each file of it holds: the least and the
# greatest seller, and one bit for the hash of each (see sources.marts).
SELLER_FACTS = """
    order_month timestamp_ntz, seller_id string, order_id string, purchased_at timestamp_ntz, order_status string,
    seller_revenue decimal(38,3), seller_items bigint, delivery_days bigint, delay_days bigint, is_on_time boolean,
    review_score int"""
SELLER_FILES = "order_month timestamp_ntz, file string, least string, greatest string, bits binary"
MONTHLY = SUMS | {"seller_facts": SELLER_FACTS, "seller_files": SELLER_FILES}


def raw_schema(table: str) -> StructType:
    return StructType.fromDDL(RAW[table])
