"""Staging: standard names, explicit types, one row a postal prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.dates import NTZ
from vitrine.functions.numeric import MONEY, whole_number


def _moment(raw: str, name: str) -> Column:
    return F.col(raw).cast(NTZ).alias(name)


def _money(raw: str, name: str) -> Column:
    return F.col(raw).cast(MONEY).alias(name)


def orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        "order_status",
        _moment("order_purchase_timestamp", "order_purchase_at"),
        _moment("order_approved_at", "order_approved_at"),
        _moment("order_delivered_carrier_date", "order_delivered_carrier_at"),
        _moment("order_delivered_customer_date", "order_delivered_customer_at"),
        _moment("order_estimated_delivery_date", "order_estimated_delivery_at"),
    )


def order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        _moment("shipping_limit_date", "shipping_limit_at"),
        _money("price", "item_price"),
        _money("freight_value", "freight_value"),
    )


def order_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        _money("payment_value", "payment_value"),
    )


def order_reviews(raw: DataFrame) -> DataFrame:
    """Keeps repeated review ids: which score counts is decided in the mart."""
    return raw.select(
        "review_id",
        "order_id",
        F.col("review_score").cast("int").alias("review_score"),
        "review_comment_title",
        "review_comment_message",
        _moment("review_creation_date", "review_created_at"),
        _moment("review_answer_timestamp", "review_answered_at"),
    )


def customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        F.col("customer_city").alias("city"),
        F.col("customer_state").alias("state"),
    )


def sellers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        F.col("seller_city").alias("city"),
        F.col("seller_state").alias("state"),
    )


def products(raw: DataFrame) -> DataFrame:
    return raw.select(
        "product_id",
        "product_category_name",
        whole_number("product_name_lenght").alias("product_name_length"),
        whole_number("product_description_lenght").alias("product_description_length"),
        whole_number("product_photos_qty").alias("product_photos_qty"),
        _money("product_weight_g", "product_weight_g"),
        _money("product_length_cm", "product_length_cm"),
        _money("product_height_cm", "product_height_cm"),
        _money("product_width_cm", "product_width_cm"),
    )


def category_translation(raw: DataFrame) -> DataFrame:
    return raw.select("product_category_name", "product_category_name_english")


def geolocation(raw: DataFrame) -> DataFrame:
    """One coordinate a postal prefix: the least by latitude, longitude, city, state.

    A min over the whole row combines on the map side, so a prefix that holds a third of the
    rows sends one row a task to the shuffle.
    """
    row = F.struct("geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state")
    first = raw.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.min(row).alias("kept")
    )
    return first.select(
        "zip_code_prefix",
        F.col("kept.geolocation_lat").alias("latitude"),
        F.col("kept.geolocation_lng").alias("longitude"),
        F.col("kept.geolocation_city").alias("city"),
        F.col("kept.geolocation_state").alias("state"),
    )
