"""Orders mart: one row an order, with every one-to-many relation collapsed before it is joined."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.dates import calendar_days, month_start
from vitrine.functions.fixed_values import UNRECOGNIZED_STATUSES
from vitrine.functions.numeric import MONEY_SUM, money_or_zero, money_sum


def item_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(*_totals("items"))


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(*_totals("payments"))


def best_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(*_totals("reviews"))


def delivery_columns(
    bought: str = "order_purchase_at",
    delivered: str = "order_delivered_customer_at",
    promised: str = "order_estimated_delivery_at",
) -> list[Column]:
    """Days count midnights while punctuality compares full timestamps.

    An order delivered in the course of the promised day thus has no delay and is not on time.
    All three are null when a date they need is missing, so orders in transit are not late.
    """
    bought, delivered, promised = F.col(bought), F.col(delivered), F.col(promised)
    overdue = calendar_days(promised, delivered)
    return [
        calendar_days(bought, delivered).alias("delivery_days"),
        # greatest() skips nulls, hence the guard
        F.when(overdue.isNotNull(), F.greatest(overdue, F.lit(0).cast("long"))).alias("delay_days"),
        (delivered <= promised).alias("is_on_time"),
    ]


def delivery_metrics(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", *delivery_columns())


def recognized(payment: Column) -> Column:
    """Payment, or zero for an order that was called off. An unknown status counts."""
    called_off = F.col("order_status").isin(UNRECOGNIZED_STATUSES)
    return (
        F.when(called_off, F.lit(0).cast(MONEY_SUM))
        .otherwise(F.coalesce(payment, F.lit(0)).cast(MONEY_SUM))
        .alias("recognized_revenue")
    )


def recognized_revenue(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return with_totals(orders, payments=payments).select(
        "order_id", "order_status", recognized(F.col("total_payment"))
    )


# what each table is read for
_SUMMED = {
    "items": ["item_price", "freight_value", "order_item_id"],
    "payments": ["payment_value"],
    "reviews": ["review_score"],
}


def _totals(name: str) -> list[Column]:
    if name == "items":
        return [
            money_sum("item_price").alias("order_revenue"),
            money_sum("freight_value").alias("order_freight"),
            F.count("order_item_id").alias("items_count"),
        ]
    if name == "payments":
        return [money_sum("payment_value").alias("total_payment")]
    return [F.max("review_score").alias("review_score")]


def plain_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """`df` with `key` as a new column `name` that is not known to be what it is partitioned by.

    A join on it then has a plain shuffle on this side too, which is the form in which adaptive
    execution splits a hot key of the other side.
    """
    nothing = b"" if dict(df.dtypes)[key] == "binary" else ""
    return df.withColumn(name, F.concat(F.col(key), F.lit(nothing))).drop(key)


def order_totals(**parts: DataFrame) -> DataFrame:
    """One row an order id with the totals of items, payments and reviews, of those that are given.

    The tables are stacked before they are summed, so that one shuffle of partial sums serves all.
    """
    stacked = [df.select("order_id", *_SUMMED[name]) for name, df in parts.items()]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    sums = [column for name in parts for column in _totals(name)]
    return rows.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(*sums)


def with_totals(orders: DataFrame, **parts: DataFrame) -> DataFrame:
    """Every row of `orders` with the totals of its id.

    One join, with a plain shuffle on either side, so copies of an id are split however many there
    are. Orders without an id match nothing and are not joined at all.
    """
    if not parts:
        return orders
    totals = plain_key(order_totals(**parts), "order_id", "totals_of")
    known = orders.filter(F.col("order_id").isNotNull())
    known = known.join(totals, F.col("order_id") == F.col("totals_of"), "left").drop("totals_of")
    missing = [F.lit(None).cast(t).alias(c) for c, t in known.dtypes if c not in orders.columns]
    return known.unionByName(orders.filter(F.col("order_id").isNull()).select("*", *missing))


_DERIVED = ["delivery_days", "delay_days", "is_on_time", "recognized_revenue"]


def underived(mart: DataFrame) -> DataFrame:
    """The whole mart without what `derived` adds again, for a shuffle."""
    return mart.drop(*_DERIVED)


def derived(mart: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of the whole mart, of which some are computed from the others."""
    days = delivery_columns("purchased_at", "delivered_at", "estimated_delivery_at")
    return mart.select("*", *days, recognized(F.col("total_payment"))).select(*columns)


def orders_mart(orders: DataFrame, customers: DataFrame, **parts: DataFrame) -> DataFrame:
    """The orders mart with the columns that the given `parts` (items, payments, reviews) fill.

    Left joins only, so each order stays exactly once while the key of `customers` is unique.
    Customers come first, as orders are narrow then; their join keeps a shuffle on either side, which
    is the form in which adaptive execution splits a customer with very many orders.
    """
    places = customers.select(
        "customer_id",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
    )
    items, payments, count, revenue, reviews = [], [], [], [], []
    if "items" in parts:
        items = [money_or_zero(c).alias(c) for c in ("order_revenue", "order_freight")]
        count = [F.coalesce("items_count", F.lit(0).cast("long")).alias("items_count")]
    if "payments" in parts:
        payments = [money_or_zero("total_payment").alias("total_payment")]
        revenue = [recognized(F.col("total_payment"))]
    if "reviews" in parts:
        reviews = [F.col("review_score")]
    return (
        with_totals(orders.join(places, "customer_id", "left"), **parts)
        .select(
            "order_id",
            "customer_id",
            F.col("order_purchase_at").alias("purchased_at"),
            month_start(F.col("order_purchase_at")).alias("order_month"),
            F.col("order_delivered_customer_at").alias("delivered_at"),
            F.col("order_estimated_delivery_at").alias("estimated_delivery_at"),
            "order_status",
            *delivery_columns(),
            *items,
            *payments,
            *count,
            *revenue,
            "customer_city",
            "customer_state",
            *reviews,
        )
    )
