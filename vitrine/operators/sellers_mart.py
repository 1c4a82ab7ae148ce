"""Sellers mart: one row a seller, over the delivered orders of the orders mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.numeric import MONEY_SUM, half_away, money_or_zero, money_sum, percent, ratio


def seller_orders(items: DataFrame, orders_mart: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row a seller and delivered order; `by` adds columns of the order.

    Both sides are collapsed before they meet, so no key is hot in the join: an order with very
    many items arrives as one row a seller, and copies of an order in the mart arrive as one row
    with their number, by which the sums are then multiplied.
    """
    sold = items.groupBy("seller_id", "order_id").agg(
        F.sum("item_price").alias("price"), F.count("order_item_id").alias("items")
    )
    delivered = (
        orders_mart.filter(F.col("order_status") == "delivered")
        .groupBy("order_id", *by)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.max("delivery_days").alias("delivery_days"),
            F.max("delay_days").alias("delay_days"),
            F.max(F.col("is_on_time").cast("int")).alias("is_on_time"),
            F.max("review_score").alias("review_score"),
        )
    )
    return sold.join(delivered, "order_id").select(
        "seller_id",
        "order_id",
        *by,
        (F.col("price") * F.col("copies")).cast(MONEY_SUM).alias("order_revenue"),
        (F.col("items") * F.col("copies")).alias("items_count"),
        "delivery_days",
        "delay_days",
        "is_on_time",
        "review_score",
    )


def seller_orders_of(facts: DataFrame, by: tuple[str, ...] = (), copies: bool = True) -> DataFrame:
    """seller_orders of stored facts, one row a seller and copy of an order; `by` must hold the day.

    The one shuffle, by ranges of seller and `by`, serves the sums over these too, and rows of one month stay
    together for the table that is written of them. A large seller is spread over their days. `copies`: not where
    ids of orders are known to be unique: each fact is an order then, and in place of its id only a mark is shuffled.
    """
    own = facts.filter(F.col("order_status") == "delivered")
    ranges = [*by[:1], "seller_id", *by[1:]]
    if not copies:
        return own.select(
            "seller_id",
            F.when(F.col("order_id").isNotNull(), F.lit("")).alias("order_id"),
            *by,
            F.col("seller_revenue").cast(MONEY_SUM).alias("order_revenue"),
            F.col("seller_items").alias("items_count"),
            "delivery_days",
            "delay_days",
            F.col("is_on_time").cast("int").alias("is_on_time"),
            "review_score",
        ).repartitionByRange(*ranges)
    own = own.repartitionByRange(*ranges)
    return own.groupBy("seller_id", "order_id", *by).agg(
        F.sum("seller_revenue").cast(MONEY_SUM).alias("order_revenue"),
        F.sum("seller_items").alias("items_count"),
        F.max("delivery_days").alias("delivery_days"),
        F.max("delay_days").alias("delay_days"),
        F.max(F.col("is_on_time").cast("int")).alias("is_on_time"),
        F.max("review_score").alias("review_score"),
    )


# averaged columns of seller_orders: a total and a count each, so that they can be summed twice
_AVERAGED = ["delivery_days", "delay_days", "review_score"]


#: The columns of seller_totals besides what they are grouped by.
TOTALS = [
    "orders",
    "items",
    "revenue",
    "revenue_n",
    "on_time",
    "on_time_n",
    *[f"{c}_{kind}" for c in _AVERAGED for kind in ("sum", "n")],
]


def seller_totals(rollup: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row a seller (or group) of sums and counts, which add up over any parts of the roll-up.

    How many values a sum has is kept with it, so that what no row brings is known to be missing.
    """

    def total(column: str) -> Column:
        return F.coalesce(F.sum(F.col(column).cast("long")), F.lit(0).cast("long"))

    return rollup.groupBy(*(by or ["seller_id"])).agg(
        F.count("order_id").alias("orders"),
        F.sum("items_count").alias("items"),
        F.coalesce(money_sum("order_revenue"), F.lit(0)).cast(MONEY_SUM).alias("revenue"),
        F.count("order_revenue").alias("revenue_n"),
        total("is_on_time").alias("on_time"),
        F.count("is_on_time").alias("on_time_n"),
        *[c for name in _AVERAGED for c in (total(name).alias(f"{name}_sum"), F.count(name).alias(f"{name}_n"))],
    )


def changed_totals(totals: DataFrame, gone: DataFrame, come: DataFrame) -> DataFrame:
    """Totals after some rows of the roll-up are gone and others have come. Groups without a row drop out."""
    by = [c for c in totals.columns if c not in TOTALS]
    less = gone.select(*by, *[(-F.col(c)).alias(c) for c in TOTALS])
    kinds = dict(totals.dtypes)
    return (
        totals.unionByName(less)
        .unionByName(come)
        .groupBy(*by)
        .agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in TOTALS])
        .filter(F.col("orders") > 0)
    )


def sellers_mart(sellers: DataFrame, rollup: DataFrame) -> DataFrame:
    """Every seller, also those without a delivered order.

    The roll-up is summed to one row a seller before the join: the shuffle then carries partial
    sums, and a seller with a third of all orders weighs no more than any other.
    """
    return sellers_from_totals(sellers, seller_totals(rollup))


def sellers_from_totals(sellers: DataFrame, totals: DataFrame) -> DataFrame:
    """`sellers` as staged; the totals of no seller are left out."""
    places = sellers.select(
        "seller_id", F.col("city").alias("seller_city"), F.col("state").alias("seller_state")
    )
    # summed again, as a seller listed twice with one place is one row of doubled totals
    summed = [c for c in totals.columns if c != "seller_id"]
    joined = (
        places.join(totals, "seller_id", "left")
        .groupBy("seller_id", "seller_city", "seller_state")
        .agg(*[F.sum(c).alias(c) for c in summed])
    )

    known = {"revenue": "revenue_n", "on_time": "on_time_n"}
    joined = joined.withColumns({c: F.when(F.col(n) > 0, F.col(c)) for c, n in known.items()})

    def mean(column: str) -> Column:
        return ratio(F.col(f"{column}_sum"), F.col(f"{column}_n"))

    return joined.select(
        "seller_id",
        "seller_city",
        "seller_state",
        F.coalesce("orders", F.lit(0).cast("long")).alias("total_orders"),
        F.coalesce("items", F.lit(0).cast("long")).alias("total_items_sold"),
        money_or_zero("revenue").alias("total_revenue"),
        ratio(F.col("revenue"), F.col("items")).alias("avg_revenue_per_item"),
        half_away(mean("delivery_days"), 1).alias("avg_delivery_days"),
        half_away(mean("delay_days"), 1).alias("avg_delay_days"),
        # all delivered orders, also those whose punctuality is unknown
        percent(F.col("on_time"), F.col("orders"), 2).alias("on_time_pct"),
        half_away(mean("review_score"), 2).alias("avg_review_score"),
        F.coalesce("review_score_n", F.lit(0).cast("long")).alias("total_reviews"),
    )
