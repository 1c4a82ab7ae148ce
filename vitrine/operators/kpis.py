"""Executive figures over the two marts: monthly series, rankings, places, headlines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.dates import closed_months, month_label
from vitrine.functions.fixed_values import INCOMPLETE_YEARS, SATISFIED_FROM
from vitrine.functions.numeric import MONEY_SUM, half_away, money_mean, money_sum, percent, ratio

Years = Iterable[int]


# --- aggregates of one month -------------------------------------------------------------------


def revenue_aggregates() -> list[Column]:
    amount = F.col("recognized_revenue")
    return [
        money_sum(amount).alias("revenue"),
        F.count("order_id").alias("orders"),
        money_mean(F.when(amount > 0, amount)).alias("aov"),
    ]


def punctuality_aggregates() -> list[Column]:
    """Over orders whose punctuality is known, whether or not the rows were filtered to them."""
    on_time = F.col("is_on_time")
    days = F.when(on_time.isNotNull(), F.col("delivery_days"))
    return [
        percent(F.sum(on_time.cast("int")), F.count(on_time), 1).alias("on_time_pct"),
        half_away(ratio(F.sum(days), F.count(days)), 1).alias("avg_days"),
    ]


def satisfaction_aggregates() -> list[Column]:
    score = F.col("review_score")
    satisfied = F.count(F.when(score >= SATISFIED_FROM, 1))
    return [
        half_away(ratio(F.sum(score), F.count(score)), 2).alias("avg_score"),
        percent(satisfied, F.count(score), 1).alias("csat_pct"),
    ]


# --- monthly series ----------------------------------------------------------------------------


def by_month(
    rows: DataFrame, aggregates: list[Column], as_of: dt.date | None, exclude_years: Years
) -> DataFrame:
    """Grouped by the 8-byte month; its text is made once a group. A year holds twelve rows, so
    the closing sort is over a small result."""
    return (
        rows.filter(closed_months(F.col("order_month"), as_of, exclude_years))
        .groupBy("order_month")
        .agg(*aggregates)
        .withColumnRenamed("order_month", "month")
        .withColumn("month", month_label(F.col("month")))
        .orderBy("month")
    )


def monthly_revenue(
    mart: DataFrame, as_of: dt.date | None = None, exclude_years: Years = INCOMPLETE_YEARS
) -> DataFrame:
    return by_month(mart, revenue_aggregates(), as_of, exclude_years)


def monthly_delivery(
    mart: DataFrame, as_of: dt.date | None = None, exclude_years: Years = INCOMPLETE_YEARS
) -> DataFrame:
    known = mart.filter(F.col("is_on_time").isNotNull())
    return by_month(known, punctuality_aggregates(), as_of, exclude_years)


def monthly_reviews(
    mart: DataFrame, as_of: dt.date | None = None, exclude_years: Years = INCOMPLETE_YEARS
) -> DataFrame:
    reviewed = mart.filter(F.col("review_score").isNotNull())
    return by_month(reviewed, satisfaction_aggregates(), as_of, exclude_years)


def monthly_review_volume(
    mart: DataFrame, as_of: dt.date | None = None, exclude_years: Years = INCOMPLETE_YEARS
) -> DataFrame:
    reviewed = mart.filter(F.col("review_score").isNotNull())
    return by_month(reviewed, [F.count("review_score").alias("reviews")], as_of, exclude_years)


def monthly_delay(
    mart: DataFrame, as_of: dt.date | None = None, exclude_years: Years = INCOMPLETE_YEARS
) -> DataFrame:
    known = mart.filter(F.col("is_on_time").isNotNull())
    delay = ratio(F.sum("delay_days"), F.count("delay_days"))
    mean = half_away(delay, 1).alias("avg_delay_days")
    return by_month(known, [mean], as_of, exclude_years)


# --- sellers and places ------------------------------------------------------------------------


def leaders(mart: DataFrame, n: int) -> DataFrame:
    """The n sellers with most revenue. Equal revenue is ordered by id."""
    return (
        mart.filter(F.col("total_revenue") > 0)
        .orderBy(F.col("total_revenue").desc(), F.col("seller_id"))
        .limit(n)
    )


def top_sellers(mart: DataFrame, n: int = 10) -> DataFrame:
    return leaders(mart, n).select(
        F.substring("seller_id", 1, 8).alias("seller_label"),
        "seller_state",
        "total_revenue",
        "avg_review_score",
        "on_time_pct",
        "total_orders",
    )


def state_revenue(mart: DataFrame) -> DataFrame:
    """All months count here, also the open one."""
    return (
        mart.filter(F.col("recognized_revenue") > 0)
        .groupBy("customer_state")
        .agg(
            money_sum("recognized_revenue").alias("revenue"),
            F.count("order_id").alias("orders"),
        )
    )


def state_revenue_map(states: DataFrame, centres: DataFrame) -> DataFrame:
    """Revenue of the states that have a centre. The centres are 27 fixed rows."""
    named = states.withColumnRenamed("customer_state", "state")
    return named.join(F.broadcast(centres), "state").select(
        "state",
        F.bround("revenue", 2).cast("double").alias("revenue"),
        "orders",
        "lat",
        "lon",
    )


# --- headline figures --------------------------------------------------------------------------


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def _plain_mean(column: str, digits: int, rows: Column | None = None) -> Column:
    """Unweighted mean of monthly figures that were rounded to `digits`.

    A null month counts as zero, no month at all gives zero. The sum is taken on decimals, which
    hold the rounded figures exactly, so that the result does not depend on summation order.
    """
    value = F.coalesce(F.col(column), F.lit(0.0)).cast(f"decimal(18,{digits})")
    if rows is not None:
        value = F.when(rows, value)
    return F.coalesce(ratio(F.sum(value), F.count(value)), F.lit(0.0))


def _finance() -> list[Column]:
    return [
        _total("revenue").cast(MONEY_SUM).alias("total_revenue"),
        _total("orders").cast("long").alias("total_orders"),
        F.coalesce(ratio(F.sum("revenue"), F.sum("orders")), F.lit(0.0)).alias("aov"),
    ]


def finance_headline(revenue: DataFrame) -> DataFrame:
    """All recognized revenue over all orders, those that brought none included."""
    return revenue.agg(*_finance())


def delivery_headline(delivery: DataFrame) -> DataFrame:
    return delivery.agg(
        _plain_mean("on_time_pct", 1).alias("on_time_pct"),
        _plain_mean("avg_days", 1).alias("avg_delivery_days"),
    )


def satisfaction_headline(reviews: DataFrame) -> DataFrame:
    return reviews.agg(
        _plain_mean("avg_score", 2).alias("avg_score"),
        _plain_mean("csat_pct", 1).alias("csat_pct"),
    )


def _best_revenue() -> Column:
    revenue = F.col("total_revenue")
    best = F.max(F.when(revenue > 0, revenue))
    return F.coalesce(best, F.lit(0)).cast(MONEY_SUM).alias("top_seller_revenue")


def _active() -> Column:
    return F.count_if(F.col("total_orders") > 0).alias("active_sellers")


def top_seller_headline(sellers_mart: DataFrame) -> DataFrame:
    """Revenue of the first of the top sellers; zero without one."""
    return sellers_mart.agg(_best_revenue())


def active_sellers_headline(sellers_mart: DataFrame) -> DataFrame:
    return sellers_mart.agg(_active())


def sellers_headline(sellers_mart: DataFrame) -> DataFrame:
    return sellers_mart.agg(_best_revenue(), _active())


def orders_headline(
    mart: DataFrame, as_of: dt.date | None = None, exclude_years: Years = INCOMPLETE_YEARS
) -> DataFrame:
    """Finance, delivery and satisfaction headlines in one pass over the mart.

    A month without a known punctuality or without a review is no row of that series, so it is
    left out of that mean.
    """
    board = by_month(
        mart,
        [
            *revenue_aggregates(),
            *punctuality_aggregates(),
            *satisfaction_aggregates(),
            (F.count("is_on_time") > 0).alias("has_delivery"),
            (F.count("review_score") > 0).alias("has_review"),
        ],
        as_of,
        exclude_years,
    )
    return headline(board)


def headline(board: DataFrame) -> DataFrame:
    """The headlines from one row a month."""
    delivered, reviewed = F.col("has_delivery"), F.col("has_review")
    return board.agg(
        *_finance(),
        _plain_mean("on_time_pct", 1, delivered).alias("on_time_pct"),
        _plain_mean("avg_days", 1, delivered).alias("avg_delivery_days"),
        _plain_mean("avg_score", 2, reviewed).alias("avg_score"),
        _plain_mean("csat_pct", 1, reviewed).alias("csat_pct"),
    )
