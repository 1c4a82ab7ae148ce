"""Sums and counts a day, from which every figure of a range of days follows without its orders.

All columns add up exactly over days, states and sellers (money is decimal, the rest are integers), so a
range is whole months and the days at its edges. Means and percentages are made after the sums.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.dates import NTZ, closed_months, day, month_label
from vitrine.functions.fixed_values import INCOMPLETE_YEARS, SATISFIED_FROM
from vitrine.functions.numeric import MONEY_SUM, half_away, money_sum, percent, ratio
from vitrine.operators import kpis
from vitrine.operators.sellers_mart import TOTALS, seller_totals

SUMS = [
    "revenue", "orders", "paid", "paid_n", "paid_orders", "on_time", "known", "days_sum", "days_n",
    "score_sum", "score_n", "satisfied",
]


def day_of(mart: DataFrame) -> DataFrame:
    """The mart with the day of purchase."""
    return mart.withColumn("day", F.col("purchased_at").cast("date").cast(NTZ))


def day_states(mart: DataFrame) -> DataFrame:
    """order_month, day, customer_state and SUMS. A few dozen states a day, however many orders."""
    amount, on_time, score = F.col("recognized_revenue"), F.col("is_on_time"), F.col("review_score")
    paid = F.when(amount > 0, amount)
    days = F.when(on_time.isNotNull(), F.col("delivery_days"))
    zero = F.lit(0).cast("long")
    return (
        day_of(mart)
        .groupBy("order_month", "day", "customer_state")
        .agg(
            money_sum(amount).alias("revenue"),
            F.count("order_id").alias("orders"),
            money_sum(F.coalesce(paid, F.lit(0).cast(MONEY_SUM))).alias("paid"),
            F.count(paid).alias("paid_n"),
            F.count(F.when(amount > 0, F.col("order_id"))).alias("paid_orders"),
            F.coalesce(F.sum(on_time.cast("long")), zero).alias("on_time"),
            F.count(on_time).alias("known"),
            F.coalesce(F.sum(days), zero).alias("days_sum"),
            F.count(days).alias("days_n"),
            F.coalesce(F.sum(score.cast("long")), zero).alias("score_sum"),
            F.count(score).alias("score_n"),
            F.count(F.when(score >= SATISFIED_FROM, 1)).alias("satisfied"),
        )
    )


def _summed(sums: DataFrame, by: list[str]) -> DataFrame:
    kinds = dict(sums.dtypes)
    return sums.groupBy(*by).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in SUMS])


def month_states(days: DataFrame) -> DataFrame:
    return _summed(days, ["order_month", "customer_state"])


def day_sellers(rollup: DataFrame) -> DataFrame:
    """order_month, day, seller_id and the sellers' totals, from seller_orders by day."""
    return seller_totals(rollup, ["order_month", "day", "seller_id"])


def month_sellers(days: DataFrame) -> DataFrame:
    return added_totals(days, ["order_month", "seller_id"])


def added_totals(totals: DataFrame, by: list[str]) -> DataFrame:
    """Sellers' totals summed over what `by` leaves out."""
    kinds = dict(totals.dtypes)
    return totals.groupBy(*by).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in TOTALS])


# --- ranges


def edges(first: dt.date, last: dt.date) -> tuple[dt.date, dt.date]:
    """The first whole month and the first month after the whole ones, as first days. Equal if there is none."""
    after = (last + dt.timedelta(days=1)).replace(day=1)
    start = first if first.day == 1 else (first.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return start, max(start, after)


def in_range(months: DataFrame, days: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Whole months from the one table, the days at the edges from the other; the day is gone."""
    start, after = edges(first, last)
    month, of_day = F.col("order_month"), F.col("day")
    whole = months.filter((month >= day(start)) & (month < day(after)))
    # bounds on the month too: they prune its partitions
    inside = (of_day >= day(first)) & (of_day <= day(last)) & (month >= day(first.replace(day=1))) & (month <= day(last))
    rest = days.filter(inside & ~((month >= day(start)) & (month < day(after)))).drop("day")
    return whole.unionByName(rest.select(whole.columns))


# --- figures


def board(sums: DataFrame, as_of: dt.date | None = None, exclude_years=INCOMPLETE_YEARS) -> DataFrame:
    """One row a closed month with all monthly figures, and whether it has deliveries and reviews."""
    closed = _summed(sums.filter(closed_months(F.col("order_month"), as_of, exclude_years)), ["order_month"])
    thousand = F.lit(1000)
    return closed.select(
        month_label(F.col("order_month")).alias("month"),
        "revenue",
        "orders",
        ratio(F.col("paid") * thousand, F.col("paid_n") * thousand).alias("aov"),
        percent(F.col("on_time"), F.col("known"), 1).alias("on_time_pct"),
        half_away(ratio(F.col("days_sum"), F.col("days_n")), 1).alias("avg_days"),
        half_away(ratio(F.col("score_sum"), F.col("score_n")), 2).alias("avg_score"),
        percent(F.col("satisfied"), F.col("score_n"), 1).alias("csat_pct"),
        (F.col("known") > 0).alias("has_delivery"),
        (F.col("score_n") > 0).alias("has_review"),
    )


def monthly_revenue(sums: DataFrame, **window) -> DataFrame:
    return board(sums, **window).select("month", "revenue", "orders", "aov").orderBy("month")


def monthly_delivery(sums: DataFrame, **window) -> DataFrame:
    return board(sums, **window).filter("has_delivery").select("month", "on_time_pct", "avg_days").orderBy("month")


def monthly_reviews(sums: DataFrame, **window) -> DataFrame:
    return board(sums, **window).filter("has_review").select("month", "avg_score", "csat_pct").orderBy("month")


def orders_headline(sums: DataFrame, **window) -> DataFrame:
    return kpis.headline(board(sums, **window))


def state_revenue(sums: DataFrame) -> DataFrame:
    return (
        _summed(sums, ["customer_state"])
        .filter(F.col("paid_n") > 0)
        .select("customer_state", F.col("paid").alias("revenue"), F.col("paid_orders").alias("orders"))
    )
