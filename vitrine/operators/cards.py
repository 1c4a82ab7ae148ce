"""Presentation datasets: the card texts and the chart payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.numeric import python_round
from vitrine.functions.text import dotted, reais, seller_caption, with_unit


def kpi_cards(orders_headline: DataFrame, sellers_headline: DataFrame) -> DataFrame:
    """One row of display texts.

    The two one-row headlines are laid over each other (each leaves the other's columns null, max
    keeps the value), so that both marts' stages run side by side in one job, without a join.
    """
    both = orders_headline.unionByName(sellers_headline, allowMissingColumns=True)
    row = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return row.select(
        reais(F.col("total_revenue")).alias("kpi_revenue"),
        dotted(F.col("total_orders")).alias("kpi_orders"),
        reais(F.col("aov")).alias("kpi_aov"),
        with_unit(F.col("on_time_pct"), 1, "%").alias("kpi_on_time"),
        with_unit(F.col("avg_delivery_days"), 1, " days").alias("kpi_avg_delivery"),
        with_unit(F.col("avg_score"), 2, " / 5").alias("kpi_avg_score"),
        with_unit(F.col("csat_pct"), 1, "%").alias("kpi_csat"),
        reais(F.col("top_seller_revenue")).alias("kpi_top_seller_rev"),
        F.format_number("active_sellers", 0).alias("kpi_active_sellers"),
    )


def _cents(column: str) -> Column:
    return F.coalesce(F.bround(column, 2).cast("double"), F.lit(0.0))


def revenue_chart(revenue: DataFrame) -> DataFrame:
    return revenue.select("month", _cents("revenue").alias("revenue"))


def sellers_chart(top: DataFrame) -> DataFrame:
    def shown(column: str, digits: int) -> Column:
        return python_round(F.coalesce(F.col(column), F.lit(0.0)), digits)

    return top.select(
        seller_caption(F.col("seller_label"), F.col("seller_state")).alias("seller"),
        _cents("total_revenue").alias("revenue"),
        shown("avg_review_score", 2).alias("score"),
        shown("on_time_pct", 1).alias("on_time"),
    )
