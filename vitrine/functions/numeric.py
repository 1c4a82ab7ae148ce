"""Money, ratios and rounding with the number semantics the published figures were made with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,3)"
MONEY_SUM = "decimal(38,3)"


def money_sum(column: str | Column) -> Column:
    """Exact total; a decimal sum does not depend on the order in which tasks finish."""
    return F.sum(column).cast(MONEY_SUM)


def money_or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast(MONEY_SUM)


def half_away(x: Column, digits: int) -> Column:
    """Scale, round, scale back, all on doubles.

    Spark's own round(double, n) rounds the printed decimal (1.005 -> 1.01); the published
    figures round the scaled binary value (1.005 -> 1.0).
    """
    scale = float(10**digits)
    return F.round(x.cast("double") * F.lit(scale), 0) / F.lit(scale)


def ratio(top: Column, bottom: Column) -> Column:
    """Double quotient, null for a zero denominator (ANSI mode would raise)."""
    return top.cast("double") / F.nullif(bottom, F.lit(0)).cast("double")


def money_mean(amount: Column) -> Column:
    """Mean of a money column as a double, rounded once.

    Dividing the thousandths by the thousandfold count has a single rounding; turning the total
    into a double first would round twice and differ in the last digit.
    """
    thousand = F.lit(1000)
    return ratio(F.sum(amount) * thousand, F.count(amount) * thousand)


def percent(part: Column, whole: Column, digits: int) -> Column:
    top = F.lit(100.0) * part.cast("double")
    return half_away(top / F.nullif(whole, F.lit(0)).cast("double"), digits)


def python_round(x: Column, digits: int) -> Column:
    """Round a double as Python does: ties of the exact binary value go to even."""
    return F.translate(F.format_number(x, digits), ",", "").cast("double")


def whole_number(text: str) -> Column:
    """Integer from text that may carry a fraction ('5.0'), halves away from zero."""
    return F.round(F.col(text).cast("double")).cast("int")
