"""Display text of figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reais(x: Column) -> Column:
    """R$ 1.234,56"""
    return F.concat(F.lit("R$ "), F.translate(F.format_number(x, 2), ",.", ".,"))


def dotted(x: Column) -> Column:
    """1.234.567"""
    return F.translate(F.format_number(x, 0), ",", ".")


def fixed(x: Column, digits: int) -> Column:
    """Fixed decimals; format_number breaks ties to even, format_string would round them up."""
    return F.translate(F.format_number(x, digits), ",", "")


def with_unit(x: Column, digits: int, unit: str) -> Column:
    return F.concat(fixed(x, digits), F.lit(unit))


def seller_caption(label: Column, state: Column) -> Column:
    """1a2b3c4d... (SP)

    A missing state shows as the word None.
    """
    return F.concat(label, F.lit("... ("), F.coalesce(state, F.lit("None")), F.lit(")"))
