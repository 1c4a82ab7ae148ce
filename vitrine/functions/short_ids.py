"""Ids as bytes, for shuffles: text of hexadecimal digits is half as long so, and it hardly compresses otherwise.

Any text may be an id. Lower-case hexadecimal text of 16, 32, 48 ... digits becomes its bytes, whose number is a
multiple of eight; all other text keeps its own bytes and gets one or two marks, so that their number never is. So no
two ids have the same bytes, and each is read back as it was. A missing id stays missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDS = ("order_id", "customer_id", "seller_id")
_UNIT = 8


def short_id(text: Column) -> Column:
    digits, own = F.unhex(text), text.cast("binary")
    whole = digits.isNotNull() & (F.octet_length(text) % (2 * _UNIT) == 0) & (F.lower(text) == text)
    one, two = (F.concat(own, F.lit(bytes([n]) * n)) for n in (1, 2))
    return F.when(whole, digits).when(F.octet_length(own) % _UNIT == _UNIT - 1, two).otherwise(one)


def long_id(short: Column) -> Column:
    marks = F.when(F.substring(short, -1, 1) == F.lit(b"\x01"), 1).otherwise(2)
    own = F.substring(short, F.lit(1), F.octet_length(short) - marks).cast("string")
    return F.when(F.octet_length(short) % _UNIT == 0, F.lower(F.hex(short))).otherwise(own)


def short_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({c: short_id(F.col(c)) for c, kind in df.dtypes if c in IDS and kind == "string"})


def long_ids(df: DataFrame) -> DataFrame:
    return df.withColumns({c: long_id(F.col(c)) for c, kind in df.dtypes if c in IDS and kind == "binary"})
