"""Rows that may meet a set of keys, so that the rows of a large table that cannot are not shuffled.

The keys are hashed into words of 64 bits, three bits a key, and the words are broadcast: WORDS of them at
most, whatever the number of keys. No row that meets a key is left out; some others stay, so a join with
the keys themselves has to follow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 8 MB of bits. Beyond some ten millions of keys it leaves out fewer rows; results stay.
WORDS = 1 << 20
_SHIFTS = (40, 46, 52)  # of the hash, to the numbers of the three bits


def key_hash(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"))


def _word(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(WORDS))


def _bits(hashed: Column) -> Column:
    numbers = [F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit(63)).cast("int") for shift in _SHIFTS]
    each = [F.call_function("shiftleft", F.lit(1).cast("long"), number) for number in numbers]
    return reduce(Column.bitwiseOR, each)


def sketch(hashes: DataFrame) -> DataFrame:
    """word, bits: of the column `hash`."""
    return hashes.groupBy(_word(F.col("hash")).alias("word")).agg(F.bit_or(_bits(F.col("hash"))).alias("bits"))


def sketch_of(keys: DataFrame, key: str) -> DataFrame:
    return sketch(keys.select(key_hash(key).alias("hash")))


def perhaps_among(rows: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """`rows` without those whose key is certainly not in the sketch `words`."""
    hashed = F.col("key_hash")
    met = (_word(hashed) == F.col("word")) & (F.col("bits").bitwiseAND(_bits(hashed)) == _bits(hashed))
    return rows.withColumn("key_hash", key_hash(key)).join(F.broadcast(words), met, "left_semi").drop("key_hash")


def perhaps_repeated(rows: DataFrame, key: str) -> DataFrame:
    """`rows` without those whose key is certainly in one row only. Of all rows only hashes and counts are shuffled."""
    counted = rows.groupBy(key_hash(key).alias("hash")).agg(F.count("*").alias("n")).filter("n > 1")
    return perhaps_among(rows, key, sketch(counted))
