"""Data quality: key tests and the grain audit. Counts only; no row reaches the driver."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.fixed_values import GRAIN_AUDIT, KEY_TESTS

Dataset = Callable[[str], DataFrame]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _group_sizes(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def result_row(dataset: str, column: str, test: Column | str, failures: Column) -> list[Column]:
    return [
        F.lit(dataset).alias("dataset"),
        F.lit(column).alias("column"),
        (F.lit(test) if isinstance(test, str) else test).alias("test"),
        failures.alias("failures"),
        (failures == 0).alias("passed"),
    ]


def unique_test(df: DataFrame, dataset: str, column: str) -> DataFrame:
    """Failures: values that occur more than once. Null is not a value here."""
    sizes = _group_sizes(df.filter(F.col(column).isNotNull()), [column])
    counted = sizes.agg(F.count_if(F.col("n") > 1).alias("failures"))
    return counted.select(*result_row(dataset, column, "unique", F.col("failures")))


def not_null_test(df: DataFrame, dataset: str, column: str) -> DataFrame:
    """Failures: rows without a value."""
    counted = df.agg(F.count_if(F.col(column).isNull()).alias("failures"))
    return counted.select(*result_row(dataset, column, "not_null", F.col("failures")))


def key_tests(df: DataFrame, dataset: str, column: str) -> DataFrame:
    """Both tests from one grouping of the key, instead of two passes over the dataset."""
    key, n = F.col(column), F.col("n")
    counted = _group_sizes(df, [column]).agg(
        F.count_if(key.isNotNull() & (n > 1)).alias("repeated"),
        F.coalesce(F.sum(F.when(key.isNull(), n)), F.lit(0).cast("long")).alias("missing"),
    )
    outcome = F.inline(
        F.array(
            F.struct(F.lit("unique").alias("test"), F.col("repeated").alias("failures")),
            F.struct(F.lit("not_null").alias("test"), F.col("missing").alias("failures")),
        )
    )
    return counted.select(outcome).select(
        *result_row(dataset, column, F.col("test"), F.col("failures"))
    )


def run_tests(
    dataset: Dataset,
    test: Callable[[DataFrame, str, str], DataFrame],
    keys: list[tuple[str, str]] = KEY_TESTS,
) -> DataFrame:
    """One job for all keys."""
    return union_all([test(dataset(name), name, column) for name, column in keys])


def granularity_audit(raw: Dataset) -> DataFrame:
    """For each raw table, how many key groups hold more than one row. Null keys form a group."""
    return union_all(
        [
            _group_sizes(raw(table), keys)
            .agg(F.count_if(F.col("n") > 1).alias("duplicate_count"))
            .select(F.lit(label).alias("table_name"), "duplicate_count")
            for table, label, keys in GRAIN_AUDIT
        ]
    )
