"""Raw layer: CSV ingest and named table scans."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.fixed_values import RAW_FILES
from vitrine.sources import quarantine
from vitrine.sources.keyed import KeyedTable
from vitrine.sources.schemas import MULTILINE, raw_schema

RawReader = Callable[[str], DataFrame]


def csv_options(table: str) -> dict[str, str]:
    return {
        "header": "true",
        "encoding": "UTF-8",
        "quote": '"',
        "escape": '"',
        "multiLine": str(table in MULTILINE).lower(),
        # a header that differs from the declared columns is an error, not a silent shift
        "enforceSchema": "false",
        "mode": "FAILFAST",
    }


def blank_to_null(df: DataFrame) -> DataFrame:
    """A field of quoted nothing is as missing as one without quotes."""
    return df.select(
        [
            F.nullif(F.col(name), F.lit("")).alias(name) if kind == "string" else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def read_csv(spark: SparkSession, table: str, path: str | list[str]) -> DataFrame:
    """One raw table from CSV files with a header; a byte-order mark is dropped."""
    reader = spark.read.schema(raw_schema(table)).options(**csv_options(table))
    return blank_to_null(reader.csv(path))


def csv_folder(spark: SparkSession, folder: str) -> RawReader:
    """Raw tables from a folder that holds the dataset's CSV files under their public names."""
    return lambda table: read_csv(spark, table, f"{folder}/{RAW_FILES[table]}.csv")


def parquet_folder(spark: SparkSession, folder: str) -> RawReader:
    """Raw tables landed as parquet: what was seeded with what arrived since laid over it."""
    return lambda table: KeyedTable(spark, folder, table).rows()


def catalog(spark: SparkSession, database: str | None = None) -> RawReader:
    """Raw tables or views known to the session by their public names."""
    prefix = f"{database}." if database else ""
    return lambda table: spark.table(f"{prefix}{RAW_FILES[table]}")


def land(raw: RawReader, folder: str, tables: Iterable[str] = RAW_FILES) -> None:
    """Writes raw tables as parquet: splittable, columnar, read many times.

    Takes the place of what was landed before. Rows that arrived as files (see streaming.ingest) are
    laid over it: a key that has arrived counts as it came last, whenever the table is landed.
    """
    for table in tables:
        rows = raw(table)
        KeyedTable(rows.sparkSession, folder, table).seed(rows)


def seed(
    spark: SparkSession,
    csv_dir: str,
    raw_dir: str,
    tables: Iterable[str] = RAW_FILES,
    most_rejected: float | None = None,
) -> None:
    """Full reload of the raw layer from CSV files.

    Without `most_rejected` the first bad row ends the load. With it bad rows are set aside (see
    quarantine), and the load is refused if they are more than this share of a table.
    """
    if most_rejected is None:
        land(csv_folder(spark, csv_dir), raw_dir, tables)
        return
    for table in tables:
        rows = quarantine.parsed(spark, table, f"{csv_dir}/{RAW_FILES[table]}.csv")
        accepted = quarantine.set_aside(rows, table, raw_dir, f"seed-{uuid.uuid4().hex}", most_rejected)
        KeyedTable(spark, raw_dir, table).seed(accepted)
