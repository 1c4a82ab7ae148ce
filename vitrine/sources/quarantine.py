"""CSV rows that cannot be used, set aside with the reason, the file and the place in it.

Files are read as text, header included, so that nothing is lost before it is judged. A row is rejected
for a wrong number of fields (also by quotes that do not close), for a key, a number or a time that is
none, or because its file has no header with the declared columns. Accepted and rejected rows are all rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from vitrine.functions.dates import NTZ
from vitrine.sources.schemas import KEYS, MULTILINE, NUMBERS, TIMES, raw_schema

PLACE = ["_at", "_file", "_start", "_row"]


class RefusedLoad(ValueError):
    """More rows of a load are bad than it may have."""


def text_schema(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in [*names, "_broken"]])


def text_options(table: str) -> dict[str, str]:
    return {
        "header": "false",
        "encoding": "UTF-8",
        "quote": '"',
        "escape": '"',
        "multiLine": str(table in MULTILINE).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_broken",
        # else the number of fields is only checked where all columns are read
        "columnPruning": "false",
    }


def with_place(rows: DataFrame) -> DataFrame:
    """The rows with time and name of their file and the start of the split they were read from."""
    return rows.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_at"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    )


def parsed(spark: SparkSession, table: str, path: str | list[str]) -> DataFrame:
    """The rows of a table's CSV files, judged."""
    reader = spark.read.schema(text_schema(raw_schema(table).names)).options(**text_options(table))
    return judged(with_place(reader.csv(path)), table, raw_schema(table))


def _given(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _faults(table: str, schema: StructType) -> list[Column]:
    """A reason for each way in which a row is bad; null where it is not."""
    found = [F.when(F.col("_broken").isNotNull(), F.lit("wrong number of fields"))]
    kinds = {f.name: f.dataType for f in schema}
    kinds |= {n: DoubleType() for n in NUMBERS.get(table, []) if n in kinds}
    for name, kind in kinds.items():
        if kind in (IntegerType(), DoubleType()):
            bad = _given(name).isNotNull() & _given(name).try_cast(kind).isNull()
            found.append(F.when(bad, F.lit(f"{name} is not a number")))
    for name in KEYS[table]:
        found.append(F.when(_given(name).isNull(), F.lit(f"{name} is missing")))
    for name in TIMES.get(table, []):
        if name in kinds:
            bad = _given(name).isNotNull() & _given(name).try_cast(NTZ).isNull()
            found.append(F.when(bad, F.lit(f"{name} is not a time")))
    return found


def judged(rows: DataFrame, table: str, schema: StructType) -> DataFrame:
    """Typed columns, _reason (null if accepted), _text and the place, for every row but the headers.

    Files without a header are found by one small group a file, and only their names are broadcast.
    """
    names = schema.names
    first = F.ltrim(F.col(names[0]), F.lit("﻿"))
    is_header = reduce(and_, [F.col(n).eqNullSafe(F.lit(n)) for n in names[1:]], first.eqNullSafe(F.lit(names[0])))
    placed = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("_header", is_header)
    headless = rows.withColumn("_header", is_header).groupBy(F.col("_file").alias("_headless"))
    headless = headless.agg(F.max("_header").alias("_any")).filter(~F.col("_any")).drop("_any")
    placed = placed.filter(~F.col("_header")).join(
        F.broadcast(headless), F.col("_file") == F.col("_headless"), "left"
    )
    reason = F.coalesce(
        F.when(F.col("_headless").isNotNull(), F.lit("no header with the declared columns")), *_faults(table, schema)
    )
    text = F.coalesce("_broken", F.to_json(F.struct(*names)))
    return placed.select(
        *[_given(f.name).try_cast(f.dataType).alias(f.name) for f in schema],
        reason.alias("_reason"),
        F.when(reason.isNotNull(), text).alias("_text"),
        *PLACE,
    )


def rejected_folder(raw_dir: str, table: str) -> str:
    return f"{raw_dir}/rejected/{table}"


def set_aside(rows: DataFrame, table: str, raw_dir: str, name: str, most_rejected: float) -> DataFrame:
    """The accepted rows; the others are written to a folder of this name first.

    Only two counts reach the driver. A load with a larger share of bad rows is refused; the rows set
    aside stay, for they say why.
    """
    bad = rows.filter(F.col("_reason").isNotNull())
    folder = f"{rejected_folder(raw_dir, table)}/{name}"
    out = bad.select(*[F.col(c).alias(c[1:]) for c in ("_file", "_start", "_row", "_reason", "_text")])
    out.write.mode("overwrite").parquet(folder)
    rejected, total = rows.sparkSession.read.schema(out.schema).parquet(folder).count(), rows.count()
    if rejected > most_rejected * total:
        raise RefusedLoad(f"{table}: {rejected} of {total} rows are bad, see {folder}")
    return rows.filter(F.col("_reason").isNull()).drop("_reason", "_text")
