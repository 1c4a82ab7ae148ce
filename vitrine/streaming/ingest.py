"""Raw files picked up as they arrive, in place of a full reload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vitrine.session import shared_folder
from vitrine.sources import quarantine
from vitrine.sources.keyed import KeyedTable
from vitrine.sources.schemas import KEYS, raw_schema


def arriving(
    spark: SparkSession, table: str, landing: str, names: list[str], max_files: int | None = None
) -> DataFrame:
    """Stream of the text rows of CSV files that appear in the landing folder."""
    reader = spark.readStream.schema(quarantine.text_schema(names)).options(**quarantine.text_options(table))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return quarantine.with_place(reader.csv(landing))


def ingest(
    spark: SparkSession,
    table: str,
    landing: str,
    raw_dir: str,
    checkpoint: str | None = None,
    max_files: int | None = None,
    deletes: bool = False,
    most_rejected: float = 1.0,
) -> StreamingQuery:
    """Lays what is new over the raw table, then stops. Each file is taken exactly once.

    A row whose key is known takes the place of the one before (see sources.keyed for the order of
    versions). With `deletes` the files hold keys only, and rows of these keys go. Bad rows are set aside;
    a batch with a larger share of them than `most_rejected` ends the stream and is tried again by the
    next call. A batch that is repeated after a failure is not laid twice: the table knows the last batch
    of each stream. The offsets live in the shared folder, so a restarted driver goes on where it was.
    """
    checkpoint = checkpoint or f"{shared_folder(spark)}/ingest/{table}{'-deletes' if deletes else ''}"
    schema = raw_schema(table)
    if deletes:
        if not KEYS[table]:
            raise ValueError(f"rows of {table} have no key to delete them by")
        schema = StructType([f for f in schema if f.name in KEYS[table]])

    def put(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        rows = quarantine.judged(batch, table, schema)
        rows = quarantine.set_aside(rows, table, raw_dir, f"{stream}-{number}", most_rejected)
        rows = rows.select(
            *[
                F.col(f.name) if f.name in schema.names else F.lit(None).cast(f.dataType).alias(f.name)
                for f in raw_schema(table)
            ],
            *quarantine.PLACE,
            F.lit(deletes).alias("_deleted"),
        )
        KeyedTable(session, raw_dir, table).append(rows, stream, number)

    return (
        arriving(spark, table, landing, schema.names, max_files)
        .writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
