"""Raw tables that take updates: a base of key-hash buckets, and batches of later versions beside it.

A table is a folder:

    base/<name>/bucket=<k>/      rows, as seeded or as folded later
    arrived/<name>/bucket=<k>/   one batch: rows and deletion markers, with the version of each
    log/<number>.json            snapshots; the last one is the table

A snapshot names the base folder of every bucket and the batches to be laid over them. It is written last,
so a job that dies leaves the table as it was, and older snapshots can still be read. A key that has
arrived takes the place of all rows of that key in the base; of several versions the last one counts,
by batch, then by the time and name of the file, then by the place in it. Rows with a null in their key have
no identity: they are all kept.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import asdict, dataclass, field, replace
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitrine.functions.fixed_values import RAW_FILES
from vitrine.sources.files import create, delete, names_in, text_of
from vitrine.sources.schemas import KEYS, raw_schema

BUCKETS = 16

VERSION = "_seq long, _at timestamp, _file string, _start long, _row long, _deleted boolean"
_ORDER = ["_seq", "_at", "_file", "_start", "_row"]


@dataclass(frozen=True)
class Snapshot:
    """What a table consists of. `laid` are the batches over the base, `batches` all that ever came."""

    number: int = 0
    seed: str | None = None
    buckets: int = BUCKETS
    base: dict[str, str] = field(default_factory=dict)
    laid: list[str] = field(default_factory=list)
    batches: list[list] = field(default_factory=list)  # [number of the snapshot, folder]
    done: dict[str, int] = field(default_factory=dict)  # the last batch of each stream


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def whole_key(keys: Collection[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


class KeyedTable:
    """One raw table. One writer at a time: a second one fails when it publishes, and can be run again."""

    def __init__(self, spark: SparkSession, raw_dir: str, table: str):
        self.spark = spark
        self.table = table
        self.folder = f"{raw_dir.rstrip('/')}/{RAW_FILES[table]}"
        self.keys = KEYS[table]
        self.schema = raw_schema(table)

    # --- snapshots

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The last snapshot, or an older one."""
        if number is None:
            names = names_in(self.spark, f"{self.folder}/log")
            number = int(names[-1].removesuffix(".json")) if names else 0
        return Snapshot(**json.loads(text_of(self.spark, self._log(number)))) if number else Snapshot()

    def _log(self, number: int) -> str:
        return f"{self.folder}/log/{number:012d}.json"

    def _publish(self, snapshot: Snapshot) -> Snapshot:
        create(self.spark, self._log(snapshot.number), json.dumps(asdict(snapshot)))
        return snapshot

    # --- writing

    def _write(self, rows: DataFrame, kind: str, buckets: int) -> dict[str, str]:
        """The folder of every bucket that has rows. The rebalance splits a bucket with a hot key."""
        folder = f"{kind}/{uuid.uuid4().hex}"
        route = F.col(self.keys[0]) if self.keys else F.col(self.schema.names[0])
        dealt = rows.withColumn("bucket", bucket_of(route, buckets)).hint("rebalance", "bucket")
        dealt.write.partitionBy("bucket").parquet(f"{self.folder}/{folder}")
        names = names_in(self.spark, f"{self.folder}/{folder}")
        return {n.removeprefix("bucket="): folder for n in names if n.startswith("bucket=")}

    def seed(self, rows: DataFrame) -> None:
        """A full load: the oldest version of everything, whenever it is made. Batches stay laid over it."""
        now = self.snapshot()
        base = self._write(rows.select(self.schema.names), "base", now.buckets)
        self._publish(
            replace(
                now,
                number=now.number + 1,
                seed=uuid.uuid4().hex,
                base=base,
                laid=[folder for _, folder in now.batches],
            )
        )

    def append(self, rows: DataFrame, stream: str, number: int) -> bool:
        """A batch: raw columns and _at, _file, _start, _row, _deleted. False if it is there already."""
        now = self.snapshot()
        if number <= now.done.get(stream, -1):
            return False
        seq = now.number + 1
        written = self._write(rows.withColumn("_seq", F.lit(seq).cast("long")), "arrived", now.buckets)
        folders = sorted(set(written.values()))  # one, or none for an empty batch
        self._publish(
            replace(
                now,
                number=seq,
                laid=[*now.laid, *folders],
                batches=[*now.batches, *([seq, f] for f in folders)],
                done=now.done | {stream: number},
            )
        )
        return True

    def fold(self) -> None:
        """Writes the buckets that batches lie over anew, and no others. Reading then merges nothing."""
        now = self.snapshot()
        touched = self._touched(now.laid)
        if not touched:
            return
        written = self._write(self.rows(now, touched), "base", now.buckets)
        base = {k: v for k, v in now.base.items() if k not in touched} | written
        self._publish(replace(now, number=now.number + 1, base=base, laid=[]))

    def prune(self, since: int) -> None:
        """Deletes the snapshots before number `since` and the base folders that only they name.

        Batches stay: a later seed is laid under them.
        """
        numbers = [int(n.removesuffix(".json")) for n in names_in(self.spark, f"{self.folder}/log")]
        live = [self.snapshot(n) for n in numbers if n >= since or n == max(numbers)]
        used = {folder for s in live for folder in s.base.values()}
        for n in numbers:
            if n < since and n != max(numbers):
                delete(self.spark, self._log(n))
        for name in names_in(self.spark, f"{self.folder}/base"):
            if f"base/{name}" not in used:
                delete(self.spark, f"{self.folder}/base/{name}")

    # --- reading

    def _touched(self, folders: Collection[str]) -> set[str]:
        names = [n for f in folders for n in names_in(self.spark, f"{self.folder}/{f}")]
        return {n.removeprefix("bucket=") for n in names if n.startswith("bucket=")}

    def _scan(self, folders: dict[str, Collection[str]], schema: StructType) -> DataFrame:
        """The rows of some buckets of some folders."""
        paths = [f"{self.folder}/{f}/bucket={k}" for f, buckets in folders.items() for k in sorted(buckets)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    @cached_property
    def _versioned(self) -> StructType:
        return StructType([*self.schema.fields, *StructType.fromDDL(VERSION).fields])

    def _batches(self, folders: Collection[str], buckets: Collection[str] | None) -> DataFrame:
        found = {}
        for f in folders:
            own = self._touched([f])
            found[f] = own if buckets is None else own & set(buckets)
        return self._scan(found, self._versioned)

    def rows(self, snapshot: Snapshot | None = None, buckets: Collection[str] | None = None) -> DataFrame:
        """The table as of a snapshot, or some of its buckets.

        Nothing of the base is moved but its meeting with the keys that arrived since the last fold; where
        these are few, that is a broadcast. A key with very many versions is combined before the shuffle.
        """
        now = snapshot or self.snapshot()
        places: dict[str, list[str]] = {}
        for k, f in now.base.items():
            if buckets is None or k in buckets:
                places.setdefault(f, []).append(k)
        base = self._scan(places, self.schema)
        if not now.laid:
            return base
        arrived = self._batches(now.laid, buckets)
        if not self.keys:
            return base.unionByName(arrived.filter(~F.col("_deleted")).select(self.schema.names))
        known = whole_key(self.keys)
        rest = [c for c in self.schema.names if c not in self.keys]
        last = (
            arrived.filter(known)
            .groupBy(*self.keys)
            .agg(F.max_by(F.struct("_deleted", *rest), F.struct(*_ORDER)).alias("row"))
        )
        same = [F.col(k) == F.col(f"_new_{k}") for k in self.keys]
        # the first key is text; a new column gives both sides a plain shuffle, so that hot keys can be split
        new = last.select(
            F.concat(F.col(self.keys[0]), F.lit("")).alias(f"_new_{self.keys[0]}"),
            *[F.col(k).alias(f"_new_{k}") for k in self.keys[1:]],
        )
        kept = base.join(new, same, "left_anti")
        live = last.filter(~F.col("row._deleted")).select(*self.keys, *[F.col(f"row.{c}") for c in rest])
        loose = arrived.filter(~known & ~F.col("_deleted"))
        return kept.unionByName(live.select(self.schema.names)).unionByName(loose.select(self.schema.names))

    def arrived_between(self, before: Snapshot, after: Snapshot) -> DataFrame:
        """Every version that came after one snapshot and up to another."""
        folders = [f for n, f in after.batches if before.number < n <= after.number]
        return self._batches(folders, None)


def keyed_folder(spark: SparkSession, raw_dir: str):
    """Raw tables by name, each as of the first time it is asked for."""
    snapshots: dict[str, Snapshot] = {}

    def read(table: str) -> DataFrame:
        own = KeyedTable(spark, raw_dir, table)
        return own.rows(snapshots.setdefault(table, own.snapshot()))

    return read
