"""Stored marts: versions that share the month folders no build has touched."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitrine.functions.short_ids import long_ids
from vitrine.operators.orders_mart import derived, underived
from vitrine.sources.files import create, delete, names_in, text_of
from vitrine.sources.readonly import read_only
from vitrine.sources.schemas import MONTHLY, ORDERS_MART, SELLER_FACTS, SELLERS_MART

ORDERS, SELLERS = "mart_orders_wide", "mart_sellers_wide"
FACTS, FILES = "seller_facts", "seller_files"
BITS = 1 << 15  # of a file's map of sellers
WORK = "work"  # what a refresh writes for itself
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Manifest:
    """What a version consists of: for each month the version that wrote it, and the raw snapshots.

    `sums` has the months of each table of sums.
    """

    months: dict[str, str] = field(default_factory=dict)
    sums: dict[str, dict[str, str]] = field(default_factory=dict)
    sellers: str = ""
    raw: dict[str, int] = field(default_factory=dict)


class MartVersion:
    """One pair of marts; nobody reads it before it is published.

    Month folders lie under the mart, and in each a folder for every version that wrote the month. So a
    version that changes three months writes three folders and names those of older versions for the rest.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, manifest: Manifest | None = None):
        self.spark = spark
        self.root = root
        self.name = name
        self.manifest = manifest or Manifest()

    def write_orders(self, mart: DataFrame) -> None:
        columns = mart.columns
        self.manifest.months |= self._write_months(ORDERS, underived(mart), then=lambda rows: derived(rows, columns))

    def write_sums(self, name: str, sums: DataFrame, deal: bool = True) -> None:
        """`deal`: not for sums that lie in ranges by month already."""
        self.manifest.sums[name] = self.manifest.sums.get(name, {}) | self._write_months(name, sums, deal)

    def write_facts(self, facts: DataFrame, deal: bool = True) -> None:
        """What sellers sold, clustered by seller within the month, and what each file holds.

        Ranges of seller and order are dealt out, so files hold few sellers and a large one has several. `deal`: not
        for facts that lie in such ranges already.
        """
        keys = ["order_month", "seller_id", "order_id"]
        facts = facts.repartitionByRange(*keys) if deal else facts
        written = self._write_months(FACTS, facts.sortWithinPartitions(*keys), deal=False)
        self.manifest.sums[FACTS] = self.manifest.sums.get(FACTS, {}) | written
        place = F.pmod(F.xxhash64("seller_id"), F.lit(BITS))
        files = (
            self._scan(FACTS, SELLER_FACTS, {m: self.name for m in written})
            .select("order_month", "seller_id", F.col("_metadata.file_name").alias("file"))
            .groupBy("order_month", "file")
            .agg(
                F.min("seller_id").alias("least"),
                F.max("seller_id").alias("greatest"),
                F.bitmap_construct_agg(place).alias("bits"),
            )
        )
        self.write_sums(FILES, files)

    def facts_of(self, seller_id: str) -> DataFrame:
        """What one seller sold. Opens the files that may hold them: few, and mostly none for a stranger."""
        place = F.pmod(F.xxhash64(F.lit(seller_id)), F.lit(BITS))
        byte = F.conv(F.hex(F.substring("bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        holds = F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1
        inside = (F.col("least") <= seller_id) & (F.col("greatest") >= seller_id)
        folders = {(month_of(m) or "")[:7]: f"order_month={m}/version={v}" for m, v in self.manifest.sums[FACTS].items()}
        found = self.sums(FILES).filter(inside & holds).select("order_month", "file").collect()
        files = [f"{self.root}/{FACTS}/{folders[str(r.order_month or '')[:7]]}/{r.file}" for r in found]
        schema = StructType([f for f in StructType.fromDDL(SELLER_FACTS) if f.name != "order_month"])
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*files).filter(F.col("seller_id") == seller_id)

    def _write_months(
        self, name: str, rows: DataFrame, deal: bool = True, then: Callable[[DataFrame], DataFrame] | None = None
    ) -> dict[str, str]:
        """One folder a month. The rebalance gives full-sized files and splits a hot month. Ids are stored as text.

        `then`: what is computed after the rebalance, so that it is not shuffled.
        """
        folder = f"{self.root}/{name}"
        rows = rows.hint("rebalance", "order_month") if deal else rows
        long_ids(then(rows) if then else rows).withColumn("version", F.lit(self.name)).write.mode("append").partitionBy(
            "order_month", "version"
        ).parquet(folder, compression="zstd")
        own = f"version={self.name}"
        found = [n for n in names_in(self.spark, folder) if n.startswith("order_month=")]
        return {
            n.removeprefix("order_month="): self.name for n in found if own in names_in(self.spark, f"{folder}/{n}")
        }

    def forget(self, months: set[str]) -> None:
        """These months are to be written anew."""
        for table in (self.manifest.months, *self.manifest.sums.values()):
            for month in months:
                table.pop(month, None)

    def write_sellers(self, mart: DataFrame) -> None:
        mart.hint("rebalance").write.parquet(f"{self.root}/{SELLERS}/version={self.name}", compression="zstd")
        self.manifest.sellers = self.name

    def written(self) -> set[str]:
        """The months that this version wrote itself."""
        return {month for month, name in self.manifest.months.items() if name == self.name}

    def orders(self, months: set[str] | None = None) -> DataFrame:
        """The orders mart, or those of its months that are named as their folders are."""
        return self._months(ORDERS, ORDERS_MART, self.manifest.months, months)

    def sums(self, name: str, months: set[str] | None = None) -> DataFrame:
        """A table kept by month (see schemas.MONTHLY), or some of its months."""
        return self._months(name, MONTHLY[name], self.manifest.sums.get(name, {}), months)

    def _months(self, name: str, ddl: str, at: dict[str, str], months: set[str] | None) -> DataFrame:
        at = {month: version for month, version in at.items() if months is None or month in months}
        return self._scan(name, ddl, at).select(StructType.fromDDL(ddl).names)

    def _scan(self, name: str, ddl: str, at: dict[str, str]) -> DataFrame:
        # the schema is given because a partition folder's text would else read back zoned
        schema = StructType.fromDDL(f"{ddl}, version string")
        folder = f"{self.root}/{name}"
        paths = [f"{folder}/order_month={month}/version={version}" for month, version in sorted(at.items())]
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn("_metadata", F.struct(F.lit("").alias("file_name")))
        return self.spark.read.schema(schema).option("basePath", folder).parquet(*paths)

    def sellers(self) -> DataFrame:
        schema = StructType.fromDDL(SELLERS_MART)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{SELLERS}/version={self.manifest.sellers}")


def month_of(folder: str) -> str | None:
    """The month that a folder's name stands for, as text."""
    return None if folder == _NO_MONTH else unquote(folder)


class MartStore:
    """Versions of the two marts under one folder of a shared file system.

    A build writes what it changes. It is published by its manifest, a small file made last; readers take
    the last one. So they see the whole old pair or the whole new one, whatever happens to a build, and
    what they have opened stays until it is pruned.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def published(self) -> list[str]:
        return [n.removesuffix(".json") for n in names_in(self.spark, f"{self.root}/published")]

    def new_version(self, manifest: Manifest | None = None) -> MartVersion:
        """A version to be written, empty or starting from the folders of another."""
        last = int(self.published()[-1].split("-")[0]) if self.published() else 0
        return MartVersion(self.spark, self.root, f"{last + 1:012d}-{uuid.uuid4().hex[:12]}", manifest)

    def publish(self, version: MartVersion) -> None:
        create(self.spark, f"{self.root}/published/{version.name}.json", json.dumps(asdict(version.manifest)))

    def prune(self, keep: int = 2) -> None:
        """Deletes all but the last `keep` versions, as far as those do not share it. Not while a build runs."""
        names = self.published()
        live = [self._version(n).manifest for n in names[-keep:]]
        for name in names[:-keep]:
            delete(self.spark, f"{self.root}/published/{name}.json")
        for table in (ORDERS, *MONTHLY):
            of = [m.months if table == ORDERS else m.sums.get(table, {}) for m in live]
            for folder in names_in(self.spark, f"{self.root}/{table}"):
                month = folder.removeprefix("order_month=")
                self._drop(f"{table}/{folder}", {months.get(month) for months in of})
        self._drop(SELLERS, {m.sellers for m in live})
        self._drop(WORK, set())

    def _drop(self, folder: str, used: set[str | None]) -> None:
        for name in names_in(self.spark, f"{self.root}/{folder}"):
            if name.startswith("version=") and name.removeprefix("version=") not in used:
                delete(self.spark, f"{self.root}/{folder}/{name}")

    def current(self) -> MartVersion:
        names = self.published()
        if not names:
            raise FileNotFoundError(f"no marts are published under {self.root}")
        return self._version(names[-1])

    def _version(self, name: str) -> MartVersion:
        text = text_of(self.spark, f"{self.root}/published/{name}.json")
        return MartVersion(self.spark, self.root, name, Manifest(**json.loads(text)))

    def orders(self) -> DataFrame:
        return self.current().orders()

    def sellers(self) -> DataFrame:
        return self.current().sellers()

    def sums(self, name: str) -> DataFrame:
        return self.current().sums(name)

    def facts_of(self, seller_id: str) -> DataFrame:
        return self.current().facts_of(seller_id)

    def query(self, sql: str, **values: object) -> DataFrame:
        """Read-only SQL over the marts, named {mart_orders_wide} and {mart_sellers_wide}."""
        version = self.current()
        marts = {ORDERS: version.orders, SELLERS: version.sellers}
        return read_only(self.spark, sql, marts, values)
