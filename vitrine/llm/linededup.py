"""Drops lines that many documents share, over levelled sorted runs of line hashes.

A run is a table of 128-bit line hashes, bucketed and sorted by hash, with the number of documents that
hold the line and the largest of their ids. Documents come in batches. The lines of a batch are counted
once, then meet every run in a merge join: hashes that no run holds become the batch's own run, all
others go to a log of repeats, so that runs never share a hash. Two runs of a level are merged into one
of the next. Runs are bucketed alike, so neither the joins nor the merges move them again: each hash is
shuffled once, when its batch comes. In the end the log is added to the runs.

Results do not depend on how documents are dealt into batches: numbers are summed, ids are maxima.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.storage import folder_for, stored

LEAST_LENGTH = 40  # code points of a key that counts
LEAST_DOCUMENTS = 5
BATCHES = 4
FANOUT = 2

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HASH = ["hi", "lo"]


def _hashes(value: Column) -> list[Column]:
    return [F.xxhash64(value).alias("hi"), F.xxhash64(F.lit(1), value).alias("lo")]


def _lowered(line: Column) -> Column:
    """A-Z in lower case, and no other letter."""
    plain = F.octet_length(line) == F.char_length(line)
    return F.when(plain, F.lower(line)).otherwise(F.translate(line, _UPPER, _UPPER.lower()))


def line_keys(text: Column, least_length: int = LEAST_LENGTH) -> Column:
    """array<hi, lo, pos> of the lines whose key is long enough, in order of the hash."""
    bare = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\f\r")))
    keys = F.transform(
        bare,
        lambda x, i: F.when(
            F.char_length(x) >= least_length,
            F.struct(*_hashes(_lowered(x)), i.alias("pos")),
        ),
    )
    return F.sort_array(F.array_compact(keys))


class LineRuns:
    """The runs and the log of repeats."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark = spark
        self.fanout = fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.tables: list[str] = []
        self.logs: list[str] = []

    def _write(self, run: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.tables.append(name)
        run.write.partitionBy("known").bucketBy(self.buckets, *_HASH).sortBy(*_HASH).option(
            "path", folder_for(self.spark, name)
        ).saveAsTable(name)
        return name

    def _run(self, name: str) -> DataFrame:
        return self.spark.table(name).filter(~F.col("known")).drop("known")

    def add(self, lines: DataFrame) -> None:
        """A batch: one row (hi, lo, id) for every document and line that it holds."""
        counted = lines.groupBy(*_HASH).agg(F.count("*").alias("docs"), F.max("id").alias("last"))
        known = F.lit(False)
        for k, name in enumerate(n for level in self.levels for n in level):
            held = self._run(name).select(*_HASH, F.lit(True).alias(f"held{k}"))
            counted = counted.join(held, _HASH, "left")
            known = known | F.col(f"held{k}").isNotNull()
        name = self._write(counted.select(*_HASH, "docs", "last", known.alias("known")))
        self.logs.append(name)
        self._put(name, 0)

    def _put(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            names, self.levels[level] = self.levels[level], []
            self._put(self._merged(names), level + 1)

    def _merged(self, names: list[str]) -> str:
        """One run of several. They share no hash, so an outer join of sorted buckets is their merge."""

        def merge(a: DataFrame, b: DataFrame) -> DataFrame:
            b = b.withColumnsRenamed({"docs": "docs_b", "last": "last_b"})
            both = a.join(b, _HASH, "full_outer")
            return both.select(
                *_HASH, F.coalesce("docs", "docs_b").alias("docs"), F.coalesce("last", "last_b").alias("last")
            )

        return self._write(reduce(merge, map(self._run, names)).withColumn("known", F.lit(False)))

    def totals(self, least: int) -> DataFrame:
        """hi, lo, docs, last of every line that at least so many documents hold."""
        names = [n for level in self.levels for n in level]
        log = reduce(DataFrame.union, [self.spark.table(n).filter("known").drop("known") for n in self.logs])
        log = log.groupBy(*_HASH).agg(F.sum("docs").alias("more"), F.max("last").alias("later"))
        run = self._run(self._merged(names) if len(names) > 1 else names[0])
        docs = F.col("docs") + F.coalesce("more", F.lit(0))
        return (
            run.join(log, _HASH, "left")
            .select(*_HASH, docs.alias("docs"), F.greatest("last", "later").alias("last"))
            .filter(F.col("docs") >= least)
        )

    def close(self) -> None:
        """Takes the runs out of the catalog; their files stay in the shared folder until it is cleaned."""
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables = []


def shared_lines(keyed: DataFrame, batches: int, least_documents: int) -> DataFrame:
    """hi, lo, docs, last: the lines that at least so many documents hold, with the largest id."""
    # sorted by hash: a key's first occurrence in its document is the one that differs from its neighbour
    once = F.filter(
        "keys",
        lambda k, i: (i == 0)
        | (F.get("keys", i - 1)["hi"] != k["hi"])
        | (F.get("keys", i - 1)["lo"] != k["lo"]),
    )
    runs = LineRuns(keyed.sparkSession)
    for number in range(batches):
        batch = keyed.filter(F.col("batch") == number)
        runs.add(batch.select("id", F.explode(once).alias("k")).select("k.hi", "k.lo", "id"))
    found = stored(runs.totals(least_documents), "shared-lines")
    runs.close()
    return found


def without_shared_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = LEAST_LENGTH,
    least_documents: int = LEAST_DOCUMENTS,
    batches: int = BATCHES,
) -> DataFrame:
    """doc_id, n_lines, n_dropped and the kept text of every document; other columns are ignored.

    A line's key is the line without white space at its ends and with A-Z in lower case. Keys that are
    long enough and are held by enough documents lose all lines but those in the document of the largest
    id. A null or empty text is one empty line. Every row is a document: rows alike in id and text count
    as many times as they occur and have the same result. A null id is smaller than any other.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    row = [F.xxhash64("doc_id", "text").alias("row_a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("row_b")]
    keyed = own.select(*row, F.col("doc_id").alias("id"), line_keys(F.col("text"), least_length).alias("keys"))
    keyed = keyed.filter(F.size("keys") > 0).withColumn("batch", F.pmod("row_a", F.lit(batches)).cast("int"))
    keyed = stored(keyed, "line-keys", by=["batch"])
    shared = shared_lines(keyed, batches, least_documents)

    lines = keyed.select("row_a", "row_b", "id", F.explode("keys").alias("k"))
    lines = lines.select("row_a", "row_b", "id", F.col("k.hi").alias("hi"), F.col("k.lo").alias("lo"), "k.pos")
    lost = (
        lines.join(shared.select(*_HASH, "last"), _HASH)
        .filter(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy("row_a", "row_b")
        .agg(F.collect_set("pos").alias("lost"))
        .withColumnsRenamed({"row_a": "lost_a", "row_b": "lost_b"})
    )
    split = own.select("*", *row).join(
        lost, (F.col("row_a") == F.col("lost_a")) & (F.col("row_b") == F.col("lost_b")), "left"
    )
    split = split.select("doc_id", "text", "lost", F.split("text", "\n").alias("lines"))
    # array_except hashes, keeps the order, and positions are distinct
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("lost"))
    left = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return split.select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("lost").isNull(), F.col("text")).otherwise(left).alias("text"),
    )


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 (of the kept text) for every document."""
    return without_shared_lines(docs, **options).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256")
    )


LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{_UPPER}', '{_UPPER.lower()}') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {LEAST_LENGTH}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {LEAST_DOCUMENTS}),
marked AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last AS lost FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
