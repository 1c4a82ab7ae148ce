"""Deals documents into shards of limited size by extendible hashing.

The directory is indexed by leading bits of a document's place on the hash line. A bucket over its
byte limit splits on one more bit, and only it; all others stay as they are. Bytes are summed once
by a prefix that is finer than the shards should be; splitting then works on those sums, and goes
back to the documents only for slots that are still too large.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.hashes import BITS, PLACE_SQL, place
from vitrine.llm.storage import quoted, stored

LIMIT = 1 << 20
FINER = 6  # bits of the first directory beyond an even split
STEP = 8  # bits by which slots that are still too large are refined


def _leaves(slots: DataFrame, depth: int, top: int, limit: int) -> DataFrame:
    """For every slot of `depth` bits the least number of bits from `top` on whose bucket fits."""
    sums = (
        slots.withColumn("depth", F.explode(F.sequence(F.lit(top), F.lit(depth))))
        .withColumn("prefix", F.expr(f"shiftright(slot, {depth} - depth)"))
        .groupBy("depth", "prefix")
        .agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"), F.min("first").alias("first"), F.max("last").alias("last"))
    )
    return sums.filter((F.col("shard_bytes") <= limit) | (F.col("first") == F.col("last")))


def _outermost(leaves: DataFrame) -> DataFrame:
    """Buckets that fit and whose parent does not."""
    parents = leaves.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    own = leaves.withColumn("parent", F.shiftright("prefix", 1))
    return own.join(parents, ["depth", "parent"], "left_anti").drop("parent")


def directory(sized: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The shards: depth, prefix, shard_bytes, shard_docs, first, last (places, inclusive).

    `sized` has place and bytes. A bucket all of whose rows share one place cannot split; it is a
    shard over the limit.
    """
    total = sized.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, FINER + max(0, math.ceil(math.log2(max(total, 1) / limit))))
    done, top, rest = None, 0, sized
    while True:
        slots = rest.groupBy(F.shiftright("place", BITS - depth).alias("slot")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("docs"), F.min("place").alias("first"), F.max("place").alias("last")
        )
        slots = stored(slots, "shard-slots")
        found = stored(_outermost(_leaves(slots, depth, top, limit)), "shard-leaves")
        done = found if done is None else done.union(found)
        large = slots.filter((F.col("bytes") > limit) & (F.col("first") < F.col("last"))).select("slot")
        if depth == BITS or large.isEmpty():
            return done
        rest = rest.join(large, F.shiftright("place", BITS - depth) == large.slot, "left_semi")
        top, depth = depth + 1, min(BITS, depth + STEP)


def _lookup(done: DataFrame) -> tuple[int, DataFrame]:
    """Bits of a slot, and for each slot the shards that it meets.

    Slots have as many bits as an even directory of so many shards, so there are no more slots than
    shards. A shard of fewer bits is named by all its slots, one of more bits by the slot it lies in, where
    only documents near the limit make it stand beside others: entries are at most twice the shards.
    """
    bits = max(0, done.count().bit_length() - 1)
    wide = F.col("depth") <= bits
    spread = F.expr(f"sequence(shiftleft(prefix, {bits} - depth), shiftleft(prefix + 1, {bits} - depth) - 1)")
    slots = F.when(wide, spread).otherwise(F.array(F.expr(f"shiftright(prefix, depth - {bits})")))
    shard_id = F.when(F.col("depth") == 0, F.lit("0")).otherwise(
        F.expr("lpad(bin(prefix), cast(depth as int), '0')")
    )
    shard = F.struct("depth", "prefix", shard_id.alias("shard_id"), "shard_bytes", "shard_docs")
    met = done.select(F.explode(slots).alias("_slot"), shard.alias("shard"))
    return bits, met.groupBy("_slot").agg(F.collect_list("shard").alias("_shards"))


#: The shard of a slot that a place lies in.
_OWN = f"filter(_shards, s -> shiftright(_place, cast({BITS} - s.depth AS int)) = s.prefix)[0]"


def shard(
    docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, bytes, shard_id, depth, shard_bytes, shard_docs for every document.

    shard_id is the shard's hash prefix in bits ("0" with depth 0 when all fits in one shard). A null
    text has 0 bytes. Rows alike in id and text cannot be told apart and stay together; a single
    document over the limit is a shard of its own. Other columns are ignored.
    """
    sized = stored(_sized(docs, id_col, text_col), "shard-sized")
    bits, lookup = _lookup(directory(sized, limit))
    lookup = stored(lookup, "shard-directory")
    placed = sized.withColumnRenamed("place", "_place")
    met = placed.join(lookup, F.shiftright("_place", BITS - bits) == lookup["_slot"]).withColumn("_own", F.expr(_OWN))
    return met.select(
        "doc_id", "bytes", "_own.shard_id", F.col("_own.depth").cast("int").alias("depth"), "_own.shard_bytes", "_own.shard_docs"
    )


def _sized(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long").alias("bytes"),
        place(id_col, text_col).alias("place"),
    )


def sharded_documents(
    docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` with shard_id, shard_bytes and shard_docs (columns of these names are replaced)."""
    new = ["shard_id", "shard_bytes", "shard_docs"]
    bits, lookup = _lookup(directory(stored(_sized(docs, id_col, text_col).drop("doc_id"), "shard-sized"), limit))
    lookup = stored(lookup, "shard-directory")
    kept = docs.drop(*new).withColumn("_place", place(id_col, text_col))
    met = kept.join(lookup, F.shiftright("_place", BITS - bits) == lookup["_slot"]).withColumn("_own", F.expr(_OWN))
    return met.select(*map(quoted, kept.drop("_place").columns), *[f"_own.{c}" for c in new])


SHARD_SQL = f"""
WITH sized AS (
  SELECT doc_id, cast(coalesce(octet_length(encode(text)), 0) AS bigint) AS bytes, {PLACE_SQL} AS place FROM documents),
places AS (SELECT place, sum(bytes) AS bytes, count(*) AS docs FROM sized GROUP BY place),
prefixes AS (
  SELECT place, depth, place >> ({BITS} - depth) AS prefix,
         sum(bytes) OVER w AS shard_bytes, sum(docs) OVER w AS shard_docs, count(*) OVER w AS n_places
  FROM places, (SELECT unnest(range(0, {BITS} + 1)) AS depth)
  WINDOW w AS (PARTITION BY depth, place >> ({BITS} - depth))),
leaves AS (
  SELECT place, min(depth) AS depth FROM prefixes WHERE shard_bytes <= {LIMIT} OR n_places = 1 GROUP BY place)
SELECT doc_id, s.bytes, CASE WHEN depth = 0 THEN '0' ELSE lpad(bin(prefix), cast(depth AS int), '0') END AS shard_id,
       cast(depth AS int) AS depth, cast(shard_bytes AS bigint) AS shard_bytes, cast(shard_docs AS bigint) AS shard_docs
FROM sized s JOIN leaves l USING (place) JOIN prefixes p USING (place, depth)
"""
