"""How five filters of documents interact: what each removes, in every order they can be applied.

The filter for repeated texts needs the whole table. A counting Bloom sketch clears most texts of it
first: every text has a few cells, all in one segment of the sketch, and cells are counted over all
documents; each task counts its own and the counts are merged. A text one of whose cells counts once is
alone. Only the others, the possible repeats, are shuffled with their text and grouped by it, which gives
the least id of each text exactly. The flags of a document make a mask of five bits; documents are counted
by mask, and everything asked for is a sum over masks.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.storage import stored

FILTERS = "ABCDE"
CELLS = 16  # of the sketch for each document
HASHES = 4
SEGMENT = 1 << 15  # cells of a segment: one bitmap of 4 KB
# 128 MB of bitmaps at most. Beyond 67 million documents the sketch clears fewer of them; results stay.
MOST_SEGMENTS = 1 << 15

_KEY = ["key_a", "key_b"]


def flags(text: Column) -> list[Column]:
    """The filters A to D of a text that is not null, as booleans (true: it fails)."""
    words = F.array_remove(F.split(text, "[\\x09-\\x0D\\x20]+"), "")
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * capitals.cast("long") > 3 * F.char_length(text),
        text.rlike("[#$%&*|]"),
    ]


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit(1), text).alias("key_b")]


def _segment(segments: int) -> Column:
    return F.pmod("key_a", F.lit(segments))


def _cells() -> list[Column]:
    """The cells of a key within its segment."""
    return [F.pmod(F.xxhash64("key_b", F.lit(k)), F.lit(SEGMENT)) for k in range(HASHES)]


def segments_for(rows: int) -> int:
    return min(MOST_SEGMENTS, max(1, -(-rows * CELLS // SEGMENT)))


def sketch(keys: DataFrame, segments: int) -> DataFrame:
    """segment, bits: one bit a cell, set where the cell counts more than one.

    Spark counts the cells of each task and merges the counts; only cells that count are rows.
    """
    cells = keys.select(_segment(segments).alias("segment"), F.explode(F.array_distinct(F.array(*_cells()))).alias("cell"))
    counted = cells.groupBy("segment", "cell").agg(F.count("*").alias("n")).filter("n > 1")
    return counted.groupBy("segment").agg(F.bitmap_construct_agg("cell").alias("bits"))


def with_possible(rows: DataFrame, bitmaps: DataFrame, segments: int) -> DataFrame:
    """`rows` with `possible`: all cells of the row's key count more than one. No other row is a repeat.

    The bitmaps are broadcast: `segments` of them at most, 4 KB each.
    """

    def counts(cell: Column) -> Column:
        byte = F.conv(F.hex(F.substring("bits", (F.shiftright(cell, 3) + 1).cast("int"), F.lit(1))), 16, 10)
        return F.getbit(byte.cast("int"), cell.bitwiseAND(F.lit(7)).cast("int")) == 1

    held = rows.withColumn("segment", _segment(segments)).join(F.broadcast(bitmaps), "segment", "left")
    possible = F.col("bits").isNotNull()
    for cell in _cells():
        possible = possible & counts(cell)
    return held.withColumn("possible", possible).drop("segment", "bits")


def masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part and mask (bit 0 is filter A, bit 4 filter E) of every document.

    A null text is empty, a null part is an empty string. E fails where a smaller id has the same text;
    a null id has no place in the order, so it neither fails nor makes others fail. Rows alike in id and
    text do not fail by each other. Other columns are ignored.
    """
    own = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    key = _key(F.col("text"))
    four = sum((c.cast("int") * (1 << k) for k, c in enumerate(flags(F.col("text")))), F.lit(0))
    known = stored(own.select("doc_id", "part", *key, four.alias("mask")), "audit-flags")

    segments = segments_for(known.count())
    bitmaps = stored(sketch(known, segments), "audit-sketch")
    texts = with_possible(own.select("doc_id", "text", *key), bitmaps, segments).filter("possible")
    first = (
        texts.groupBy(*_KEY, "text")
        .agg(F.min("doc_id").alias("doc_id"))
        .select(*[F.col(c).alias(f"first_{c}") for c in ("doc_id", *_KEY)])
    )
    marked = with_possible(known, bitmaps, segments)
    same = [F.col(c) == F.col(f"first_{c}") for c in ("doc_id", *_KEY)]
    repeat = F.col("doc_id").isNotNull() & F.col("first_doc_id").isNull()
    met = marked.filter("possible").join(first, same, "left")
    met = met.select("doc_id", "part", (F.col("mask") + repeat.cast("int") * 16).alias("mask"))
    return met.unionByName(marked.filter("NOT possible").select("doc_id", "part", "mask"))


def mask_counts(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: the documents of every mask, and those of them with either label.

    A document that several rows of `labels` name has a label if one of them gives it.
    """
    wanted = labels.filter(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1)))
    marks = wanted.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    of = lambda c: F.sum(F.coalesce(c, F.lit(0)).cast("long")).alias(c)
    joined = flagged.join(marks, F.col("doc_id") == F.col("labelled"), "left")
    return joined.groupBy("part", "mask").agg(F.count("*").alias("n"), of("good"), of("toxic"))


def _orders(spark: SparkSession) -> DataFrame:
    """Every order and step: the filter, and the set of those before it. 600 rows."""
    rows = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for step, which in enumerate(order, 1):
            rows.append(("".join(FILTERS[k] for k in order), step, which, before))
            before |= 1 << which
    return spark.createDataFrame(rows, "filter_order string, step int, which int, before int")


def interactions(counts: DataFrame) -> DataFrame:
    """What every step of every order does, from the counts by mask.

    A step depends on its filter and on the set of those before it only, so each mask is added to 80
    sums, and the 600 steps look theirs up.
    """
    bit = F.expr("shiftleft(1, which)")
    sums = (
        counts.withColumn("which", F.explode(F.sequence(F.lit(0), F.lit(4))))
        .withColumn("before", F.explode(F.sequence(F.lit(0), F.lit(31))))
        .filter(F.col("before").bitwiseAND(bit) == 0)
        .withColumn("fails", F.col("mask").bitwiseAND(bit) != 0)
        .withColumn("left", F.col("mask").bitwiseAND(F.col("before")) == 0)
    )
    fails, left = F.col("fails"), F.col("left")

    def total(which: Column, of: Column, name: str) -> Column:
        return F.sum(F.when(which, of).otherwise(F.lit(0)).cast("long")).alias(name)

    n = F.col("n")
    sums = sums.groupBy("part", "which", "before").agg(
        total(left & ~fails, n, "kept"),
        total(left & fails, n, "removed"),
        total(~left & fails, n, "redundant"),
        total(F.col("mask") == bit, n, "unique_fails"),
        total(left & fails, F.col("good"), "good_lost"),
        total(left & fails, F.col("toxic"), "toxic_lost"),
        # a filter is first among the ones a document fails in 120 / their number of the orders
        total(fails, n * F.expr("120 div bit_count(mask)"), "shapley"),
    )
    steps = F.broadcast(_orders(counts.sparkSession))
    return sums.join(steps, ["which", "before"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """What each filter removes at each step of all 120 orders, one row a part, order and step.

    `labels` has doc_id, quality and toxic. No documents, no rows.
    """
    return interactions(mask_counts(masks(docs, **columns), labels))


AUDIT_SQL = """
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM texts),
flagged AS (
  SELECT doc_id, part, least < doc_id AS e, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d FROM worded),
failed AS (
  SELECT doc_id, part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END,
         CASE WHEN c THEN 'C' ELSE '' END, CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails
  FROM flagged),
labelled AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS bad FROM labels GROUP BY doc_id),
docs AS (SELECT part, fails, coalesce(good, false) AS good, coalesce(bad, false) AS bad FROM failed LEFT JOIN labelled USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6))::int AS step)),
grouped AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM docs GROUP BY ALL),
met AS (
  SELECT g.*, s.*, contains(fails, own) AS hit,
         length(translate(fails, before, '')) < length(fails) AS gone FROM grouped g, steps s),
counted AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit AND NOT gone THEN bad ELSE 0 END) AS toxic_lost FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant,
       unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::bigint AS shapley
FROM counted
"""
