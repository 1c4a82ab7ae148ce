"""Mixes sources to target weights with hash-threshold histograms.

Every document has a fixed place on the hash line. A source's budget is turned into a threshold on
that line: documents before it are taken once more. To find it, words are summed by source and
bucket of the line; only the bucket in which the budget runs out is cut into buckets again. So a
larger budget always takes what a smaller one took, nothing is sorted, and a rerun agrees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.hashes import BITS, PLACE_SQL, place
from vitrine.llm.storage import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
STEP = 12  # bits of a level; 4096 buckets a source


def n_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """Adds `target` to one row a source (source, source_size).

    Weights repeat over the sources by code point, null last. `share` of all words is dealt by
    weight; no source gets over `most` times its own words, the excess goes to the others by
    weight. Sources by rising size a unit of weight run full first, so two running sums give what
    dealing again and again would. One row a source passes through one task here, never a document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    room = F.col("source_size") * F.lit(float(most))
    by_need = Window.orderBy("need", F.col("source").asc_nulls_last())
    before, after = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    level = (F.col("budget") - F.coalesce(F.sum("room").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("room", room)
        .withColumn("need", F.col("room") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("level", level)
        # the level rises with each source that runs full and falls after the first that does not
        .withColumn("level", F.max("level").over(whole))
        .withColumn("target", F.least("room", F.col("level") * F.col("weight")))
        .select("source", "source_size", "target")
    )


def _boundary(sized: DataFrame, open_: DataFrame, shift: int) -> DataFrame:
    """The bucket of 2^shift places in which each source's budget runs out."""
    inside = sized.join(
        open_.withColumnRenamed("source", "of"),
        sized.source.eqNullSafe(F.col("of")) & F.col("place").between(F.col("low"), F.col("high")),
    )
    sums = inside.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(
        F.sum("size").alias("words"),
        F.min("place").alias("first"),
        F.max("place").alias("last"),
        F.max("left").alias("left"),
    )
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    return (
        sums.withColumn("upto", upto)
        .filter(F.col("upto") > F.col("left"))
        .groupBy("source")
        .agg(F.min_by(F.struct("first", "last", "words", (F.col("left") - F.col("upto") + F.col("words")).alias("left")), "bucket").alias("b"))
        .select("source", "b.*")
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, times, threshold): rows before the threshold are taken times + 1 times."""
    times = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST))).otherwise(0)
    plan = targets.withColumn("times", times.cast("long"))
    open_ = plan.select(
        "source",
        F.lit(0).cast("long").alias("low"),
        F.lit(2**BITS).cast("long").alias("high"),
        (F.col("target") - F.col("times") * F.col("source_size")).alias("left"),
    )
    found = None
    for shift in range(BITS - STEP, -1, -STEP):
        edge = stored(_boundary(sized, open_, shift), "mix-edge")
        # one place left: take it if that comes nearer to the budget
        one = edge.filter("first = last").select(
            "source", (F.col("first") + (F.col("words") <= 2 * F.col("left")).cast("long")).alias("threshold")
        )
        found = one if found is None else found.union(one)
        open_ = edge.filter("first < last").select("source", F.col("first").alias("low"), F.col("last").alias("high"), "left")
        if open_.isEmpty():
            break
    hit = found.withColumnRenamed("source", "of")
    return plan.join(hit, plan.source.eqNullSafe(hit.of), "left").select(
        "source", "source_size", "target", "times", F.coalesce("threshold", F.lit(0).cast("long")).alias("threshold")
    )


def mix_plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The sized documents (id, source, size, place) and the stored thresholds of their sources."""
    sized = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            n_words(F.col(text_col)).alias("size"),
            place(id_col, text_col).alias("place"),
        ),
        "mix-sized",
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, most), "mix-targets")
    return sized, stored(thresholds(sized, targets), "mix-thresholds")


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: how many words of each document the mix takes.

    Options as for mix_plan. Null or empty texts have size 0 and are taken 0 words; a null source is
    a source of its own; rows alike in id and text share a place and are taken or left together.
    Other columns of the input are ignored, an empty table gives an empty table.
    """
    sized, plan = mix_plan(docs, **options)
    limits = plan.withColumnRenamed("source", "of")
    return sized.join(limits, sized.source.eqNullSafe(limits.of)).select(
        "doc_id", "source", "size", "source_size", "target", _taken(F.col("size"), F.col("place")).alias("taken")
    )


def _times(at: Column) -> Column:
    return F.col("times") + (at < F.col("threshold")).cast("long")


def _taken(size: Column, at: Column) -> Column:
    return size * _times(at)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it (none, once or twice). Columns unchanged."""
    _, plan = mix_plan(docs, **options)
    names = {"id_col": "doc_id", "text_col": "text", "source_col": "source"} | options
    limits = plan.select(
        F.col("source").alias("_mix_of"), F.col("times").alias("_mix_times"), F.col("threshold").alias("_mix_threshold")
    )
    at = place(names["id_col"], names["text_col"])
    times = F.col("_mix_times") + (at < F.col("_mix_threshold")).cast("long")
    joined = docs.join(limits, docs[names["source_col"]].eqNullSafe(limits["_mix_of"]))
    copies = F.explode(F.array_repeat(F.lit(1), times.cast("int")))
    return joined.withColumn("_mix_copy", copies).drop("_mix_of", "_mix_times", "_mix_threshold", "_mix_copy")


MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS bigint) AS size,
         {PLACE_SQL} AS place
  FROM documents),
sources AS (
  SELECT source, cast(sum(size) AS bigint) AS source_size,
         [5.0e0, 2.0e0, 1.0e0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source),
needs AS (
  SELECT *, source_size * 2.0e0 AS room, source_size * 2.0e0 / weight AS need,
         cast(sum(source_size) OVER () AS double) * 1.5e0 AS budget FROM sources),
levels AS (
  SELECT *, (budget - coalesce(sum(room) OVER (ORDER BY need, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY need, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own FROM needs),
level AS (SELECT max(own) AS level FROM levels),
targets AS (SELECT source, source_size, least(room, level * weight) AS target FROM levels, level),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(cast(floor(target / source_size) AS bigint), 2) ELSE 0 END AS times FROM targets),
places AS (
  SELECT source, place, sum(size) AS words, sum(sum(size)) OVER (PARTITION BY source ORDER BY place) AS upto
  FROM sized GROUP BY source, place),
edges AS (
  SELECT p.source, min_by(CASE WHEN p.words <= 2 * (target - times * source_size - upto + words) THEN place + 1 ELSE place END, place) AS threshold
  FROM places p JOIN budgets b ON p.source IS NOT DISTINCT FROM b.source
  WHERE upto > target - times * source_size GROUP BY p.source)
SELECT s.doc_id, s.size, b.source_size, b.target,
       cast(s.size * (b.times + CASE WHEN s.place < coalesce(e.threshold, 0) THEN 1 ELSE 0 END) AS bigint) AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON s.source IS NOT DISTINCT FROM e.source
"""
