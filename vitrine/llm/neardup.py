"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. Shingles of five words weigh by their frequency in the document, 1 + ln(tf), times their inverse document
   frequency, 1 + ln(N / df). Every shingle's df is exact and counts every document that has it. Documents are
   packed into runs; each run sends its shingles to the parts of the hash range, the parts count them, and each
   part sends the counts back to the runs in the order the shingles came in, so the shingles travel once.
2. Consistent weighted samples are drawn for each document by these weights and banded.
3. In a band's bucket every member is compared with the first document and with the most central one;
   no other pairs are made. An exact check decides: weighted Jaccard similarity, in which only what more than HOT
   of the documents (and LEAST_KINDS) share weighs less, documents counted by kind: those that drew the same
   min-hash count once. So a large group of near copies keeps its links, while a passage that unlike documents
   share makes none.
4. Buckets of three or more texts that still hold more than one class are finished exactly: documents of
   different classes that could be similar enough share one of the shingles that come first in a common
   order (prefix filter, rare shingles first), and such pairs are compared too. A bucket of two is one pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.arrays import mixed, pieces, shingle_hashes, word_hashes, words
from vitrine.llm.components import components
from vitrine.llm.storage import stored

SHINGLE = 5
LEAST_SIMILARITY = 0.8
BANDS, ROWS = 20, 3
HOT = 0.02  # share of documents from which a shingle weighs less in the exact check
LEAST_KINDS = 50  # kinds of documents from which a frequency says that a shingle is common
_PART_BYTES = 12 << 20  # of text whose shingles one part of the hash range counts
_LEAST_PARTS, _MOST_PARTS = 1 << 8, 1 << 16
_RANK_BITS = 20


class Weights(NamedTuple):
    """Shingles that weigh less than 1, ascending, and their weights."""

    shingles: np.ndarray
    idf: np.ndarray

    def of(self, shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weight = 1 + np.log(counts)
        if len(self.shingles):
            spot = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
            hot = self.shingles[spot] == shingles
            weight[hot] *= self.idf[spot[hot]]
        return weight


def _quantiles() -> np.ndarray:
    """Gamma(2, 1) at 2^16 even probabilities, by bisection."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.zeros(len(p)), np.full(len(p), 40.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return x


_gamma: list[np.ndarray] = []


def doc_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles document by document, their counts, and each document's first one.

    A document of fewer words than a shingle has one shingle of all its words.
    """
    w = words(data, offsets)
    hashes = word_hashes(data, w)
    n_docs = len(w.first) - 1
    lengths = np.diff(w.first)
    all_ = shingle_hashes(hashes, SHINGLE)
    doc_of = np.repeat(np.arange(n_docs), np.maximum(lengths - SHINGLE + 1, 0))
    first = np.append(0, np.cumsum(np.maximum(lengths - SHINGLE + 1, 0)))
    at = np.arange(len(doc_of)) - first[doc_of] + w.first[doc_of]
    shingles = all_[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((lengths > 0) & (lengths < SHINGLE))
    if len(short):
        own = np.array([shingle_hashes(hashes[w.first[d] : w.first[d + 1]], int(lengths[d]))[0] for d in short], np.uint64)
        shingles, doc_of = np.append(shingles, own), np.append(doc_of, short)
    key = shingles ^ mixed(doc_of.astype(np.uint64) + np.uint64(1))
    _, index, counts = np.unique(key, return_index=True, return_counts=True)
    order = np.lexsort((index, doc_of[index]))
    index, counts = index[order], counts[order]
    return shingles[index], counts, np.searchsorted(doc_of[index], np.arange(n_docs + 1))


def samples(shingles: np.ndarray, weights: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """n x documents: the consistent weighted samples, each as the bits of its least value.

    The value of a sample depends on the shingle and its quantized weight only, so two documents
    have equal values exactly if they drew the same sample.
    """
    if not _gamma:
        _gamma.extend((g := _quantiles(), np.log(g)))
    gamma, log_gamma = _gamma
    log_weight = np.log(weights)
    low = np.uint64(0xFFFF)
    out = np.empty((n, len(first)), np.uint64)
    for k in range(n):
        bits = mixed(shingles + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) % (1 << 64)))
        r = gamma[(bits & low).astype(np.intp)]
        log_c = log_gamma[((bits >> np.uint64(16)) & low).astype(np.intp)]
        beta = (bits >> np.uint64(32)).astype(np.float64) * 2.0**-32
        t = np.floor(log_weight / r + beta)
        out[k] = np.minimum.reduceat(log_c - r * (t - beta + 1), first).view(np.uint64)
    return out


def _bands(data: np.ndarray, offsets: np.ndarray, frequencies: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that have shingles, and their band hashes.

    `frequencies`: in how many of `n` documents each shingle is, for the distinct ones in ascending order.
    """
    shingles, counts, first = doc_shingles(data, offsets)
    filled = np.flatnonzero(np.diff(first) > 0)
    if not len(filled):
        return filled, np.zeros((0, BANDS), np.int64)
    _, at = np.unique(shingles, return_inverse=True)
    weights = (1 + np.log(counts)) * (1 + np.log(n / frequencies))[at]
    drawn = samples(shingles, weights, first[filled], BANDS * ROWS)
    bands = np.empty((len(filled), BANDS), np.int64)
    for b in range(BANDS):
        h = np.full(len(filled), b + 1, np.uint64)
        for r in range(ROWS):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + drawn[b * ROWS + r])
        bands[:, b] = h.view(np.int64)
    return filled, bands


# --- document frequencies -------------------------------------------------------------------------


def _runs(docs: DataFrame) -> DataFrame:
    """(run, docs, text) of (doc_id, key, text): documents in runs of bounded size, one row a run."""
    fields = docs.schema.fields
    schema = T.StructType(
        [T.StructField("run", T.LongType()), *[T.StructField(f.name, T.ArrayType(f.dataType)) for f in fields]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, j, _, _ in pieces(batch, 2):
                number += 1
                bounds = pa.array([0, j - i], pa.int32())
                lists = [pa.ListArray.from_arrays(bounds, column.slice(i, j - i)) for column in batch.columns]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists], names=["run", *batch.schema.names])

    # a row is about a megabyte, so a group of rows is kept smaller than usual
    return stored(docs.mapInArrow(run, schema), "near-runs", compression="zstd", **{"parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 8})


def _texts_of(run: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a run's texts one after another, and their offsets."""
    _, _, data, offsets = next(pieces(pa.RecordBatch.from_arrays([run], names=["text"]), 0))
    return data, offsets


def _split(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of rows of `values` as binaries, cut at these rows."""
    width = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    return pa.Array.from_buffers(
        pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    )


def document_frequencies(runs: DataFrame, parts: int, common: float) -> DataFrame:
    """(run, part, df): for each run, in how many documents its shingles are; stored.

    `df` has 32 bits for each distinct shingle of the run whose hash lies in that part of the range (`parts`, a
    power of two), in ascending order. A shingle travels as its lower 56 bits: the part gives the others.
    A row without a run has, as 64 bits each, the shingles of the part that `common` documents or more have.
    """
    shift = 64 - (parts.bit_length() - 1)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shingles, _, _ = doc_shingles(*_texts_of(batch.column(1)[i].values))
                own, counts = np.unique(shingles, return_counts=True)
                part, cuts = np.unique((own >> np.uint64(shift)).astype(np.int32), return_index=True)
                cuts = np.append(cuts, len(own))
                low = own.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]
                row = pa.array(np.full(len(part), batch.column(0)[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [row, pa.array(part), _split(low, cuts), _split(counts.astype("<u4"), cuts)], names=["run", "part", "low", "n"]
                )

    def count(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        cuts = np.cumsum([0, *pc.binary_length(rows["n"]).to_numpy()]) // 4
        low = np.zeros((cuts[-1], 8), np.uint8)
        low[:, :7] = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(-1, 7)
        n = np.frombuffer(b"".join(rows["n"].to_pylist()), "<u4")
        own, at = np.unique(low.view("<u8").ravel(), return_inverse=True)
        df = np.bincount(at, n).astype("<u4")
        top = (np.uint64(part) << np.uint64(shift)) & np.uint64(0xFF << 56)
        many = (own[df >= common] | top).astype("<u8")
        dfs = _split(df[at], cuts).to_pylist()
        return pa.table(
            {"run": pa.array([*rows["run"].to_pylist(), None], pa.int64()), "part": pa.array([part] * (len(dfs) + 1), pa.int32()),
             "df": pa.array([*dfs, many.tobytes()], pa.binary())}
        )

    sent = runs.select("run", "text").mapInArrow(spread, "run long, part int, low binary, n binary")
    return stored(sent.groupBy("part").applyInArrow(count, "run long, part int, df binary"), "document-frequencies")


def _parts(n_bytes: int) -> int:
    """Parts of the hash range, so that each has about as many shingles at every size."""
    return min(max(_LEAST_PARTS, 1 << (max(1, n_bytes // _PART_BYTES)).bit_length()), _MOST_PARTS)


def _signatures(docs: DataFrame, runs: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """doc_id, key and bands of the `n` documents (doc_id, key, text)."""
    schema = T.StructType([*docs.schema.fields[:2], T.StructField("bands", T.ArrayType(T.LongType()))])

    def sign(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, keys, text = (left[c][0].values for c in ("doc_id", "key", "text"))
        df = np.frombuffer(b"".join(right.sort_by("part")["df"].to_pylist()), "<u4")
        filled, bands = _bands(*_texts_of(text), df, n)
        sizes = np.zeros(len(ids), np.int64)
        sizes[filled] = BANDS
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(bands.ravel()))
        return pa.table([ids, keys, lists], names=["doc_id", "key", "bands"])

    both = runs.groupBy("run").cogroup(found.filter(F.col("run").isNotNull()).groupBy("run"))
    return stored(both.applyInArrow(sign, schema), "near-signatures")


# --- what many documents share --------------------------------------------------------------------


def kinds(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The min-hash of the document that each shingle is in; two documents agree in it as often as their sets are alike."""
    sizes = np.diff(first)
    filled = first[:-1][sizes > 0]
    least = np.minimum.reduceat(mixed(shingles), filled) if len(filled) else np.zeros(0, np.uint64)
    return np.repeat(least, sizes[sizes > 0])


def shingle_weights(texts: DataFrame, n: int, found: DataFrame) -> Weights:
    """The shingles that weigh less in the exact check, of which as many kinds of documents as `_common` have it."""
    rows = found.filter(F.col("run").isNull()).select("df").toArrow()["df"].to_pylist()
    many = np.sort(np.frombuffer(b"".join(rows), "<u8").astype(np.uint64))
    if not len(many):
        return Weights(many, np.zeros(0))
    may = texts.sparkSession.sparkContext.broadcast(many)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in pieces(batch, 0):
                shingles, _, first = doc_shingles(data, offsets)
                kind = kinds(shingles, first)
                spot = np.minimum(np.searchsorted(may.value, shingles), len(may.value) - 1)
                hit = may.value[spot] == shingles
                shingles, kind = shingles[hit], kind[hit]
                _, once = np.unique(shingles ^ mixed(kind + np.uint64(1)), return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(x[once].view(np.int64)) for x in (shingles, kind)], names=["shingle", "kind"])

    counted = texts.mapInArrow(run, "shingle long, kind long").distinct().groupBy("shingle").agg(F.count("*").alias("df"))
    rows = counted.filter(F.col("df") >= _common(n)).toPandas().to_numpy(np.int64).reshape(-1, 2)
    shingles = rows[:, 0].copy().view(np.uint64)
    order = np.argsort(shingles)
    idf = (1 + np.log(n / rows[:, 1])) / (1 + np.log(n / _common(n))) if len(rows) else np.zeros(0)
    return Weights(shingles[order], idf[order])


def _common(n: int) -> float:
    """How many of `n` documents have a shingle that is common."""
    return max(LEAST_KINDS, HOT * n)


# --- comparisons ----------------------------------------------------------------------------------


def _profile(text: str | None, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer((text or "").encode(), np.uint8)
    shingles, counts, _ = doc_shingles(data, np.array([0, len(data)]))
    order = np.argsort(shingles)
    return shingles[order], weights.of(shingles[order], counts[order])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two profiles."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    spot = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    same = b[0][spot] == a[0]
    shared = np.minimum(a[1][same], b[1][spot[same]]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


def _links(pairs: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """The pairs (a, b) that are similar enough. The text of a travels with the pair, that of b joins there."""
    left = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, profile = None, None
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            b = batch.column(1).to_pylist()
            for i in range(batch.num_rows):
                if profile is None or b[i] != last:
                    last, profile = b[i], _profile(batch.column(3)[i].as_py(), weights.value)
                keep[i] = similarity(_profile(batch.column(2)[i].as_py(), weights.value), profile) >= LEAST_SIMILARITY
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep)) for k in range(2)], names=["a", "b"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return stored(joined.mapInArrow(run, "a string, b string"), "near-links")


def prefix(profile: tuple[np.ndarray, np.ndarray], rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of which two documents must share one to be similar enough; the weight from each on, and which are enough for the lighter one.

    `rank` orders shingles by bucket, rare ones first; any common order would do. At similarity s the
    shared weight is at least s of the heavier document's and 2s / (1 + s) of the lighter one's, and
    what stands before the first shared shingle is not shared.
    """
    shingles, weights = profile
    order = np.lexsort((shingles, rank[(shingles >> np.uint64(64 - _RANK_BITS)).astype(np.int64)]))
    total = weights.sum()
    before = np.append(0.0, np.cumsum(weights[order])[:-1]) / total
    reach = before <= (1 - LEAST_SIMILARITY) * (1 + 1e-9)
    light = before <= (1 - 2 * LEAST_SIMILARITY / (1 + LEAST_SIMILARITY)) * (1 + 1e-9)
    return shingles[order][reach], ((1 - before) * total)[reach], light[reach]


def _ranks(texts: DataFrame) -> np.ndarray:
    """How many of the texts have a shingle of each bucket: a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _RANK_BITS, np.int64)
        for batch in batches:
            for _, _, data, offsets in pieces(batch, 0):
                shingles, _, _ = doc_shingles(data, offsets)
                np.add.at(counts, (shingles >> np.uint64(64 - _RANK_BITS)).astype(np.int64), 1)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    rank = np.zeros(1 << _RANK_BITS, np.int64)
    rank[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return rank


def _rest(members: DataFrame, links: DataFrame, texts: DataFrame, weights) -> DataFrame:
    """Pairs still to compare: documents of different classes in a bucket whose members were not all compared."""
    labels = stored(components(links), "near-labels")
    own = members.filter("n > 2").select("slot", "key").join(labels, F.col("key") == F.col("node"), "left")
    own = stored(own.select("slot", "key", F.coalesce("label", "key").alias("class")), "near-classes")
    open_ = stored(own.groupBy("slot").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low <> high").select(F.col("slot").alias("of")), "open-slots")
    keys = stored(own.join(open_, F.col("slot") == F.col("of"), "left_semi").select(F.col("key").alias("of_key"), "class").distinct(), "open-keys")
    opened = stored(keys.join(texts.select("key", "text"), F.col("of_key") == F.col("key")).select("key", "class", "text"), "open-texts")
    rank = texts.sparkSession.sparkContext.broadcast(_ranks(opened))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, rests, lights, sizes = [], [], [], []
            for text in batch.column(2):
                profile = _profile(text.as_py(), weights.value)
                part, rest, light = prefix(profile, rank.value)
                parts.append(part.view(np.int64))
                rests.append(rest)
                lights.append(light)
                sizes.append(float(profile[1].sum()))
            n = np.array([len(p) for p in parts], np.int64)
            row = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(np.repeat(np.array(sizes, float), n)),
                 pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])), pa.array(np.concatenate([*rests, np.zeros(0)])), pa.array(np.concatenate([*lights, np.zeros(0, bool)]))],
                names=["key", "class", "weight", "shingle", "rest", "light"],
            )

    rows = stored(opened.mapInArrow(run, "key string, class string, weight double, shingle long, rest double, light boolean"), "prefixes")
    shared = stored(
        rows.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.max("light").alias("any"))
        .filter("low <> high and any").select(F.col("shingle").alias("of"), F.col("low").alias("main")),
        "shared-prefixes",
    )
    rows = stored(rows.join(shared, F.col("shingle") == F.col("of")).drop("of"), "shared-prefix-rows")
    light = rows.filter("light").select(
        F.col("key").alias("a"), F.col("class").alias("class_a"), F.col("weight").alias("weight_a"), F.col("shingle").alias("of"), F.col("main").alias("main_a"), F.col("rest").alias("rest_a")
    )
    heavy = rows.select(F.col("key").alias("b"), "class", "weight", "shingle", "main", "rest")
    fits = (
        (F.col("of") == F.col("shingle"))
        & (F.col("class_a") != F.col("class"))
        & (F.col("weight_a") <= F.col("weight") * (1 + 1e-9))
        & (F.col("weight_a") >= F.col("weight") * LEAST_SIMILARITY * (1 - 1e-9))
        # from their first shared shingle on, both must have the weight that they have to share
        & (F.least("rest_a", "rest") >= (F.col("weight_a") + F.col("weight")) * LEAST_SIMILARITY / (1 + LEAST_SIMILARITY) * (1 - 1e-9))
    )
    # of two classes at a shingle at least one is not its first class
    pairs = light.filter("class_a <> main_a").join(heavy, fits).select("a", "b")
    pairs = pairs.union(light.filter("class_a = main_a").join(heavy.filter("class <> main"), fits).select("a", "b"))
    return stored(pairs.distinct(), "rest-pairs")


# --- classes --------------------------------------------------------------------------------------


def _leaders(members: DataFrame) -> DataFrame:
    """Pairs (a, b): each member of a bucket with its first and with its most central document."""
    central = stored(members.groupBy(F.col("key").alias("of")).agg(F.sum("n").alias("degree")), "near-degrees")
    seen = members.join(central, F.col("key") == F.col("of"))
    hubs = seen.groupBy(F.col("slot").alias("of_slot")).agg(
        F.min(F.struct("first", "key")).alias("leader"), F.max(F.struct("degree", "key")).alias("hub")
    )
    hubs = stored(hubs.select("of_slot", F.col("leader.key").alias("leader"), F.col("hub.key").alias("hub")), "near-hubs")
    both = members.join(hubs, F.col("slot") == F.col("of_slot")).select(
        F.col("key").alias("a"), F.explode(F.array_distinct(F.array("leader", "hub"))).alias("b")
    )
    return stored(both.filter("a <> b").distinct(), "near-pairs")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (digest of the text, null for null) and label (of its class) for every row of `docs`, stored."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), F.md5(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    n, n_bytes = own.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    runs = _runs(own)
    found = document_frequencies(runs, _parts(n_bytes), _common(n))
    weights = spark.sparkContext.broadcast(shingle_weights(own.select("text"), n, found))
    signed = _signatures(own, runs, found, n)
    texts = stored(
        signed.filter("size(bands) > 0").groupBy("key").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands")), "near-texts"
    )
    slots = texts.select("key", "first", F.explode("bands").alias("slot"))
    groups = stored(slots.groupBy(F.col("slot").alias("of")).agg(F.count("*").alias("n")).filter("n > 1"), "near-buckets")
    members = stored(slots.join(groups, F.col("slot") == F.col("of")).drop("of"), "near-members")
    pairs = _leaders(members)
    wanted = stored(pairs.select(F.col("a").alias("of")).union(pairs.select("b")).distinct(), "near-wanted")
    wanted = stored(texts.select("key", "first").join(wanted, F.col("key") == F.col("of"), "left_semi"), "near-wanted")
    # one row a text; rows alike in id and text collapse
    w = wanted.select(F.col("key").alias("of"), F.col("first").alias("of_first"))
    # the wanted texts grow with the input, so this join is the same at every size
    held = own.join(w.hint("merge"), (own.key == w.of) & own.doc_id.eqNullSafe(w.of_first), "left_semi")
    held = stored(held.select("key", "text"), "near-held")
    if held.count() > wanted.count():
        held = stored(held.dropDuplicates(["key"]), "near-held")
    links = _links(pairs, held, weights)
    links = links.union(_links(_rest(members, links, held, weights), held, weights))
    labels = components(links)
    return stored(
        signed.select("doc_id", "key").join(labels, F.col("key") == F.col("node"), "left").select("doc_id", "key", F.coalesce("label", "key").alias("label")),
        "near-classes",
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, class_size, is_kept for every document.

    class_id is the least id of the class, is_kept marks the rows with that id. Equal texts are of one
    class, also empty ones; a null text is a class of its own with its own id, not kept apart from rows
    that repeat it. Repeated rows share their class and flag. Empty tables give an empty result; other
    columns are ignored.
    """
    own = classes(docs, id_col, text_col)
    firsts = stored(
        own.filter("label is not null").groupBy(F.col("label").alias("of")).agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")),
        "near-firsts",
    )
    joined = own.join(firsts, F.col("label") == F.col("of"), "left")
    class_id = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return joined.select(
        "doc_id", class_id.alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), F.col("doc_id").eqNullSafe(class_id).alias("is_kept")
    )


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of every class, the one of the least id; columns unchanged. Null texts stay."""
    own = classes(docs, id_col, text_col).filter("label is not null")
    kept = own.groupBy("label").agg(F.min(F.struct("doc_id", "key")).alias("kept")).select("kept.*")
    copies = own.groupBy("doc_id", "key").agg(F.count("*").alias("copies"))
    k = kept.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"))
    kept = stored(k.join(copies, k["_id"].eqNullSafe(copies.doc_id) & (k["_key"] == copies.key)).select("_id", "_key", "copies"), "near-kept")
    at = (docs[id_col].eqNullSafe(F.col("_id"))) & (F.md5(docs[text_col]) == F.col("_key"))
    # what is kept grows with the input, so these joins are the same at every size
    once = docs.join(kept.filter("copies = 1").hint("merge"), at, "left_semi")
    out = once.union(docs.filter(F.col(text_col).isNull()))
    more = kept.filter("copies > 1")
    if not more.isEmpty():
        out = out.union(docs.join(more.hint("merge"), at, "left_semi").dropDuplicates([id_col, text_col]))
    return out
