"""Language identification by error-correcting output codes.

Every language has a codeword. For each bit of the code one binary classifier over hashed byte
n-grams says on which side of the bit a text's language lies. Decoding takes the codeword of least
weighted loss, so some wrong bits are outvoted; a small lead over the next codeword is flagged.
The model's size follows the code's length, not the number of languages or documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.arrays import map_texts, mixed, pieces
from vitrine.llm.storage import stored

GRAM = 3
BUCKETS = 1 << 16
SAMPLE = 4000  # labelled documents a language, at most about
MOST_BITS = 31
CHECKED = 40  # labelled documents outside the held-out fold from which on a quarter of a language's checks the bits
AMBIGUOUS = 0.8  # score below which a prediction is flagged
UNKNOWN = "und"

_TABLES = [(mixed(np.arange(256, dtype=np.uint64) + np.uint64(1000 * k)) & np.uint64(BUCKETS - 1)).astype(np.uint16) for k in range(1, GRAM + 1)]
for _table in _TABLES:
    _table[65:91] = _table[97:123]  # case of plain letters does not count
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # bits x buckets
    trust: np.ndarray  # bits: weight of a bit's loss
    scale: np.ndarray  # bits: margin of a typical text
    prior: np.ndarray


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram, and the first n-gram of each document."""
    if len(data) < GRAM:
        return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
    n = len(data) - GRAM + 1
    codes = _TABLES[0][data[:n]].copy()
    for k in range(1, GRAM):
        codes ^= _TABLES[k][data[k : n + k]]
    own = np.ones(n, bool)
    for k in range(1, GRAM):  # those that cross a document's end go
        at = offsets[1:-1] - k
        own[at[(at >= 0) & (at < n)]] = False
    before = np.append(0, np.cumsum(own))
    return codes[own], before[np.minimum(offsets, n)]


def codewords(n: int) -> np.ndarray:
    """Exhaustive code for few languages, else the best spread of seeded random codes."""
    if n <= 5:
        bits = 2 ** max(n - 1, 0) - 1
        return np.array([[1] * bits] + [[1 if (j >> (n - 2 - i)) & 1 else -1 for j in range(bits)] for i in range(n - 1)], float).reshape(n, bits)
    best, spread = None, -1.0
    bits = min(MOST_BITS, math.ceil(10 * math.log2(n)))
    for seed in range(50):
        code = np.where(np.random.default_rng(seed).random((n, bits)) < 0.5, -1.0, 1.0)
        near = code @ code.T - 2 * bits * np.eye(n)
        if (bits - near.max()) > spread and (np.abs(code.sum(0)) < n).all():
            best, spread = code, bits - near.max()
    return best


def _folded(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, most: int) -> DataFrame:
    """About `most` labelled documents a language outside the held-out fold, by hash of the id.

    Languages of few documents are trained on all of them; the bits are then weighed on the others.
    """
    labelled = docs.filter((_folded(id_col) != 2) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = stored(labelled.groupBy(F.col(lang_col).alias("of")).count(), "language-counts")
    share = F.lit(float(most)) / F.col("count")
    drawn = labelled.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return drawn.join(counts, F.col("lang") == F.col("of")).filter(place < share).select(
        "lang", "text", ((F.xxhash64("doc_id", F.lit(7)) % 4 == 0) & (F.col("count") >= CHECKED)).alias("checks")
    )


def _gram_counts(sample: DataFrame) -> DataFrame:
    """(lang, bucket, n): counts of hashed n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}

        def packed(lang: str) -> pa.RecordBatch:
            counts = total.pop(lang)
            hit = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array(hit.astype(np.int32)), pa.array(counts[hit])], names=["lang", "bucket", "n"])

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for i, j, data, offsets in pieces(batch, 1):
                codes, first = grams(data, offsets)
                for k in range(i, j):
                    if langs[k] not in total:
                        if len(total) >= 64:
                            yield packed(next(iter(total)))
                        total[langs[k]] = np.zeros(BUCKETS, np.int64)
                    np.add.at(total[langs[k]], codes[first[k - i] : first[k - i + 1]], 1)
        for lang in list(total):
            yield packed(lang)

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model | None:
    """The model, or None without labelled text. What reaches the driver: one row a language, one a bucket."""
    spark = docs.sparkSession
    drawn = stored(_sample(docs, id_col, text_col, lang_col, sample), "language-sample")
    counts = stored(_gram_counts(drawn.filter("not checks")), "language-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang").toPandas()
    if totals.empty:
        return None
    languages = totals["lang"].tolist()
    code = codewords(len(languages))
    bits = code.shape[1]
    rows = [(lang, float(n), [bool(x > 0) for x in word]) for lang, n, word in zip(languages, totals["total"], code, strict=True)]
    words = spark.createDataFrame(rows, "of string, total double, word array<boolean>")
    # likelihood of a bucket on each side of a bit: its share of n-grams, averaged over the side's languages
    rate = F.col("n") / F.col("total")
    sides = [F.sum(F.when(F.element_at("word", b + 1) == F.lit(side), rate).otherwise(0.0)) for b in range(bits) for side in (True, False)]
    weights = np.zeros((bits, BUCKETS))
    if bits:
        shares = counts.join(words, F.col("lang") == F.col("of")).groupBy("bucket").agg(F.array(*sides).alias("sides")).toPandas()
        table = np.zeros((BUCKETS, 2 * bits))
        table[shares["bucket"].to_numpy()] = np.stack(shares["sides"].to_list()) if len(shares) else 0
        up, down = (code > 0).sum(0), (code < 0).sum(0)
        floor = 0.1 / BUCKETS
        weights = np.log((table[:, 0::2] / up + floor) / (table[:, 1::2] / down + floor)).T.astype(np.float32)
    prior = np.log(totals["total"].to_numpy(float) / totals["total"].sum())
    model = Model(languages, code, weights, np.ones(bits), np.ones(bits), prior)
    return _weighed(drawn.filter("checks"), model) if bits else model


def margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents x bits: mean weight of a document's n-grams; positive is the bit's upper side."""
    codes, first = grams(data, offsets)
    n = np.maximum(np.diff(first), 1)
    out = np.zeros((len(n), len(model.weights)))
    for b, weights in enumerate(model.weights):
        sums = np.append(0.0, np.cumsum(weights[codes], dtype=np.float64))
        out[:, b] = (sums[first[1:]] - sums[first[:-1]]) / n
    return out


def _weighed(checks: DataFrame, model: Model) -> Model:
    """Sets each bit's trust and scale from labelled documents that its weights have not seen."""
    held = checks.sparkSession.sparkContext.broadcast(model)
    row = {lang: i for i, lang in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = len(model.trust)
        for batch in batches:
            langs = [row.get(x, -1) for x in batch.column(0).to_pylist()]
            right, size, n = np.zeros(bits), np.zeros(bits), 0
            for i, j, data, offsets in pieces(batch, 1):
                own = np.array(langs[i:j])
                m = margins(held.value, data, offsets)[own >= 0] * model.code[own[own >= 0]]
                right, size, n = right + (m > 0).sum(0), size + np.abs(m).sum(0), n + len(m)
            yield pa.RecordBatch.from_arrays([pa.array(range(bits), pa.int32()), pa.array(right), pa.array(size), pa.array([n] * bits, pa.int64())], names=["bit", "right", "size", "n"])

    got = checks.select("lang", "text").mapInArrow(run, "bit int, right double, size double, n long").groupBy("bit").agg(F.sum("right").alias("right"), F.sum("size").alias("size"), F.sum("n").alias("n")).toPandas()
    if got.empty or not got["n"].max():
        return model
    got = got.sort_values("bit")
    right = (got["right"] + 1) / (got["n"] + 2)
    trust = np.maximum(2 * right - 1, 0.05)
    return model._replace(trust=trust.to_numpy(float), scale=np.maximum(got["size"] / got["n"], 1e-9).to_numpy(float))


def decode(model: Model, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language index and score: loss-weighted distance to every codeword."""
    loss = np.zeros((len(m), len(model.languages)))
    z = 3 * m / model.scale
    for b in range(m.shape[1]):
        loss += model.trust[b] * np.logaddexp(0, -z[:, b : b + 1] * model.code[:, b])
    near = -loss + 1e-3 * model.prior  # the commoner language where nothing speaks
    best = near.argmax(1)
    share = np.exp(near - near.max(1, keepdims=True))
    return best, share.max(1) / share.sum(1)


def _lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    found = np.append(0, np.cumsum(_LETTER[data]))
    out = found[offsets[1:]] > found[offsets[:-1]]
    for k in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[k] = any(map(str.isalpha, data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")))
    return out


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for every document.

    Learns from at most about `sample` labelled documents a language, drawn by hash of the id; ids,
    labels and sources are not used in a prediction. A null text or one without a letter is "und"
    with score 0, and so is all without labelled text. A null id is not held out and not learned
    from. Texts too short for an n-gram go to the commonest language. Repeated rows give repeated
    results, an empty table an empty one; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col, lang_col, sample))

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        names, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
        m = model.value
        for i, j, data, offsets in pieces(batch, batch.num_columns - 1):
            if m is None:
                continue
            best, score = decode(m, margins(m, data, offsets))
            lettered = _lettered(data, offsets)
            names[i:j] = np.where(lettered, np.array(m.languages, object)[best], UNKNOWN)
            scores[i:j] = np.where(lettered, score, 0.0)
        return [pa.array(names.tolist(), pa.string()), pa.array(scores), pa.array(scores < AMBIGUOUS)]

    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(_folded(id_col) == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    return map_texts(own, ["doc_id", "held_out"], "text", "lang_pred string, score double, ambiguous boolean", work)
