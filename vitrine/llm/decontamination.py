"""Finds benchmark items in documents.

1. Of every item some shingles, rare ones first, are its prefix: what is left of it weighs too little for
   the similarity, so a document without any of them cannot hold the item. One pass over the documents
   keeps those that meet a bitmap of all prefixes, whatever the number of items.
2. A shingle belongs to a block, by hash. Items lie in the blocks of their prefixes, documents go to the
   blocks of what they met there; a pair is looked at in the block of the least shingle it met in.
3. Windows of an item's length in words are fingerprinted with SimHash. A block's items lie in a
   multi-index: the fingerprint is cut into four, and of two fingerprints within the radius some quarter
   differs in at most three bits, so looking up every quarter finds all of them. An exact weighted
   similarity of word shingles decides.
4. Fingerprints tell the similarity only roughly. Where what a window shares with an item weighs enough
   although its fingerprint is further away, it is compared too, and the find is marked as such.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.arrays import Words, mixed, pieces, shingle_hashes, word_hashes, words
from vitrine.llm.storage import quoted, stored

SHINGLE = 5
LEAST_SIMILARITY = 0.8
RADIUS = 15  # of 64 bits
BLOCKS, BLOCK_BITS = 4, 16
WRONG_BITS = RADIUS // BLOCKS  # in the best of the blocks
ITEM_BYTES = 2 << 20  # of items that a task holds at once, counting 256 more for each
PREFIX_BUCKETS = 1 << 24  # bits that say which shingles are in a prefix
_RANK_BITS = 20
_ROWS = 1 << 14  # words whose bits are summed at once

_FLIPS = np.array([0] + [sum(1 << b for b in c) for k in range(1, WRONG_BITS + 1) for c in combinations(range(BLOCK_BITS), k)], np.uint16)


class Item(NamedTuple):
    item_id: object
    hashes: np.ndarray  # of its words
    weights: np.ndarray  # bytes of its words
    prefix: np.ndarray  # shingles of which a document must have one


def _profile(shingles: np.ndarray, weights: np.ndarray) -> dict[int, int]:
    """Weight of each shingle; repeats add up."""
    out: dict[int, int] = {}
    for s, w in zip(shingles.tolist(), weights.tolist(), strict=True):
        out[s] = out.get(s, 0) + w
    return out


def _shingle_weights(weights: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(weights))
    return total[SHINGLE:] - total[:-SHINGLE]


def similarity(a: dict[int, int], b: dict[int, int]) -> float:
    """Weighted Jaccard similarity of two profiles."""
    shared = sum(min(w, b[s]) for s, w in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def prefix(profile: dict[int, int], rank: np.ndarray) -> np.ndarray:
    """Shingles that weigh more than a similar document may lack, those of the least rank first."""
    shingles = np.array(list(profile), np.uint64)
    weights = np.array(list(profile.values()), np.int64)
    order = np.lexsort((shingles, rank[(shingles >> np.uint64(64 - _RANK_BITS)).astype(np.int64)]))
    before = np.append(0, np.cumsum(weights[order])[:-1])
    return shingles[order][before <= (1 - LEAST_SIMILARITY) * weights.sum() * (1 + 1e-9)]


def _block_of(shingles: np.ndarray, n: int) -> np.ndarray:
    return (mixed(shingles) % np.uint64(n)).astype(np.int32)


def fingerprints(hashes: np.ndarray, weights: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first window, SimHash of each window of n words), in runs of bounded size."""
    count = len(hashes) - n + 1
    for a in range(0, count, _ROWS):
        b = min(count, a + _ROWS)
        part, own = hashes[a : b + n - 1], weights[a : b + n - 1]
        bits = np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int64)
        sums = np.zeros((len(part) + 1, 64), np.int64)
        np.cumsum((2 * bits - 1) * own[:, None], axis=0, out=sums[1:])
        up = (sums[n:] - sums[:-n]) > 0
        yield a, np.packbits(up, axis=1).view(">u8").ravel().astype(np.uint64)


def _blocks(prints: np.ndarray) -> np.ndarray:
    shifts = np.arange(BLOCKS, dtype=np.uint64) * np.uint64(BLOCK_BITS)
    return ((prints[:, None] >> shifts) & np.uint64(0xFFFF)).astype(np.int64)


class Index:
    """Multi-index of the items' fingerprints, and their shingles."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.n_words = np.array([len(i.hashes) for i in items], np.int64)
        self.profiles = [_profile(shingle_hashes(i.hashes, SHINGLE), _shingle_weights(i.weights)) for i in items]
        self.shingles = [np.array(list(p), np.uint64) for p in self.profiles]
        self.totals = np.array([sum(p.values()) for p in self.profiles], np.int64)
        flat = np.concatenate([*self.shingles, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(items)), [len(s) for s in self.shingles])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]
        self.flat_weights = np.array([w for p in self.profiles for w in p.values()], np.int64)[order]
        self.may = np.zeros(1 << 20, bool)
        self.may[(flat >> np.uint64(44)).astype(np.int64)] = True
        self.prints = np.array([next(fingerprints(i.hashes, i.weights, len(i.hashes)))[1][0] for i in items], np.uint64)
        self.lists = []
        for column in _blocks(self.prints).T if len(items) else ():
            near = (column.astype(np.uint16)[:, None] ^ _FLIPS[None, :]).ravel()
            order = np.argsort(near, kind="stable")
            starts = np.append(0, np.cumsum(np.bincount(near, minlength=1 << BLOCK_BITS)))
            self.lists.append((starts, np.repeat(np.arange(len(items), dtype=np.int32), len(_FLIPS))[order]))

    def sharing(self, shingles: np.ndarray) -> np.ndarray:
        """Which shingles an item has too."""
        hit = self.may[(shingles >> np.uint64(44)).astype(np.int64)]
        some = np.flatnonzero(hit)
        spot = np.minimum(np.searchsorted(self.flat, shingles[some]), len(self.flat) - 1)
        hit[some] = self.flat[spot] == shingles[some]
        return hit

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all fingerprints within the radius."""
        pairs = []
        for (starts, listed), values in zip(self.lists, _blocks(prints).T, strict=True):
            n = starts[values + 1] - starts[values]
            window = np.repeat(np.arange(len(prints)), n)
            inner = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)
            pairs.append(window * len(self.items) + listed[starts[values][window] + inner])
        pairs = np.unique(np.concatenate(pairs))
        window, item = pairs // len(self.items), pairs % len(self.items)
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[close], item[close]

    def possible(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Items of which a document with these shingles and weights has enough weight to be similar."""
        own, at = np.unique(shingles, return_inverse=True)
        held = np.bincount(at, weights)
        a, b = np.searchsorted(self.flat, own, "left"), np.searchsorted(self.flat, own, "right")
        spot = np.repeat(a - np.append(0, np.cumsum(b - a)[:-1]), b - a) + np.arange((b - a).sum())
        shared = np.bincount(self.owner[spot], np.minimum(self.flat_weights[spot], np.repeat(held, b - a)), len(self.items))
        return np.flatnonzero((shared > 0) & (shared >= LEAST_SIMILARITY * self.totals * (1 - 1e-9)))

    def find(self, hashes: np.ndarray, weights: np.ndarray, shingles: np.ndarray, shared: np.ndarray, place=(0, 1)) -> dict[int, tuple[float, int, bool]]:
        """item -> (similarity, first word, whether within the radius) of its best window in a document, where that suffices.

        `place` is the block that is looked at and how many there are.
        """
        out: dict[int, tuple[float, int, bool]] = {}
        rows = np.flatnonzero(shared)
        of_shingle = _shingle_weights(weights)
        may = self.possible(shingles[rows], of_shingle[rows])
        held = np.unique(shingles[rows])
        may = np.array([i for i in may.tolist() if self._is_here(i, held, place)], np.int64)
        total = np.append(0, np.cumsum(of_shingle))
        for n in np.unique(self.n_words[may]).tolist():
            size = min(n, len(hashes))
            span = size - SHINGLE + 1
            near: dict[int, list[int]] = {}
            for first, prints in fingerprints(hashes, weights, size):
                window, item = self.near(prints)
                for w, i in zip((window + first).tolist(), item.tolist(), strict=True):
                    near.setdefault(i, []).append(w)
            for i in may[self.n_words[may] == n].tolist():
                # the weight that a window shares bounds its similarity
                mine = np.zeros(len(of_shingle), np.int64)
                hit = rows[np.isin(shingles[rows], self.shingles[i])]
                mine[hit] = of_shingle[hit]
                sums = np.append(0, np.cumsum(mine))
                most = np.minimum(sums[span:] - sums[:-span], self.totals[i])
                bound = most / (self.totals[i] + total[span:] - total[:-span] - most)
                best, at, inside = LEAST_SIMILARITY, -1, False
                windows = np.unique(np.array(near.get(i, []), np.int64))
                for by_radius in (True, False):
                    windows = windows if by_radius else np.arange(len(bound))
                    windows = windows[bound[windows] >= best]
                    for w in windows[np.argsort(-bound[windows], kind="stable")].tolist():
                        if at >= 0 and (bound[w], -w) <= (best, -at):
                            break
                        s = similarity(_profile(shingles[w : w + span], of_shingle[w : w + span]), self.profiles[i])
                        if s >= LEAST_SIMILARITY and (at < 0 or (s, -w) > (best, -at)):
                            best, at, inside = s, w, inside or by_radius
                if at >= 0:
                    out[i] = (best, at, inside)
        return out

    def _is_here(self, i: int, held: np.ndarray, place: tuple[int, int]) -> bool:
        met = np.intersect1d(self.items[i].prefix, held)
        return len(met) > 0 and int(_block_of(met[:1], place[1])[0]) == place[0]

    def batch(self, batch: pa.RecordBatch, column: int, place: tuple[int, int]) -> Iterator[tuple[int, dict[int, tuple[float, int, bool]]]]:
        """(row, found items) of the rows with a find."""
        for i, w, hashes, shingles in _documents(batch, column):
            shared = self.sharing(shingles)
            hits = np.flatnonzero(shared)
            docs = np.searchsorted(w.first, hits, "right") - 1
            for d in np.unique(docs[hits + SHINGLE <= w.first[docs + 1]]).tolist():
                a, b = int(w.first[d]), int(w.first[d + 1])
                own = slice(a, b - SHINGLE + 1)
                found = self.find(hashes[a:b], (w.ends - w.starts)[a:b], shingles[own], shared[own], place)
                if found:
                    yield i + d, found


def _documents(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, Words, np.ndarray, np.ndarray]]:
    """(first row, words, their hashes, hashes of shingles) of runs of rows."""
    for i, _, data, offsets in pieces(batch, column):
        w = words(data, offsets)
        hashes = word_hashes(data, w)
        yield i, w, hashes, shingle_hashes(hashes, SHINGLE)


# --- the items ------------------------------------------------------------------------------------


def _items(texts: list[str], ids: list | None = None, prefixes: list | None = None) -> list[Item]:
    """The items of at least a shingle; without ids their row numbers serve."""
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    out = []
    for i, w, hashes, _ in _documents(batch, 0):
        for k in range(len(w.first) - 1):
            a, b = w.first[k], w.first[k + 1]
            if b - a >= SHINGLE:
                own = np.array(prefixes[i + k] if prefixes else [], np.int64).view(np.uint64)
                out.append(Item(ids[i + k] if ids else i + k, hashes[a:b], (w.ends - w.starts)[a:b], own))
    return out


def _ranks(own: DataFrame) -> np.ndarray:
    """How often items have a shingle of each bucket: a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _RANK_BITS, np.int64)
        for batch in batches:
            for item in _items(batch.column(1).to_pylist()):
                np.add.at(counts, (shingle_hashes(item.hashes, SHINGLE) >> np.uint64(64 - _RANK_BITS)).astype(np.int64), 1)
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(counts[hit])], names=["bucket", "n"])

    rows = own.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    rank = np.zeros(1 << _RANK_BITS, np.int64)
    rank[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return rank


class Placed(NamedTuple):
    items: DataFrame  # item_id, text, prefix, block
    parts: list[tuple[int, int]]  # blocks with items, and in how many parts a task can hold them
    n_blocks: int
    met: np.ndarray  # bits of PREFIX_BUCKETS: buckets of shingles in a prefix


def _placed(items: DataFrame, id_col: str, text_col: str, size: int) -> Placed:
    """The distinct items in the blocks of their prefixes. Of items the driver gets counts and a bitmap of fixed size."""
    own = stored(items.select(F.col(id_col).alias("item_id"), F.lower(text_col).alias("text")).filter("text is not null").distinct(), "benchmark")
    cost = F.octet_length("text") + 256
    n_blocks = max(1, -(-(own.agg(F.sum(cost)).first()[0] or 0) // size))
    rank = own.sparkSession.sparkContext.broadcast(_ranks(own))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, prefixes = [], []
            for item in _items(batch.column(1).to_pylist()):
                shingles = _profile(shingle_hashes(item.hashes, SHINGLE), _shingle_weights(item.weights))
                rows.append(item.item_id)
                prefixes.append(prefix(shingles, rank.value).view(np.int64))
            blocks = [np.unique(_block_of(p.view(np.uint64), n_blocks)) for p in prefixes]
            yield pa.RecordBatch.from_arrays([
                *(c.take(pa.array(rows, pa.int64())) for c in batch.columns), pa.array(prefixes, pa.list_(pa.int64())), pa.array(blocks, pa.list_(pa.int32())),
            ], names=["item_id", "text", "prefix", "blocks"])

    schema = T.StructType([*own.schema.fields, *T._parse_datatype_string("prefix array<long>, blocks array<int>").fields])
    placed = stored(own.mapInArrow(run, schema).select("item_id", "text", "prefix", F.explode("blocks").alias("block")), "benchmark-blocks", ["block"])
    parts = [(r.block, -(-r.cost // size)) for r in placed.groupBy("block").agg(F.sum(cost).alias("cost")).orderBy("block").collect()]
    bucket = F.explode(F.transform("prefix", lambda s: F.shiftrightunsigned(s, 64 - (PREFIX_BUCKETS.bit_length() - 1)).cast("int"))).alias("bucket")
    met = np.zeros(PREFIX_BUCKETS, bool)
    met[placed.select(bucket).distinct().toArrow()["bucket"].to_numpy()] = True
    return Placed(placed, parts, n_blocks, np.packbits(met))


# --- the documents --------------------------------------------------------------------------------


def _blocks_met(batch: pa.RecordBatch, column: int, met: np.ndarray, n_blocks: int) -> list[np.ndarray]:
    """For each row the blocks of the shingles that may be in an item's prefix."""
    out = [np.zeros(0, np.int32)] * batch.num_rows
    for i, w, _, shingles in _documents(batch, column):
        bucket = shingles >> np.uint64(64 - (PREFIX_BUCKETS.bit_length() - 1))
        hits = np.flatnonzero((met[(bucket >> np.uint64(3)).astype(np.int64)] >> (7 - (bucket & np.uint64(7)).astype(np.uint8))) & 1)
        docs = np.searchsorted(w.first, hits, "right") - 1
        inner = hits + SHINGLE <= w.first[docs + 1]
        hits, docs = hits[inner], docs[inner]
        blocks = _block_of(shingles[hits], n_blocks)
        docs, first = np.unique(docs, return_index=True)
        for d, own in zip(docs.tolist(), np.split(blocks, first[1:]), strict=False):
            out[i + d] = np.unique(own)
    return out


def _split(packed: DataFrame, placed: Placed) -> tuple[DataFrame, DataFrame]:
    """Rows (row, text) that met a prefix, stored as (place, row, text, block) by block, and all other rows, as (row)."""
    held = packed.sparkSession.sparkContext.broadcast(placed.met)
    n_blocks = placed.n_blocks

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = _blocks_met(batch, 1, held.value, n_blocks)
            rows = pa.array([k for k, b in enumerate(blocks) if len(b)], pa.int64())
            found = pa.array([b for b in blocks if len(b)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns), found], names=["row", "text", "blocks"])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([k for k, b in enumerate(_blocks_met(batch, 1, held.value, n_blocks)) if not len(b)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows)], names=["row"])

    schema = T.StructType([*packed.schema.fields, T.StructField("blocks", T.ArrayType(T.IntegerType()))])
    rows = packed.mapInArrow(met, schema).withColumn("place", F.monotonically_increasing_id())
    rows = rows.select("place", "row", "text", (F.col("blocks")[0]).alias("main"), F.explode("blocks").alias("block"))
    return stored(rows, "benchmark-met", ["block"]), packed.mapInArrow(clean, packed.select("row").schema)


_indexes: dict[str, Index] = {}


def _finds(rows: DataFrame, placed: Placed, size: int) -> Iterator[DataFrame]:
    """place, row, item_id, similarity, first_word, n_words, in_radius of the finds, one written table for each part of a block."""
    item_type = placed.items.schema["item_id"].dataType
    schema = T.StructType([
        *rows.select("place", "row").schema.fields, T.StructField("item_id", item_type),
        *T._parse_datatype_string("similarity double, first_word long, n_words long, in_radius boolean").fields,
    ])
    for block, n in placed.parts:
        for part in range(n):
            own = placed.items.filter(F.col("block") == block).filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == part).orderBy("item_id", "text").collect()
            items = _items([r.text for r in own], [r.item_id for r in own], [r.prefix for r in own])
            if not items:
                continue
            held, key = rows.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

            def run(batches: Iterator[pa.RecordBatch], held=held, key=key, place=(block, placed.n_blocks)) -> Iterator[pa.RecordBatch]:
                if key not in _indexes:  # built once a worker
                    _indexes.clear()
                    _indexes[key] = Index(held.value)
                index = _indexes[key]
                for batch in batches:
                    found = [(row, index.items[i], *hit) for row, hits in index.batch(batch, 2, place) for i, hit in sorted(hits.items())]
                    taken = pa.array([f[0] for f in found], pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(taken), batch.column(1).take(taken), pa.array([f[1].item_id for f in found], _arrow(item_type)),
                        pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int64()),
                        pa.array([len(f[1].hashes) for f in found], pa.int64()), pa.array([f[4] for f in found], pa.bool_()),
                    ], names=schema.names)

            yield stored(rows.filter(F.col("block") == block).select("place", "row", "text").mapInArrow(run, schema), "benchmark-finds")
            held.unpersist()


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def find_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", size: int = ITEM_BYTES,
) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words, in_radius: one row for each item found in a document.

    in_radius: some window similar enough has a fingerprint within the radius of the item's, so the
    multi-index finds the item by itself. Words are compared in lower case. Null and empty texts hold
    nothing, and items of under five words have no shingle and are not found. Repeated items count once,
    repeated documents each; empty tables give an empty result; other columns are ignored.
    """
    placed = _placed(items, item_col, item_text, size)
    rows, _ = _split(docs.select(F.struct(F.col(id_col).alias("doc_id")).alias("row"), F.lower(text_col).alias("text")), placed)
    fields = [F.col("row.doc_id").alias("doc_id"), "item_id", "similarity", "first_word", "n_words", "in_radius"]
    found = [f.select(*fields) for f in _finds(rows, placed, size)]
    if found:
        return reduce(DataFrame.union, found)
    empty = docs.limit(0).select(F.col(id_col).alias("doc_id"), F.lit(None).cast(items.schema[item_col].dataType).alias("item_id"))
    return empty.selectExpr("*", "cast(0 as double) similarity", "0L first_word", "0L n_words", "false in_radius")


def clean_documents(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = ITEM_BYTES
) -> DataFrame:
    """The rows of `docs` in which no item is found; columns unchanged.

    The documents are read twice whatever the number of items: for those that met a prefix, and for all others.
    """
    placed = _placed(items, item_col, item_text, size)
    rows, clean = _split(docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), F.lower(text_col).alias("text")), placed)
    once = rows.filter("block = main")
    found = [f.select(F.col("place").alias("of")) for f in _finds(rows, placed, size)]
    if found:
        places = stored(reduce(DataFrame.union, found).distinct(), "benchmark-places")
        once = once.join(places, F.col("place") == F.col("of"), "left_anti")
    return clean.union(once.select("row")).select("row.*")
