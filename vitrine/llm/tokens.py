"""Counts tokens of a piece vocabulary by rank-synchronous array merging.

Characters between which no piece of the vocabulary reaches can never merge, so texts are cut there
into pre-tokens. The distinct pre-tokens of a batch lie in one ragged numpy array of symbols. A round
applies in every sequence at once the pair of its lowest rank; sequences without a pair leave the
array. What survives is counted, and documents sum the counts of their pre-tokens.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitrine.llm.arrays import map_texts, mixed, pieces, range_hashes

LIMIT = 4096
SPACE = 0x2581  # stands for a space, and before each text
NEVER = np.iinfo(np.int32).max
_JOIN_BITS = 20
_KEPT = 1 << 20  # pre-tokens a task remembers; beyond, it starts afresh


class Vocabulary(NamedTuple):
    """Bounded tables of a vocabulary, sent to the tasks."""

    chars: np.ndarray  # code points that occur in pieces, ascending
    char_ids: np.ndarray  # their symbols
    weights: np.ndarray  # tokens a symbol counts for
    keys: np.ndarray  # left * size + right of the pairs that merge, ascending
    products: np.ndarray  # symbols they become
    ranks: np.ndarray  # by symbol
    whole: np.ndarray  # by symbol: all its pairs in a sequence may merge in one round


def load(path: str) -> Vocabulary:
    """Reads pieces and scores of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [
        i for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    scores = {model.id_to_piece(i): model.get_score(i) for i in normal}
    return tables(scores)


def tables(scores: dict[str, float]) -> Vocabulary:
    order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
    chars = sorted({c for piece in scores for c in piece})
    ids = {piece: i for i, piece in enumerate(scores)}
    for c in chars:  # characters that are only parts of pieces
        ids.setdefault(c, len(ids))
    size = len(ids)
    ranks = np.full(size, NEVER, np.int32)
    weights = np.ones(size, np.int32)
    for piece, i in ids.items():
        if piece in scores:
            ranks[i] = order[scores[piece]]
        else:
            weights[i] = len(piece.encode())
    pairs = {
        ids[piece[:k]] * size + ids[piece[k:]]: ids[piece]
        for piece in scores
        for k in range(1, len(piece))
        if piece[:k] in ids and piece[k:] in ids
    }
    keys = np.array(sorted(pairs), np.int64)
    products = np.array([pairs[k] for k in keys.tolist()], np.int64)
    # merging all pairs at once gives what one after another does, unless a product can merge on at
    # a rank not above its own, or other symbols share its rank
    onward = np.full(size, NEVER, np.int32)
    for part in (keys // size, keys % size) if len(keys) else ():
        np.minimum.at(onward, part, ranks[products])
    shared = np.bincount(ranks[ranks < NEVER], minlength=1) > 1
    whole = (onward > ranks) & (ranks < NEVER)
    whole[ranks < NEVER] &= ~shared[ranks[ranks < NEVER]]
    return Vocabulary(
        np.array([ord(c) for c in chars], np.int64), np.array([ids[c] for c in chars], np.int64),
        weights, keys, products, ranks, whole,
    )


class Counter:
    """Token counts of texts; remembers the counts of pre-tokens it has met."""

    def __init__(self, v: Vocabulary):
        self.v, self.size = v, len(v.weights)
        self.symbol = np.full(0x110000, -1, np.int64)
        self.symbol[v.chars] = v.char_ids
        self.joins = self._joins()
        self.point = mixed(np.arange(1, 0x110001, dtype=np.uint64))
        self.known, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def _slot(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        both = (left.astype(np.uint64) << np.uint64(21)) + right.astype(np.uint64)
        return (both * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _JOIN_BITS)).astype(np.int64)

    def _joins(self) -> np.ndarray:
        """True at the slot of two characters that stand side by side in a piece (others may share the slot)."""
        v = self.v
        edge = {int(s): (int(c), int(c)) for c, s in zip(v.chars, v.char_ids, strict=True)}
        parts: dict[int, tuple[int, int]] = {}
        for k, p in zip(v.keys.tolist(), v.products.tolist(), strict=True):
            parts[p] = divmod(k, self.size)

        def ends(s: int) -> tuple[int, int]:
            if s not in edge:
                left, right = parts[s]
                edge[s] = (ends(left)[0], ends(right)[1])
            return edge[s]

        pairs = np.array([(ends(k // self.size)[1], ends(k % self.size)[0]) for k in v.keys.tolist()], np.int64)
        joins = np.zeros(1 << _JOIN_BITS, bool)
        if len(pairs):
            joins[self._slot(pairs[:, 0], pairs[:, 1])] = True
        return joins

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text."""
        n_docs = len(offsets) - 1
        out = np.zeros(n_docs, np.int64)
        if not len(data):
            return out
        lead = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        at = lead[offsets]
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
        filled = np.flatnonzero(at[1:] > at[:-1])
        points = np.insert(points, at[filled], SPACE)
        at = at[filled] + np.arange(len(filled))
        points[points == 32] = SPACE
        cut = np.ones(len(points), bool)
        cut[1:] = ~self.joins[self._slot(points[:-1], points[1:])]
        cut[at] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(points))
        hashes = range_hashes(self.point[points], starts, ends)
        unique, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        per = self._remembered(unique, points, starts[where], ends[where])[back]
        sums = np.append(0, np.cumsum(per))
        first = np.append(np.searchsorted(starts, at), len(starts))
        out[filled] = sums[first[1:]] - sums[first[:-1]]
        return out

    def _remembered(self, hashes: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        spot = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        met = self.known[spot] == hashes if len(self.known) else np.zeros(len(hashes), bool)
        counts = np.zeros(len(hashes), np.int64)
        if len(self.known):
            counts[met] = self.counts[spot[met]]
        new = ~met
        if new.any():
            length = (ends - starts)[new]
            base = np.repeat(starts[new] - (np.cumsum(length) - length), length)
            counts[new] = self.merged(self.symbol[points[base + np.arange(len(base))]], points[base + np.arange(len(base))], length)
            if len(self.known) > _KEPT:
                self.known, self.counts = self.known[:0], self.counts[:0]
            known = np.append(self.known, hashes[new])
            order = np.argsort(known, kind="stable")
            self.known, self.counts = known[order], np.append(self.counts, counts[new])[order]
        return counts

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of each pair."""
        key = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        spot = np.minimum(np.searchsorted(self.v.keys, key), max(len(self.v.keys) - 1, 0))
        if not len(self.v.keys):
            return np.full(len(key), NEVER, np.int32), spot
        product = np.where(self.v.keys[spot] == key, self.v.products[spot], -1)
        return np.where(product >= 0, self.v.ranks[product], NEVER).astype(np.int32), product

    def merged(self, symbols: np.ndarray, points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Surviving tokens of each sequence; `symbols` holds the sequences one after another."""
        out = np.zeros(len(lengths), np.int64)
        # a character outside the vocabulary falls back to its bytes and never merges
        width = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
        own = np.where(symbols < 0, width, self.v.weights[symbols])
        seq = np.repeat(np.arange(len(lengths)), lengths)
        rank, product = np.full(len(symbols), NEVER, np.int32), np.full(len(symbols), -1, np.int64)
        inside = np.flatnonzero(seq[:-1] == seq[1:])
        rank[inside], product[inside] = self._pairs(symbols[inside], symbols[inside + 1])
        while len(symbols):
            first = np.flatnonzero(np.append(True, seq[1:] != seq[:-1]))
            length = np.diff(np.append(first, len(seq)))
            least = np.minimum.reduceat(rank, first)
            done = least == NEVER
            if done.any():
                out[seq[first[done]]] = np.add.reduceat(own, first)[done]
                stay = np.repeat(~done, length)
                symbols, own, seq, rank, product = symbols[stay], own[stay], seq[stay], rank[stay], product[stay]
                least, length = least[~done], length[~done]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(least, length))
            leftmost = np.append(True, seq[hit[1:]] != seq[hit[:-1]])
            take = leftmost | self.v.whole[product[hit]]
            # of overlapping pairs (a a a) every other one, from the left
            begin = np.append(True, hit[1:] != hit[:-1] + 1)
            take &= (hit - np.maximum.accumulate(np.where(begin, hit, 0))) % 2 == 0
            hit = hit[take]
            symbols[hit] = product[hit]
            own[hit] = self.v.weights[symbols[hit]]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            symbols, own, seq, rank, product = symbols[stay], own[stay], seq[stay], rank[stay], product[stay]
            hit = hit - np.arange(len(hit))
            near = np.unique(np.concatenate([hit, hit[hit > 0] - 1]))
            rank[near], product[near] = NEVER, -1
            near = near[near < len(seq) - 1]
            near = near[seq[near] == seq[near + 1]]
            rank[near], product[near] = self._pairs(symbols[near], symbols[near + 1])
        return out


_counters: dict[str, Counter] = {}


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document.

    Null and empty texts have 0 bytes and 0 tokens. Rows are independent, so repeated rows give
    repeated results and an empty table an empty one; other columns are ignored. Memory follows the
    longest text. The model file is read on the driver; its tables (bounded) go with the tasks.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(load(model_path))

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        counter = _counters.setdefault(model_path, None) or Counter(vocabulary.value)
        _counters[model_path] = counter
        n_bytes, n_tokens = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for i, j, data, offsets in pieces(batch, 1):
            n_bytes[i:j] = np.diff(offsets)
            n_tokens[i:j] = counter.texts(data, offsets)
        return [pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)]

    return map_texts(docs, [id_col], text_col, "n_bytes long, n_tokens long, over_limit boolean", work).withColumnRenamed(id_col, "doc_id")
