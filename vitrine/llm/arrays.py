"""Texts of an Arrow batch as flat numpy arrays: words, their hashes, and pieces of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

PIECE = 1 << 20  # bytes of text worked on at once, or one document if that is longer

#: White space of the word rule: [\x20\x09-\x0D].
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C55)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of 64-bit hashes: every bit of the input reaches every bit of the output."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[i] = np.cumprod(table)
    return _powers


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every range, from one running sum; values are 64-bit hashes."""
    power, inverse = _powers_to(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=sums[1:])
    sums = (sums[ends] - sums[starts]) * inverse[starts]
    return mixed(sums + (ends - starts).astype(np.uint64) * _BASE)


class Words(NamedTuple):
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    first: np.ndarray  # first word of each document, and the number of words


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of documents that lie one after another in `data`."""
    space = _SPACE[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:] = space[:-1]
    after[:-1] = space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = True
    after[inner - 1] = True
    solid = ~space
    starts = np.flatnonzero(solid & before)
    return Words(starts, np.flatnonzero(solid & after) + 1, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, w: Words) -> np.ndarray:
    return range_hashes(_BYTE[data], w.starts, w.ends)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` words from a word on; those that cross a document's end are for the caller to drop."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        total = total * _BASE + hashes[k : k + len(total)]
    return mixed(total)


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows; null texts are empty."""
    text = batch.column(column)
    text = text.cast(pa.large_string()).fill_null("")
    _, offsets, data = text.buffers()
    if not len(text):
        return
    offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    i = 0
    while i < len(text):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def sums_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of `values` over each document's range."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def code_points(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each character."""
    return (data & 0xC0) != 0x80


def map_texts(
    docs: DataFrame,
    id_cols: list[str],
    text_col: str,
    fields: str,
    work: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch | list]],
) -> DataFrame:
    """id columns and the columns of `fields` (a schema in DDL) for each document, batch by batch.

    `work` gets a batch of id columns and, last, the text; it gives the arrays of the new columns.
    """
    own = docs.select(*id_cols, text_col)
    schema = T.StructType([*own.schema.fields[:-1], *T._parse_datatype_string(fields).fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = work(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(id_cols)], *new], names=names)

    return own.mapInArrow(run, schema)
