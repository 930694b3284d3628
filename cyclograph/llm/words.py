"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes of one class; it is known by a 64-bit hash, and a run of
k words by a hash of its word hashes. Nothing here decodes text or loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

CHUNK_BYTES = 1 << 19
"""Texts are handled together up to this size; a longer text is handled alone."""

BATCH_ROWS = 1000
"""Rows that travel to Python at once, where texts are long."""


def small_batches(spark: SparkSession) -> None:
    """Let whole texts go to Python in batches of a few MB instead of Spark's 10 000 rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

_PAGE = 4096
_random = np.random.default_rng(20240229)
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(np.uint64(0xD6E8FEB86659FD93), _PAGE)
_PAGE_BASE = (_POWER[-1:] * _POWER[1])[0]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that their order and their low bits look random."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_class(inside) -> np.ndarray:
    """256 flags: the bytes of which words are made."""
    return np.array([bool(inside(b)) for b in range(256)])


NOT_BLANK = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
"""Words ``[^\\x20\\x09-\\x0D]+``."""

ALNUM = byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
"""Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of lower-cased text, and capitals before lower-casing."""

LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)
"""A-Z to a-z, other bytes unchanged."""


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive texts; a null is an empty text."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        end = min(end, len(column))
        part = offsets[row : end + 1]
        yield row, data[part[0] : part[-1]], part - part[0]
        row = end


@dataclass
class Words:
    """The words of a chunk: byte spans, hashes, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # word index at which text i begins; one more entry at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(word index, hash) of every run of k words inside one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = self.hashes[:n].copy()
        for j in range(1, k):
            h *= _ODD
            h += self.hashes[j : n + j]
        last = np.repeat(self.first[1:], self.counts())
        at = np.flatnonzero(np.arange(n) + k <= last[:n])
        return at, mixed(h[at])


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_BLANK) -> Words:
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    mask = inside[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = False
    before[1:], after[:-1] = mask[:-1], mask[1:]
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    if not len(starts):
        return Words(starts, ends, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    lengths = ends - starts
    at = np.flatnonzero(mask)
    first_byte = np.cumsum(lengths) - lengths
    place = np.arange(len(at)) - np.repeat(first_byte, lengths)
    value = _BYTE[data[at]] * _POWER[place & (_PAGE - 1)]
    if int(lengths.max()) > _PAGE:
        value *= _powers(_PAGE_BASE, int(lengths.max()) // _PAGE + 1)[place // _PAGE]
    hashes = mixed(np.add.reduceat(value, first_byte) + lengths.astype(np.uint64))
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def word_counts(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_BLANK) -> np.ndarray:
    """Number of words of each text."""
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    begins = inside[data]
    before = np.concatenate([[False], begins[:-1]])
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    begins = np.concatenate([[0], np.cumsum(begins & ~before)])
    return np.diff(begins[offsets])
