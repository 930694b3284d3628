"""Minimal perfect hashing of distinct 64-bit keys, as plain numpy arrays.

Each level has somewhat more places than keys. Keys that meet no other key at their place are
settled there; the rest go on to the next level. The number of settled places before a key's own
is its index: n keys get the indexes 0 to n - 1, with some three bits for each key.
"""

from __future__ import annotations

import numpy as np

from cyclograph.llm.words import mixed

PLACES_PER_KEY = 1.5
_SEED = np.uint64(0x9E3779B97F4A7C15)

Levels = tuple[np.ndarray, np.ndarray, np.ndarray]
"""First word of each level and the end; 64 places a word; settled places before each word."""


def _place(keys: np.ndarray, level: int, places: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(keys ^ (np.uint64(level + 1) * _SEED)) % np.uint64(places)


def build(keys: np.ndarray) -> tuple[Levels, np.ndarray]:
    """(levels, keys in the order of their indexes); ``keys`` are distinct unsigned 64-bit values."""
    rest, words, first, order = keys.astype(np.uint64), [], [0], []
    while len(rest):
        n_words = -(-int(PLACES_PER_KEY * len(rest) + 1) // 64)
        place = _place(rest, len(words), 64 * n_words)
        alone = np.bincount(place, minlength=64 * n_words) == 1
        settled = alone[place]
        order.append(rest[settled][np.argsort(place[settled])])
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        first.append(first[-1] + n_words)
        rest = rest[~settled]
    bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])[:-1].astype(np.int64)
    return (np.array(first, np.int64), bits, before), np.concatenate(order) if order else keys.astype(np.uint64)


def find(levels: Levels, ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The index of each key, or -1 where the key stored there is another one."""
    first, bits, before = levels
    keys = keys.astype(np.uint64)
    out = np.full(len(keys), -1, np.int64)
    todo = np.arange(len(keys))
    for level in range(len(first) - 1):
        if not len(todo):
            break
        place = _place(keys[todo], level, 64 * int(first[level + 1] - first[level]))
        word = first[level] + (place >> np.uint64(6)).astype(np.int64)
        bit = np.uint64(1) << (place & np.uint64(63))
        hit = (bits[word] & bit) != 0
        at, lower = word[hit], bit[hit] - np.uint64(1)
        out[todo[hit]] = before[at] + np.bitwise_count(bits[at] & lower)
        todo = todo[~hit]
    if len(ordered):
        out[(out >= 0) & (ordered[out] != keys)] = -1
    return out
