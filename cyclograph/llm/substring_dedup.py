"""Substring dedup: remove every run of MIN_WORDS words that also begins somewhere else.

The reference a document is held against is the corpus itself, cut into shards that meet all
their matches. A window of MIN_WORDS words belongs to its anchor, the run of ANCHOR words in it
whose hash is least, so equal windows have equal anchors; the windows of one anchor at one place
form a segment. Anchors that occur once need no further look. The segments of a repeated anchor
are a reference shard: its suffix automaton, with the number of times each state occurs, gives
each segment's matching statistics, that is, for each word the longest run ending there that
occurs twice; windows inside a match go.

Sending the automata of all shards to all documents would take work in the square of the corpus,
so a shard meets just the documents that hold its anchor. An anchor with over SHARD_SEGMENTS
different segments is no shard for one task: its windows, each with the number of its occurrences,
are dealt by their hash to as many shards, each with an automaton of its own, as keep a shard to
about SHARD_WINDOWS windows; equal windows meet in one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cyclograph.llm.columns import free_prefix, others
from cyclograph.llm.words import Words, mixed, text_chunks, words_of
from cyclograph.session import materialize

MIN_WORDS = 35
ANCHOR = 8
REACH = MIN_WORDS - ANCHOR + 1
"""Anchors a window can have, and so the most windows of one segment."""
SHARD_SEGMENTS = 500
SHARD_WINDOWS = 500

_ODD = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = 26
_FLUSH = 10_000
"""Rows after which a task hands on what it found."""


def _least(grams: np.ndarray) -> np.ndarray:
    """Place of the least of each REACH consecutive values, the first one among equals."""
    low = np.uint64((1 << max(_PLACE_BITS, len(grams).bit_length())) - 1)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= REACH:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < REACH:
        key = np.minimum(key[: len(key) - (REACH - width)], key[REACH - width :])
    return (key & low).astype(np.int64)


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def segments_of(words: Words) -> tuple[np.ndarray, ...]:
    """(anchor, hash of the segment's words, text, first window, number of windows) of each segment.

    Windows are numbered by the words of their text.
    """
    n = len(words.hashes) - MIN_WORDS + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    grams = words.hashes[: len(words.hashes) - ANCHOR + 1].copy()
    for j in range(1, ANCHOR):
        grams *= _ODD
        grams += words.hashes[j : len(grams) + j]
    grams = mixed(grams)
    text = words.text_of_word()[:n]
    inside = np.flatnonzero(np.arange(n) + MIN_WORDS <= words.first[text + 1])
    least, text = _least(grams)[inside], text[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(inside)))
    first = inside[begin]
    total = len(words.hashes)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.hashes * _powers(total, _ODD))])
    end = first + length + MIN_WORDS - 1
    whole = (sums[end] - sums[first]) * _powers(total, np.uint64(pow(int(_ODD), -1, 1 << 64)))[first]
    whole = mixed(whole + length.astype(np.uint64) * _ODD)
    anchors = grams[least[begin]]
    return anchors.view(np.int64), whole.view(np.int64), text[begin], first - words.first[text[begin]], length


def _chunks(column: pa.Array) -> Iterator[tuple[int, Words]]:
    for row, data, offsets in text_chunks(column):
        yield row, words_of(data, offsets)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, segment, key, n): the distinct segments of each row, with their number in it."""
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for row, words in _chunks(batch.column(1)):
            anchor, segment, text, _, _ = segments_of(words)
            order = np.lexsort((segment, text))
            anchor, segment, text = anchor[order], segment[order], text[order]
            new = np.ones(len(text), bool)
            new[1:] = (segment[1:] != segment[:-1]) | (text[1:] != text[:-1])
            begin = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor[begin]),
                    pa.array(segment[begin]),
                    pa.array(keys[row + text[begin]]),
                    pa.array(np.diff(np.append(begin, len(text)))),
                ],
                names=["anchor", "segment", "key", "n"],
            )


def _anchor_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, n), counted over each chunk of texts."""
    for batch in batches:
        for _, words in _chunks(batch.column(0)):
            anchor, n = np.unique(segments_of(words)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n)], names=["anchor", "n"])


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(anchor, segment, n, words, first word, windows) of the wanted segments of each row, each once."""
    for batch in batches:
        wanted = batch.column(2).to_pylist()
        for row, words in _chunks(batch.column(1)):
            anchor, segment, text, first, length = segments_of(words)
            cuts = np.searchsorted(text, np.arange(len(words.first)))
            for i in range(len(words.first) - 1):
                want = {w["segment"]: w["n"] for w in wanted[row + i]}
                for s in range(cuts[i], cuts[i + 1]):
                    n = want.pop(int(segment[s]), None)
                    if n is not None:
                        begin = int(words.first[i] + first[s])
                        yield int(anchor[s]), int(segment[s]), n, words, begin, int(length[s])


def _rows(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= _FLUSH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held.clear()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _schema(**fields: pa.DataType) -> pa.Schema:
    return pa.schema(list(fields.items()))


def _segment_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, part, n, words): the word hashes of each wanted segment; its anchor is its shard."""

    def rows() -> Iterator[tuple]:
        for anchor, segment, n, words, begin, length in _wanted(batches):
            yield anchor, segment, n, words.hashes[begin : begin + length + MIN_WORDS - 1].tobytes()

    return _rows(rows(), _schema(shard=pa.int64(), part=pa.int64(), n=pa.int64(), words=pa.binary()))


def _segment_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, segment, n, place, window, words): hash and words of each window of the wanted segments.

    The words come with the first of equal windows in a chunk of texts, and are null in the others.
    """

    def rows() -> Iterator[tuple]:
        chunk, known = None, set()
        for anchor, segment, n, words, begin, length in _wanted(batches):
            if words is not chunk:
                chunk, known = words, set()
                at, hashes = words.windows(MIN_WORDS)
                hashes = hashes.view(np.int64)
            first = int(np.searchsorted(at, begin))
            for place, window in enumerate(hashes[first : first + length].tolist()):
                part = None
                if window not in known:
                    known.add(window)
                    part = words.hashes[begin + place : begin + place + MIN_WORDS].tobytes()
                yield anchor, segment, n, place, window, part

    i64 = pa.int64()
    return _rows(rows(), _schema(anchor=i64, segment=i64, n=i64, place=pa.int32(), window=i64, words=pa.binary()))


class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the number of times each state occurs."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _extend(self, last: int, word: int) -> int:
        following, link, length = self.next, self.link, self.length
        known = following[last].get(word)
        if known is not None:
            if length[known] == length[last] + 1:
                return known
            return self._split(last, word, known)
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        self.count.append(0)
        p = last
        while p >= 0 and word not in following[p]:
            following[p][word] = new
            p = link[p]
        if p >= 0:
            q = following[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        clone = len(self.next)
        self.next.append(self.next[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.count.append(0)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], times: int = 1) -> None:
        last = 0
        for word in sequence:
            last = self._extend(last, word)
            self.count[last] += times

    def close(self) -> None:
        """Sum the counts up the suffix links, once all sequences are in."""
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def statistics(self, sequence: list[int], times: int = 2) -> Iterator[int]:
        """For each word, the length of the longest run ending there that occurs so many times."""
        state = matched = 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            up = state
            while up and self.count[up] < times:
                up = self.link[up]
            yield matched if up == state else self.length[up]


def _shard_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, part, mask): which windows of each part repeat, judged by its shard's automaton.

    Rows (shard, part, n, words) come sorted by shard; a part's words are n times in the corpus.
    """

    def masks(shard: int, held: dict[int, tuple[int, list[int]]]) -> Iterator[tuple]:
        automaton = SuffixAutomaton()
        for n, words in held.values():
            automaton.add(words, n)
        automaton.close()
        for part, (_, words) in held.items():
            mask = 0
            for end, matched in enumerate(automaton.statistics(words), 1):
                if matched >= MIN_WORDS:
                    mask |= 1 << (end - MIN_WORDS)
            if mask:
                yield shard, part, mask

    def rows() -> Iterator[tuple]:
        current, held = None, {}
        for batch in batches:
            for shard, part, n, words in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != current:
                    if held:
                        yield from masks(current, held)
                    current, held = shard, {}
                held[part] = (n, np.frombuffer(words, np.uint64).tolist())
        if held:
            yield from masks(current, held)

    return _rows(rows(), _schema(shard=pa.int64(), part=pa.int64(), mask=pa.int32()))


def _clean(texts: pa.Array, masks: pa.Array) -> pa.Array:
    """n_words, removed word spans and kept words of each text."""
    masks = masks.to_pylist()
    n_words, removed, kept = [], [], []
    for row, data, offsets in text_chunks(texts):
        words = words_of(data, offsets)
        raw = data.tobytes()
        counts = words.counts()
        touched = any(masks[row + i] for i in range(len(counts)))
        if touched:
            _, segment, text, first, length = segments_of(words)
            cuts = np.searchsorted(text, np.arange(len(counts) + 1))
        for i, n in enumerate(counts.tolist()):
            parts = raw[offsets[i] : offsets[i + 1]].split()
            spans = []
            if masks[row + i]:
                edge = np.zeros(n + 1, np.int64)
                known = {m["segment"]: m["mask"] for m in masks[row + i]}
                for s in range(cuts[i], cuts[i + 1]):
                    mask = known.get(int(segment[s]), 0)
                    begin, size = int(first[s]), int(length[s])
                    if mask == (1 << size) - 1:
                        edge[begin] += 1
                        edge[begin + size + MIN_WORDS - 1] -= 1
                    elif mask:
                        for j in range(size):
                            if mask >> j & 1:
                                edge[begin + j] += 1
                                edge[begin + j + MIN_WORDS] -= 1
                gone = np.concatenate([[False], np.cumsum(edge)[:n] > 0, [False]])
                turns = np.flatnonzero(gone[1:] != gone[:-1])
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])]
                for span in reversed(spans):
                    del parts[span["start"] : span["end"]]
            n_words.append(n)
            removed.append(spans)
            kept.append(b" ".join(parts).decode())
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(removed, pa.list_(span)), pa.array(kept, pa.string())],
        ["n_words", "removed", "kept"],
    )


def remove_repeats(documents: DataFrame) -> DataFrame:
    """All rows and columns of ``documents`` (doc_id, text), with n_words, removed (spans of word
    numbers) and kept (the other words, joined by one space).

    A word goes if a run of MIN_WORDS words around it begins at least twice in the corpus, the
    same text included; all is judged on the input. A null or empty text has no words. Repeated
    rows repeat each other. Columns named like the new ones, whatever their case, are replaced. Words are compared by
    64-bit hashes, rows found again by a 64-bit hash of doc_id and text.
    """
    key = F.xxhash64("doc_id", "text")
    texts = documents.select(key.alias("key"), "text")
    repeated = materialize(
        texts.select("text").mapInArrow(_anchor_counts, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"),
        "repeated-anchors",
    )
    occurrences = texts.mapInArrow(_occurrences, "anchor bigint, segment bigint, key bigint, n bigint")
    found = materialize(occurrences.join(repeated, "anchor"), "repeated-segments")
    distinct = materialize(
        found.groupBy("anchor", "segment").agg(F.sum("n").alias("n"), F.min("key").alias("key")), "distinct-segments"
    )
    sizes = distinct.groupBy("anchor").agg(F.count("*").alias("segments"))
    sized = distinct.join(sizes, "anchor")

    def wanted(condition: str) -> DataFrame:
        rows = sized.filter(condition).groupBy("key").agg(F.collect_list(F.struct("segment", "n")).alias("wanted"))
        return texts.join(rows, "key").select("key", "text", "wanted")

    def judged(parts: DataFrame) -> DataFrame:
        spread = parts.select("shard", "part", "n", "words").repartition("shard").sortWithinPartitions("shard")
        return spread.mapInArrow(_shard_masks, "shard bigint, part bigint, mask int")

    segments = wanted(f"segments <= {SHARD_SEGMENTS}").mapInArrow(
        _segment_words, "shard bigint, part bigint, n bigint, words binary"
    )
    in_shards = judged(segments).select(F.col("shard").alias("anchor"), F.col("part").alias("segment"), "mask")
    windows = materialize(
        wanted(f"segments > {SHARD_SEGMENTS}").mapInArrow(
            _segment_windows, "anchor bigint, segment bigint, n bigint, place int, window bigint, words binary"
        ),
        "common-windows",
    )
    dealt = F.expr(f"xxhash64(anchor, pmod(window, ceil(segments * {REACH} / {SHARD_WINDOWS})))")
    distinct_windows = windows.groupBy("anchor", "window").agg(F.sum("n").alias("n"), F.max("words").alias("words"))
    repeated_windows = judged(
        distinct_windows.join(sizes, "anchor").select(dealt.alias("shard"), F.col("window").alias("part"), "n", "words")
    )
    in_split_shards = (
        windows.select("anchor", "segment", "place", "window")
        .join(repeated_windows.select(F.col("part").alias("window")), "window")
        .groupBy("anchor", "segment")
        .agg(F.bit_or(F.expr("shiftleft(1, place)")).alias("mask"))
    )
    masks = in_shards.unionAll(in_split_shards)
    of_row = (
        found.select("anchor", "segment", "key")
        .join(masks, ["anchor", "segment"])
        .select("key", "segment", "mask")
        .distinct()
        .groupBy("key")
        .agg(F.collect_list(F.struct("segment", "mask")).alias("masks"))
    )
    new = ("n_words", "removed", "kept")
    names, prefix = others(documents, new), free_prefix(documents)
    row, masks, cleaned = (prefix + c for c in ("key", "masks", "cleaned"))
    clean = arrow_udf(_clean, "struct<n_words: bigint, removed: array<struct<start: bigint, end: bigint>>, kept: string>")
    of_row = of_row.select(F.col("key").alias(row), F.col("masks").alias(masks))
    joined = documents.select(*names, key.alias(row)).join(of_row, row, "left")
    result = joined.select(*names, clean("text", masks).alias(cleaned))
    return result.select(*names, *[F.col(f"{cleaned}.{c}").alias(c) for c in new])
