"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: a segment holds the postings of some documents, that is,
for each term the sorted word positions at which it stands. Test items become runs of WINDOW
words, and the runs that share their rarest term, by its count in all documents, are looked up
together: the postings of that term are the candidates, the lists of the words around it, shifted
by their distance, are intersected with them outwards, and what is left says which runs stand there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.llm.words import ALNUM, LOWER, mixed, text_chunks, words_of
from cyclograph.session import materialize

WINDOW = 13
SEGMENT_BYTES = 1 << 20
PIECE_WORDS = 1 << 16
"""Longer test items are cut into pieces of as many runs."""
BLOCK_BYTES = 32 << 20
"""Test items are read in blocks of about this many bytes, 8 for a word; one block is on the driver at a time."""
FILTER_BITS = 24
"""The index leaves out terms whose bit, one of 2 ** FILTER_BITS, no test item sets: 2 MB for tests of any size."""
CANDIDATES = 1 << 20
"""Candidates of a segment are followed so many at a time."""

SEGMENT = (
    "segment bigint, doc_ids array<string>, text_keys array<bigint>, n_words array<int>,"
    " terms binary, offsets binary, positions binary"
)


def _terms(data: np.ndarray, offsets: np.ndarray):
    return words_of(LOWER[data], offsets, ALNUM)


def _bit(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, value) of each term's bit in the term filter, an array of 64-bit numbers."""
    bit = terms >> np.uint64(64 - FILTER_BITS)
    return (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63))


def term_filter(pieces: DataFrame) -> np.ndarray:
    """The bits of all terms of the test pieces. Other terms can set the same ones, so some more pass it."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        for batch in batches:
            for words in batch.column(0):
                at, value = _bit(np.frombuffer(words.as_py(), np.uint64))
                np.bitwise_or.at(out, at, value)
        used = np.flatnonzero(out)
        yield pa.RecordBatch.from_pydict({"place": pa.array(used), "bits": pa.array(out[used].view(np.int64))})

    parts = pieces.select("words").mapInArrow(bits, "place bigint, bits bigint")
    united = parts.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most 2 ** (FILTER_BITS - 6) rows
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[united["place"].to_numpy()] = united["bits"].to_numpy().view(np.uint64)
    return out


def _segments(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in text_chunks(batch.column(2), SEGMENT_BYTES):
            words = _terms(data, offsets)
            n = len(offsets) - 1
            positions = np.arange(len(words.hashes)) + words.text_of_word() * WINDOW
            terms = words.hashes
            if wanted is not None:
                at, value = _bit(terms)
                kept = np.flatnonzero(wanted[at] & value)
                terms, positions = terms[kept], positions[kept]
            order = np.argsort(terms, kind="stable")
            terms, positions = terms[order], positions[order].astype(np.uint32)
            first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else np.zeros(0, int)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_ids": pa.array([batch.column(0).slice(row, n).to_pylist()], pa.list_(pa.string())),
                    "text_keys": pa.array([batch.column(1).slice(row, n).to_pylist()], pa.list_(pa.int64())),
                    "n_words": pa.array([words.counts().astype(np.int32)], pa.list_(pa.int32())),
                    "terms": pa.array([terms[first].tobytes()], pa.binary()),
                    "offsets": pa.array([np.append(first, len(terms)).astype(np.uint32).tobytes()], pa.binary()),
                    "positions": pa.array([positions.tobytes()], pa.binary()),
                }
            )


def build_index(documents: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """Store the postings of (doc_id, text) in the shared folder, one row for each segment.

    ``wanted``: a ``term_filter``; terms that it excludes get no postings, as no test asks for them.
    Terms are words of A-Z lower-cased text; a null text has none. Positions of consecutive
    documents lie a run apart, so that no run crosses from one to the next.
    """
    shared = documents.sparkSession.sparkContext.broadcast(wanted)
    rows = documents.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    segments = rows.mapInArrow(lambda batches: _segments(batches, shared.value), SEGMENT.removeprefix("segment bigint, "))
    return materialize(segments.select(F.monotonically_increasing_id().alias("segment"), "*"), "posting-index")


def frequencies(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each term of the sorted ``vocabulary`` stands in all documents."""
    shared = index.sparkSession.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        total = np.zeros(len(known), np.int64)
        for batch in batches:
            for terms, offsets in zip(*batch.columns):
                terms, offsets = np.frombuffer(terms.as_py(), np.uint64), np.frombuffer(offsets.as_py(), np.uint32)
                at, found = _lookup(known, terms)
                total[at] += np.diff(offsets)[found]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(used), "n": pa.array(total[used])})

    parts = index.select("terms", "offsets").mapInArrow(counted, "term bigint, n bigint")
    summed = parts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(vocabulary), np.int64)
    out[summed["term"].to_numpy()] = summed["n"].to_numpy()
    shared.unpersist()
    return out


def _lookup(vocabulary: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the vocabulary, index) of the terms that are in it."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
    found = np.flatnonzero(vocabulary[at] == terms)
    return at[found], found


@dataclass
class Passages:
    """The runs of some test items, by the place of their rarest term (the anchor).

    ``words``: the items' words one after another, as places in ``vocabulary``. Group g holds the
    runs of ``length[g]`` words that begin at words ``low[g]`` to ``high[g]``; word ``anchor[g]`` is
    the rarest of each. Groups with the same words are one; ``owners`` lists the items of each.
    """

    vocabulary: np.ndarray
    words: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    length: np.ndarray
    starts: np.ndarray
    owners: np.ndarray
    names: np.ndarray

    def parts(self) -> tuple:
        """Plain data, which workers read without this class."""
        return tuple(vars(self).values())


def _expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers from each start on, as many as its length."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))


def compile_passages(pieces: list[tuple[str, np.ndarray]], frequency: Callable[[np.ndarray], np.ndarray], window: int = WINDOW) -> Passages:
    """All runs of ``window`` words of the (item id, term hashes) pieces; one of fewer words is one run.

    ``frequency`` gives the counts of a vocabulary in all documents; runs with a term that no
    document has are left out. The first of equally rare words is the anchor.
    """
    names = sorted({name for name, _ in pieces})
    number = {name: i for i, name in enumerate(names)}
    sizes = np.array([len(h) for _, h in pieces], np.int64)
    begin = np.cumsum(sizes) - sizes
    owner = np.array([number[name] for name, _ in pieces], np.int64)
    vocabulary, words = np.unique(np.concatenate([np.zeros(0, np.uint64), *[h for _, h in pieces]]), return_inverse=True)
    count = frequency(vocabulary)[words] if len(words) else np.zeros(0, np.int64)
    groups = []
    for k in range(1, window + 1):
        of_length = np.flatnonzero(np.minimum(sizes, window) == k)
        if not len(of_length):
            continue
        runs = np.lib.stride_tricks.sliding_window_view(count, k)
        first = _expand(begin[of_length], sizes[of_length] - k + 1)
        place = np.concatenate([first[i : i + PIECE_WORDS] + runs[first[i : i + PIECE_WORDS]].argmin(axis=1) for i in range(0, len(first), PIECE_WORDS)])
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]]))
        found = np.stack([place[edge[:-1]], first[edge[:-1]], first[edge[1:] - 1], np.full(len(edge) - 1, k)])
        groups.append(found[:, count[found[0]] > 0])
    anchor, low, high, length = np.concatenate([np.zeros((4, 0), np.int64), *groups], axis=1)
    digest = np.zeros(len(anchor), np.uint64)
    for d in range(1 - window, window):
        at = anchor + d
        inside = (at >= low) & (at < high + length)
        digest = mixed(digest) + np.where(inside, vocabulary[words[np.where(inside, at, 0)]] if len(words) else 0, np.uint64(d + window))
    _, first, which = np.unique(digest, return_index=True, return_inverse=True)
    item = owner[np.searchsorted(begin, anchor, "right") - 1]
    order = np.lexsort((item, which))
    starts = np.searchsorted(which[order], np.arange(len(first) + 1))
    return Passages(
        vocabulary, words.astype(np.int32), anchor[first], low[first], high[first], length[first], starts, item[order], np.array(names, object)
    )


class _Postings:
    """The lists of one segment, for the terms of the passages."""

    def __init__(self, terms: np.ndarray, offsets: np.ndarray, positions: np.ndarray, counts: np.ndarray, passages: Passages):
        self.offsets, self.positions, self.counts, self.passages = offsets.astype(np.int64), positions.astype(np.int64), counts, passages
        self.base = np.cumsum(counts + WINDOW) - counts - WINDOW
        self.keys = (np.repeat(np.arange(len(terms)), np.diff(self.offsets)) << 32) + self.positions
        at, found = _lookup(passages.vocabulary, terms)
        self.list_of = np.full(len(passages.vocabulary), -1, np.int64)
        self.list_of[at] = found

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(group, position) of every occurrence of each group's anchor, CANDIDATES or so at a time."""
        of_group = self.list_of[self.passages.words[self.passages.anchor]]
        groups = np.flatnonzero(of_group >= 0)
        first, n = self.offsets[of_group[groups]], np.diff(self.offsets)[of_group[groups]]
        cuts = np.flatnonzero(np.diff(np.cumsum(n) // CANDIDATES)) + 1
        for part in np.split(np.arange(len(groups)), cuts):
            if len(part):
                yield np.repeat(groups[part], n[part]), self.positions[_expand(first[part], n[part])]

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, position, "right") - 1

    def reach(self, group: np.ndarray, position: np.ndarray, step: int, slop: int) -> np.ndarray:
        """How many words in a row after (``step`` 1) or before (-1) the anchor stand in the document
        too, each at most ``slop`` words from its place."""
        p = self.passages
        out = np.zeros(len(group), np.int64)
        doc = self.document(position)
        low, high = self.base[doc], self.base[doc] + self.counts[doc] - 1
        left = np.arange(len(group))
        for d in range(1, WINDOW):
            word, g = p.anchor[group[left]] + step * d, group[left]
            inside = (word >= p.low[g]) & (word < p.high[g] + p.length[g])
            left, word = left[inside], word[inside]
            wanted = self.list_of[p.words[word]]
            place = position[left] + step * d
            least = (wanted << 32) + np.maximum(place - slop, low[left])
            most = (wanted << 32) + np.minimum(place + slop, high[left])
            key = self.keys[np.minimum(np.searchsorted(self.keys, least), len(self.keys) - 1)]
            left = left[(wanted >= 0) & (key >= least) & (key <= most)]
            if not len(left):
                break
            out[left] = d
        return out

    def matches(self, slop: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(group, position of its anchor, first and last word begun by a run of it) of all that stand here."""
        p = self.passages
        for group, position in self.candidates():
            after = self.reach(group, position, 1, slop)
            ends = np.minimum(p.high[group], p.anchor[group] + after - p.length[group] + 1)
            stays = ends >= p.low[group]
            group, position, ends = group[stays], position[stays], ends[stays]
            begins = np.maximum(p.low[group], p.anchor[group] - self.reach(group, position, -1, slop))
            stays = begins <= ends
            yield group[stays], position[stays], begins[stays], ends[stays]

    def items(self, group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, item) for each item of each group, where a value belongs to a group."""
        starts, n = self.passages.starts[group], self.passages.starts[group + 1] - self.passages.starts[group]
        return np.repeat(value, n), self.passages.owners[_expand(starts, n)]


def _distinct(*columns: np.ndarray) -> np.ndarray:
    return np.unique(np.stack(columns, axis=1), axis=0)


def _search(batches: Iterator[pa.RecordBatch], passages: Passages, slop: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            segment, counts = batch.column(0)[r].as_py(), np.array(batch.column(1)[r].as_py(), np.int64)
            terms, offsets, positions = (np.frombuffer(batch.column(c)[r].as_py(), t) for c, t in ((2, np.uint64), (3, np.uint32), (4, np.uint32)))
            if not len(terms) or not len(passages.anchor):
                continue
            postings = _Postings(terms, offsets, positions, counts, passages)
            covered = np.zeros(int(counts.sum()) + WINDOW * (len(counts) + 1) + 1, np.int32)
            owned, close = [np.zeros((0, 2), np.int64)], [np.zeros((0, 3), np.int64)]
            for group, position, begins, ends in postings.matches():
                np.add.at(covered, position - passages.anchor[group] + begins, 1)
                np.add.at(covered, position - passages.anchor[group] + ends + passages.length[group], -1)
                pairs = _distinct(postings.document(position), group)
                owned.append(_distinct(*postings.items(pairs[:, 1], pairs[:, 0])))
            for group, position, _, _ in postings.matches(slop) if slop else ():
                at, item = postings.items(group, position)
                doc = postings.document(at)
                close.append(_distinct(doc, item, at - postings.base[doc]))
            owned, close = np.unique(np.concatenate(owned), axis=0), np.unique(np.concatenate(close), axis=0)
            hit = np.flatnonzero(np.cumsum(covered) > 0)
            owner = postings.document(hit)
            hit = hit - postings.base[owner]
            found = np.union1d(owned[:, 0], close[:, 0])
            near: list[dict[str, list[int]]] = []
            for a, b in zip(np.searchsorted(close[:, 0], found), np.searchsorted(close[:, 0], found, "right")):
                near.append({})
                for _, i, word in close[a:b].tolist():
                    near[-1].setdefault(passages.names[i], []).append(word)
            hits = zip(np.searchsorted(owner, found), np.searchsorted(owner, found, "right"))
            items = zip(np.searchsorted(owned[:, 0], found), np.searchsorted(owned[:, 0], found, "right"))
            yield pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array(np.full(len(found), segment, np.int64)),
                    "ordinal": pa.array(found.astype(np.int32)),
                    "hit_words": pa.array([hit[a:b] for a, b in hits], pa.list_(pa.int64())),
                    "items": pa.array([passages.names[owned[a:b, 1]] for a, b in items], pa.list_(pa.string())),
                    "near": pa.array([[{"item": i, "words": w} for i, w in n.items()] for n in near], NEAR),
                }
            )


NEAR = pa.list_(pa.struct([("item", pa.string()), ("words", pa.list_(pa.int64()))]))

FOUND = "segment bigint, ordinal int, hit_words array<bigint>, items array<string>, near array<struct<item: string, words: array<bigint>>>"


def search(index: DataFrame, passages: Passages, slop: int = 0) -> DataFrame:
    """Rows for the indexed documents that hold any of the passages: the places of words inside exact
    ones, the items they belong to, and with ``slop`` the proximity matches by item: the places of
    the words at which the passages' rarest terms stand. Stored, so that the passages can go."""
    shared = index.sparkSession.sparkContext.broadcast(passages.parts())
    rows = index.select("segment", "n_words", "terms", "offsets", "positions")
    found = materialize(rows.mapInArrow(lambda batches: _search(batches, Passages(*shared.value), slop), FOUND), "passages-found")
    shared.unpersist()
    return found


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, data, offsets in text_chunks(batch.column(1)):
            words = _terms(data, offsets)
            names, found = [], []
            for i in range(len(offsets) - 1):
                own = words.hashes[words.first[i] : words.first[i + 1]]
                for at in range(0, max(len(own) - WINDOW + 1, min(len(own), 1)), PIECE_WORDS):
                    names.append(batch.column(0)[row + i].as_py())
                    found.append(own[at : at + PIECE_WORDS + WINDOW - 1].tobytes())
            yield pa.RecordBatch.from_pydict({"item_id": pa.array(names, pa.string()), "words": pa.array(found, pa.binary())})


def item_pieces(benchmark: DataFrame) -> DataFrame:
    """Distinct (item_id, words), the term hashes of the items' texts; long ones in several rows whose ends overlap."""
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    return materialize(named.mapInArrow(_pieces, "item_id string, words binary").distinct(), "benchmark-pieces")


def _blocks(pieces: DataFrame) -> Iterator[list[tuple[str, np.ndarray]]]:
    """All pieces, a block at a time."""
    size = pieces.agg(F.sum(F.octet_length("words") + F.octet_length("item_id"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    for block in range(n):
        rows = pieces.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == block).toArrow().to_pylist()
        yield sorted(((r["item_id"], np.frombuffer(r["words"], np.uint64)) for r in rows), key=lambda r: (r[0], r[1].tobytes()))


def contamination(documents: DataFrame, benchmark: DataFrame, slop: int = 0) -> DataFrame:
    """One row for every row of ``documents`` (doc_id, text), with what it shares with ``benchmark``
    (item_id, text): doc_id as string, text_key, n_words, hit_words, items, near.

    A word is hit if it lies inside any occurrence of a run of WINDOW words of an item, or of a
    whole shorter item. With ``slop``, ``near`` lists the items of which a run stands in the document
    with each word at most ``slop`` words from its place after the run's rarest one (exact
    occurrences too), and the places of those rarest words. Null or empty texts have no words and no
    hits; an item id that is null is the empty string; rows of one item id count as one item. The
    benchmark is read in blocks of about BLOCK_BYTES, each searched, stored and released in turn.
    """
    pieces = item_pieces(benchmark)
    index = build_index(documents, term_filter(pieces))
    found = documents.sparkSession.createDataFrame([], FOUND)
    for block in _blocks(pieces):
        found = found.unionAll(search(index, compile_passages(block, lambda terms: frequencies(index, terms)), slop))
    by_document = found.groupBy("segment", "ordinal").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hit_words")))).alias("hit_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.flatten(F.collect_list("near")).alias("near"),
    )
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "text_keys", "n_words")).alias("ordinal", "document"))
    return rows.join(by_document, ["segment", "ordinal"], "left").select(
        F.col("document.doc_ids").alias("doc_id"),
        F.col("document.text_keys").alias("text_key"),
        F.col("document.n_words").cast("bigint").alias("n_words"),
        *[F.coalesce(c, F.array()).alias(c) for c in ("hit_words", "items", "near")],
    )


def is_contaminated(found: DataFrame):
    """At least one word in twenty is hit."""
    return (F.size("hit_words") > 0) & (20 * F.size("hit_words").cast("long") >= F.col("n_words"))


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns as they were whatever their names, without the contaminated ones."""
    found = contamination(documents, benchmark)
    bad = found.filter(is_contaminated(found)).select(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).distinct()
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("string").alias("own_id"), F.xxhash64("text").alias("own_key"))
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key"))
    return rows.join(bad, same, "left_anti").select("row.*")
