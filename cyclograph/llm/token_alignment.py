"""Alignment of two tokenizers' tokens, with corpus-wide counts of the id pairs that end together.

Texts become token ids once, stored. A first pass over them lists the distinct pairs of linked
ids, over which minimal perfect hash functions are built, one for each shard of the pairs. Tasks
count links in dense vectors indexed by hash, which a tree of additions sums up. A second pass
aligns the documents again and looks up each link's count, verified by the stored key.

Pairs are held in blocks of at most BLOCK_PAIRS, so that nothing broadcast or collected grows with
the corpus: with more pairs than that, the passes run once for each block and partial sums add up.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclograph.llm.columns import named
from cyclograph.llm.perfect_hash import build, find
from cyclograph.llm.words import mixed
from cyclograph.session import materialize

SHARD_PAIRS = 1 << 18
"""Pairs of one hash function, about."""

BLOCK_PAIRS = 1 << 21
"""Pairs whose keys and counts are broadcast together, about: 17 bytes each."""

SEGMENT = 1 << 16
"""Counts that travel together when vectors are summed."""

CHUNK_CHARS = 1 << 19
"""Texts tokenized at once, up to this length; a longer text alone."""

SLICE_TOKENS = 1 << 18
"""Stored tokens aligned at once."""

MERGED_IDS = 1 << 20
"""New links that a task gathers before it makes them distinct or counts them."""

# The pattern that splits text before byte-level merges.
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LONG_BLANK = 100_000
"""Longest run of blanks that the pattern's engine backtracks over; texts beyond go another way to the same tokens."""

ADDED = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as they are and the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, ready in one worker, and the bytes of their tokens."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        self.source = byte_level.decode("utf-8")
        symbols = _byte_of_symbol()
        described = json.loads(self.source)
        special = {t["content"] for t in described["added_tokens"]}
        ranks = {bytes(symbols[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special}
        self.first = tiktoken.Encoding("first", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first_bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.first_bytes[i] = token
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.second_bytes = [self._piece(i) for i in range(self.second.vocab_size())]
        self.blank = re.compile(rf"\s{{{LONG_BLANK}}}")
        self.slow = None

    def _piece(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode("utf-8")

    def first_ids(self, text: str) -> list[int]:
        if not self.blank.search(text):
            return self.first.encode_ordinary(text)
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_str(self.source)
            self.slow.encode_special_tokens = True
        return self.slow.encode(text, add_special_tokens=False).ids

    def tokens(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of each text; none at all if either side's bytes aren't a space and the text."""
        for text, b in zip(texts, self.second.encode(texts, num_threads=1)):
            spaced = f" {text}"
            whole = spaced.encode("utf-8")
            a = self.first_ids(spaced) if text else []
            same = b"".join(map(self.second_bytes.__getitem__, b)) == whole and b"".join(map(self.first_bytes.__getitem__, a)) == whole
            yield (a, b) if same and text else ([], [])

    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([len(t) for t in side], np.int64) for side in (self.first_bytes, self.second_bytes))


def _ready(shared: Broadcast) -> Pair:
    """The worker's tokenizers; kept in the broadcast value, so that they are built once a process."""
    kept = shared.value
    if "pair" not in kept:
        kept["pair"] = Pair(kept["byte_level"], kept["pieces"])
    return kept["pair"]


def _tokenize(shared: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _ready(shared)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            row = 0
            while row < len(texts):
                end, size = row, 0
                while end < len(texts) and (end == row or size + len(texts[end] or "") <= CHUNK_CHARS):
                    size += len(texts[end] or "")
                    end += 1
                found = list(pair.tokens([t or "" for t in texts[row:end]]))
                sides = [_lists([f[k] for f in found]) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), *sides], ["row", "a", "b"])
                row = end

    return run


def _lists(ids: list[list[int]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = np.concatenate([np.array(i, np.int32) for i in ids]) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all rows, first id of each row and the end)."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64), (offsets - offsets[0]).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about SLICE_TOKENS tokens; a longer text is a part of its own."""
    for batch in batches:
        offsets = batch.column("a").offsets.to_numpy().astype(np.int64) + batch.column("b").offsets.to_numpy()
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_TOKENS, side="right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def common_ends(a: np.ndarray, b: np.ndarray, lengths: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either side end where one of the other side ends.

    Both sides spell the same bytes text by text, so positions may run on over all texts.
    """
    ends = [np.cumsum(size[ids]) for size, ids in zip(lengths, (a, b))]
    marks = np.zeros((2, int(ends[0][-1]) + 1 if len(a) else 1), bool)
    for mark, end in zip(marks, ends):
        mark[end] = True
    return marks[1][ends[0]], marks[0][ends[1]]


def codes_of(a: np.ndarray, b: np.ndarray, last: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (a[last[0]] << 32) | b[last[1]]


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    return ((mixed(codes.astype(np.uint64)) >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _links(batch: pa.RecordBatch, lengths) -> np.ndarray:
    a, b = _flat(batch.column("a"))[0], _flat(batch.column("b"))[0]
    return codes_of(a, b, common_ends(a, b, lengths))


def _distinct_pairs(shared: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _ready(shared).lengths()
        known, new, waiting = np.zeros(0, np.int64), [], 0
        for batch in _slices(batches):
            new.append(_links(batch, lengths))
            waiting += len(new[-1])
            if waiting >= MERGED_IDS:
                known, new, waiting = np.unique(np.concatenate([known, *new])), [], 0
            if len(known) >= 4 * MERGED_IDS:
                yield pa.RecordBatch.from_arrays([pa.array(known)], ["code"])
                known = np.zeros(0, np.int64)
        known = np.unique(np.concatenate([known, *new]))
        yield pa.RecordBatch.from_arrays([pa.array(known)], ["code"])

    return run


def _with_shard(shards: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(codes, shards)), batch.column(0)], ["shard", "code"])

    return run


def _hash_function(key: tuple, table: pa.Table) -> pa.Table:
    (first, bits, before), ordered = build(table["code"].to_numpy())
    packed = [[x.astype(kind).tobytes()] for x, kind in ((first, "<i8"), (bits, "<u8"), (before, "<i8"), (ordered, "<u8"))]
    return pa.table([pa.array([key[0].as_py()]), *[pa.array(x, pa.binary()) for x in packed]], ["shard", "first", "bits", "before", "keys"])


def _read_functions(rows: list) -> list:
    """(shard, levels, keys, index of the shard's first pair) of a block's shards."""
    out, begin = [], 0
    for r in rows:
        arrays = [np.frombuffer(r[c], kind) for c, kind in (("first", "<i8"), ("bits", "<u8"), ("before", "<i8"), ("keys", "<u8"))]
        out.append((r["shard"], tuple(arrays[:3]), arrays[3], begin))
        begin += len(arrays[3])
    return out


def _indexes(block: dict, codes: np.ndarray) -> np.ndarray:
    """Index of each code's pair in the block, -1 for pairs of other blocks."""
    shard, out = shard_of(codes, block["shards"]), np.full(len(codes), -1, np.int64)
    for number, levels, keys, begin in block["functions"]:
        own = np.flatnonzero(shard == number)
        found = find(levels, keys, codes[own])
        if len(found) and found.min() < 0:
            raise RuntimeError("a pair of ids is missing from its hash function")
        out[own] = found + begin
    return out


def _count(shared: Broadcast, block: Broadcast) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, held = _ready(shared).lengths(), block.value
        total = np.zeros(held["pairs"], np.int64)
        waiting, size = [], 0

        def add() -> None:
            codes, n = np.unique(np.concatenate(waiting), return_counts=True)
            at = _indexes(held, codes)
            total[at[at >= 0]] += n[at >= 0]

        for batch in _slices(batches):
            waiting.append(_links(batch, lengths))
            size += len(waiting[-1])
            if size >= MERGED_IDS:
                add()
                waiting, size = [], 0
        if waiting:
            add()
        for i in range(0, len(total), SEGMENT):
            part = total[i : i + SEGMENT]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i // SEGMENT]), pa.array([part.tobytes()], pa.binary())], ["segment", "counts"])

    return run


def _add_vectors(key: tuple, table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_buffer(), np.int64) for v in table["counts"])
    return pa.table([pa.array([k.as_py() for k in key[:1]], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["segment", "counts"])


def _tree_sum(vectors: DataFrame, tasks: int) -> DataFrame:
    """Add up the tasks' vectors segment by segment, in two steps of about as many summands each."""
    fan = max(1, math.isqrt(tasks))
    some = vectors.withColumn("branch", F.spark_partition_id() % fan)
    for keys in (["segment", "branch"], ["segment"]):
        some = some.groupBy(*keys).applyInArrow(_add_vectors, "segment bigint, counts binary")
    return some


def group_texts(a: np.ndarray, b: np.ndarray, last: tuple[np.ndarray, np.ndarray], ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets by text) of ``a1,a2|b1;a3|b2`` for all texts; ends_b: each text's last b and one more."""
    n = len(a) + len(b)
    ia, ib = np.flatnonzero(last[0]), np.flatnonzero(last[1])
    group_a = np.cumsum(last[0]) - last[0]
    group_b = np.cumsum(last[1]) - last[1]
    at_a = np.arange(len(a)) + np.concatenate([[0], ib + 1])[group_a]
    at_b = np.arange(len(b)) + ia[group_b] + 1
    ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[at_a], ids[at_b] = a, b
    mark[at_a[ia]], mark[at_b[ib]] = ord("|"), ord(";")
    digits = max(1, len(str(int(ids.max(initial=0)))))
    cells, used = np.empty((n, digits + 1), np.uint8), np.ones((n, digits + 1), bool)
    for k in range(digits):
        power = 10 ** (digits - 1 - k)
        cells[:, k] = ids // power % 10 + ord("0")
        if power > 1:
            used[:, k] = ids >= power
    cells[:, digits] = mark
    text_end = np.zeros(len(b) + 1, bool)
    text_end[ends_b] = True
    used[at_b[text_end[1:]], digits] = False
    sizes = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
    after = np.concatenate([[0], at_b + 1])
    return cells[used], sizes[after[ends_b]]


def _look_up(shared: Broadcast, block: Broadcast, last_block: bool) -> Callable:
    """Second pass. Before the last block only (id, n_best, count_sum) of the block come out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, held = _ready(shared).lengths(), block.value
        for batch in _slices(batches):
            (a, first_a), (b, first_b) = _flat(batch.column("a")), _flat(batch.column("b"))
            last = common_ends(a, b, lengths)
            links = np.concatenate([[0], np.cumsum(last[0])])[first_a]
            at = _indexes(held, codes_of(a, b, last))
            here = at >= 0
            counts, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            counts[here], best[here] = held["counts"][at[here]], held["best"][at[here]]
            count_sum, n_best = (np.diff(np.concatenate([[0], np.cumsum(x)])[links]) for x in (counts, best))
            if not last_block:
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_best), pa.array(count_sum)], ["id", "n_best", "count_sum"])
                continue
            data, offsets = group_texts(a, b, last, first_b)
            groups = pa.LargeStringArray.from_buffers(len(links) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
            n_links = pa.array(np.diff(links))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(np.diff(first_a)),
                    pa.array(np.diff(first_b)),
                    n_links,
                    n_links,
                    pa.array(n_best + batch.column("base_best").to_numpy()),
                    pa.array(count_sum + batch.column("base_sum").to_numpy()),
                    groups,
                ],
                ["row", *ADDED],
            )

    return run


def align(df: DataFrame, byte_level: str, pieces: str, text: str = "text") -> DataFrame:
    """Align the tokens of every whole text; one row comes back for each row of ``df``.

    ``byte_level`` and ``pieces`` are the paths of a byte-level tokenizer's JSON file (A) and of a
    sentencepiece model (B) on the driver. A encodes a space and the text, B the text, to which it
    adds the space; control strings inside texts are plain text.

    All columns stay but the text itself; columns named like one of ADDED are replaced, whatever
    their case. New: ``n_a`` and ``n_b`` tokens; ``n_groups``, cut wherever tokens of both sides
    end; ``n_links``, pairs of tokens that end together, which close one group each; ``n_best``,
    links whose pair is linked in the corpus as often as any pair of its B id; ``count_sum``, the
    links' counts in the corpus; ``groups``, as ``a1,a2|b1;a3|b2``. Texts that are null, empty or
    that either side can't spell byte for byte (such as with U+2581) have no tokens: zeros, and
    ``groups`` is empty. Repeated rows count as often as they are there.
    """
    spark = df.sparkSession
    with open(byte_level, "rb") as one, open(pieces, "rb") as two:
        shared = spark.sparkContext.broadcast({"byte_level": one.read(), "pieces": two.read()})
    kept = [c for c in df.columns if c.lower() != text.lower() and c.lower() not in ADDED]
    row = F.struct(*[named(c) for c in kept]) if kept else F.struct(F.lit(None).cast("int").alias("none"))
    given = df.select(row.alias("row"), named(text).cast("string").alias("text"))
    kind = T.StructType([given.schema["row"]])
    tokens = given.mapInArrow(_tokenize(shared), T.StructType([*kind, *_fields("a array<int>, b array<int>")]))
    tokens = materialize(tokens.withColumn("id", F.monotonically_increasing_id()), "tokens")

    pairs = tokens.select("a", "b").mapInArrow(_distinct_pairs(shared), "code bigint").distinct()
    pairs = materialize(pairs, "token-pairs")
    shards = max(1, -(-pairs.count() // SHARD_PAIRS))
    functions = pairs.mapInArrow(_with_shard(shards), "shard bigint, code bigint").groupBy("shard")
    functions = materialize(functions.applyInArrow(_hash_function, "shard bigint, first binary, bits binary, before binary, keys binary"), "token-hashes")
    per_block = max(1, BLOCK_PAIRS // SHARD_PAIRS)

    def read_block(first: int) -> dict:
        rows = functions.filter(F.col("shard").between(first, first + per_block - 1)).orderBy("shard").collect()
        held = _read_functions(rows)
        return {"shards": shards, "functions": held, "pairs": sum(len(f[2]) for f in held)}

    def ids_of_b(held: dict) -> np.ndarray:
        keys = [f[2] for f in held["functions"]]
        return (np.concatenate(keys) & np.uint64(0xFFFFFFFF)).astype(np.int64) if keys else np.zeros(0, np.int64)

    blocks, stored, best = range(0, shards, per_block), {}, np.zeros(len(_ready(shared).second_bytes), np.int64)
    for first in blocks:
        held = read_block(first)
        vectors = tokens.select("a", "b").mapInArrow(_count(shared, spark.sparkContext.broadcast(held)), "segment bigint, counts binary")
        stored[first] = materialize(_tree_sum(vectors, tokens.rdd.getNumPartitions()), "token-counts")
        np.maximum.at(best, ids_of_b(held), _vector(stored[first], held["pairs"]))

    def look_up(first: int, source: DataFrame, schema: T.StructType) -> DataFrame:
        held = read_block(first)
        held["counts"] = _vector(stored[first], held["pairs"])
        held["best"] = held["counts"] == best[ids_of_b(held)]
        return source.mapInArrow(_look_up(shared, spark.sparkContext.broadcast(held), first == blocks[-1]), schema)

    source = tokens.withColumns({"base_best": F.lit(0).cast("bigint"), "base_sum": F.lit(0).cast("bigint")})
    if len(blocks) > 1:
        parts = None
        for first in blocks[:-1]:
            part = materialize(look_up(first, tokens.select("id", "a", "b"), _fields("id bigint, n_best bigint, count_sum bigint")), "token-parts")
            parts = part if parts is None else parts.unionAll(part)
        parts = parts.groupBy("id").agg(F.sum("n_best").alias("base_best"), F.sum("count_sum").alias("base_sum"))
        source = tokens.join(parts, "id")
    numbers = ", ".join(f"{c} bigint" for c in ADDED[:-1])
    found = look_up(blocks[-1], source, T.StructType([*kind, *_fields(f"{numbers}, groups string")]))
    return found.select(*[F.col("row")[c].alias(c) for c in kept], *ADDED)


def _fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def _vector(summed: DataFrame, n: int) -> np.ndarray:
    """A block's count vector; segments without a link are zero."""
    out = np.zeros(n, np.int64)
    for r in summed.toLocalIterator():
        part = np.frombuffer(r["counts"], np.int64)
        out[r["segment"] * SEGMENT : r["segment"] * SEGMENT + len(part)] = part
    return out
