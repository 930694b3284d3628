"""N-gram Jaccard self-join by chosen paths.

Each text is the set of its runs of NGRAM words. A set's tokens are COORDINATES minhash values.
In each run, a path starts from the root; at every node all sets are split by the values of the
same one or two sampled coordinates (1 / threshold of them on average), so two sets share a
child with their similarity as chance. Buckets of at most BRUTE sets are compared by brute force;
larger ones are split again, down to DEPTH. Runs are repeated until a pair at the threshold is
met with the chance RECALL.

What meets is only a candidate. Candidate groups are then joined exactly, on the whole sets:
links are counted and classes formed there, so that no pair of sets is ever a row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cyclograph.llm.components import components
from cyclograph.llm.words import mixed, text_chunks, words_of
from cyclograph.session import materialize

NGRAM = 5
THRESHOLD = Fraction(4, 5)
COORDINATES = 128
BRUTE = 64
DEPTH = 4
RECALL = 0.9999
SLACK = 4.0
"""A pair stays a candidate down to this many standard errors below the threshold."""
UNIT_SHINGLES = 1 << 19
"""Candidate groups of more shingles are compared block by block."""

NO_WORDS = bytes(16)

_seed = np.random.default_rng(8191)
_FACTOR = _seed.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSET = _seed.integers(0, 2**63, COORDINATES, dtype=np.uint64)


def survival(similarity: float, threshold: float = float(THRESHOLD), depth: int = DEPTH) -> float:
    """Chance that one run brings two sets of this similarity into a common bucket at ``depth``."""
    second, chance = 1 / threshold - 1, 1.0
    for _ in range(depth):
        miss = 1 - similarity * chance
        chance = 1 - ((1 - second) * miss + second * miss * miss)
    return chance


def runs_for(recall: float, threshold: float = float(THRESHOLD)) -> int:
    """Runs after which a pair at the threshold has met with this chance, at any depth up to DEPTH."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(threshold)))


def _sampled(paths: np.ndarray, second: float = float(1 / THRESHOLD - 1)) -> tuple[np.ndarray, np.ndarray]:
    """The coordinate each path goes on with, and a further one or -1."""
    h = mixed(paths ^ np.uint64(0xA5A5A5A55A5A5A5A))
    one = (h % np.uint64(COORDINATES)).astype(np.int64)
    h = mixed(h)
    two = (one + 1 + (h % np.uint64(COORDINATES - 1)).astype(np.int64)) % COORDINATES
    return one, np.where((mixed(h) >> np.uint64(11)).astype(float) / 2**53 < second, two, -1)


def _child(paths, coordinates, values):
    return mixed(mixed(paths + np.uint64(0x51ED270B) * coordinates.astype(np.uint64)) ^ values)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Distinct n-gram hashes of a text, given its words; a text of fewer words is one n-gram."""
    k = min(NGRAM, len(hashes))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(hashes) - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = mixed(h) + hashes[j : n + j]
    return np.unique(mixed(h))


def digest(tokens: np.ndarray) -> bytes:
    """Identity of a set."""
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else NO_WORDS


def minhashes(tokens: np.ndarray) -> np.ndarray:
    out = np.full(COORDINATES, np.uint64(2**64 - 1))
    for at in range(0, len(tokens), 2048):
        part = tokens[at : at + 2048, None] * _FACTOR
        part += _OFFSET
        np.minimum(out, part.min(axis=0), out=out)
    return mixed(out)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    for _, data, offsets in text_chunks(column):
        words = words_of(data, offsets)
        for a, b in zip(words.first, words.first[1:]):
            yield shingles(words.hashes[a:b])


SKETCH = "doc_id {kind}, text_key bigint, node binary, n int, sketch binary, paths array<bigint>"


def _sketches(batches: Iterator[pa.RecordBatch], runs: int) -> Iterator[pa.RecordBatch]:
    roots = mixed(np.arange(1, runs + 1, dtype=np.uint64) << np.uint64(32))
    one, two = _sampled(roots)
    starts = np.concatenate([roots, roots[two >= 0]])
    coordinates = np.concatenate([one, two[two >= 0]])
    for batch in batches:
        nodes, sizes, sketches, paths = [], [], [], []
        for tokens in _sets(batch.column(1)):
            nodes.append(digest(tokens))
            sizes.append(len(tokens))
            if len(tokens):
                values = minhashes(tokens)
                sketches.append(values.astype(np.uint16).tobytes())
                paths.append(_child(starts, coordinates, values[coordinates]).view(np.int64))
            else:
                sketches.append(b"")
                paths.append([])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(2),
                pa.array(nodes, pa.binary()),
                pa.array(sizes, pa.int32()),
                pa.array(sketches, pa.binary()),
                pa.array(paths, pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_key", "node", "n", "sketch", "paths"],
        )


def _children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        paths = batch.column(0).to_numpy().view(np.uint64)
        sketch = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16).reshape(-1, COORDINATES)
        one, two = _sampled(paths)
        more = np.flatnonzero(two >= 0)
        rows = np.concatenate([np.arange(len(paths)), more])
        coordinates = np.concatenate([one, two[more]])
        new = _child(paths[rows], coordinates, sketch[rows, coordinates].astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(new.view(np.int64)), batch.column(1).take(pa.array(rows))], names=["path", "node"])


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Rows of ordered batches by their first column; one group is held at a time."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and row[0] != key:
                yield key, rows
                rows = []
            key = row[0]
            rows.append(row)
    if rows:
        yield key, rows


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brute force over small buckets of (path, node, sketch): a star for each group of similar sets."""
    t = float(THRESHOLD)
    least = math.floor(COORDINATES * (t - SLACK * math.sqrt(t * (1 - t) / COORDINATES)))
    u, v = [], []
    for _, rows in _groups(batches):
        nodes = [r[1] for r in rows]
        sketch = np.frombuffer(b"".join(r[2] for r in rows), np.uint16).reshape(len(rows), COORDINATES)
        parent = list(range(len(rows)))
        for i in range(len(rows) - 1):
            for j in np.flatnonzero((sketch[i + 1 :] == sketch[i]).sum(axis=1) >= least) + i + 1:
                a, b = _root(parent, i), _root(parent, int(j))
                parent[max(a, b)] = min(a, b)
        for i in range(len(rows)):
            if (r := _root(parent, i)) != i:
                u.append(nodes[i])
                v.append(nodes[r])
        if len(u) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])
            u, v = [], []
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """Edges that connect all candidate pairs of (node, sketch, paths), at most one for each row of a bucket."""
    sketches = nodes.select("node", "sketch")
    active = nodes.select(F.explode("paths").alias("path"), "node")
    found = None
    for depth in range(1, DEPTH + 1):
        shared = active.groupBy("path").agg(F.count("*").alias("m"), F.min("node").alias("least")).filter("m > 1")
        rows = materialize(active.join(shared, "path"), "path-buckets")
        small = rows.filter(F.col("m") <= BRUTE).select("path", "node").join(sketches, "node").select("path", "node", "sketch")
        met = small.repartition("path").sortWithinPartitions("path", "node").mapInArrow(_similar, "u binary, v binary")
        large = rows.filter(F.col("m") > BRUTE)
        if depth == DEPTH:
            met = met.unionAll(large.select(F.col("node").alias("u"), F.col("least").alias("v")))
        met = materialize(met.filter("u <> v").distinct(), "path-edges")
        found = met if found is None else found.unionAll(met)
        if depth == DEPTH or large.isEmpty():
            return found
        split = large.select("path", "node").join(sketches, "node").select("path", "node", "sketch")
        active = materialize(split.mapInArrow(_children, "path bigint, node binary").distinct(), "path-children")


def overlaps(sets: list[np.ndarray], left: list[int], right: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """(i, those j of ``right`` that reach the threshold with it) for each i of ``left``, by an inverted list."""
    sizes = np.array([len(s) for s in sets])
    top, bottom = THRESHOLD.numerator, THRESHOLD.denominator
    if not len(right) or not len(left):
        return
    if len(right) * len(left) <= 8:
        for i in left:
            hit = []
            for j in right:
                a, b = len(sets[i]), len(sets[j])
                if i != j and min(a, b) * bottom >= top * max(a, b):
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if common * (top + bottom) >= top * (a + b):
                        hit.append(j)
            yield i, np.array(hit, int)
        return
    tokens = np.concatenate([sets[j] for j in right])
    owners = np.repeat(right, sizes[right])
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    for i in left:
        low, high = np.searchsorted(tokens, sets[i]), np.searchsorted(tokens, sets[i], "right")
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(owners[at], minlength=len(sets))
        hit = np.flatnonzero((common > 0) & (common * (top + bottom) >= top * (sizes + sizes[i])))
        yield i, hit[hit != i]


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ordered rows (unit, .., node, ..) the first of each node of a unit: repeats of a row aren't held."""
    last = None
    for batch in batches:
        keep = np.ones(batch.num_rows, bool)
        for i, now in enumerate(zip(batch.column("unit").to_pylist(), batch.column("node").to_pylist())):
            keep[i], last = now != last, now
        yield batch if keep.all() else batch.filter(pa.array(keep))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact join of each unit (unit, pair, block, node, copies, text): links of each set, and its class so far.

    A unit is one block against itself, or, as a pair, one block against another.
    """
    for _, rows in _groups(_once(batches)):
        pair = rows[0][1]
        known: dict[bytes, tuple[int, int, np.ndarray]] = {}
        for (_, _, block, node, copies, _), tokens in zip(rows, _sets(pa.array([r[5] for r in rows], pa.large_string()))):
            if node not in known and digest(tokens) == node:
                known[node] = (block, copies, tokens)
        nodes = sorted(known)
        blocks, copies = [known[n][0] for n in nodes], np.array([known[n][1] for n in nodes], np.int64)
        sets = [known[n][2] for n in nodes]
        everyone = list(range(len(nodes)))
        first = min(blocks, default=0)
        left = [i for i in everyone if blocks[i] == first]
        right = [i for i in everyone if blocks[i] != first]
        links, parent = np.zeros(len(nodes), np.int64), everyone.copy()
        for i, hit in overlaps(sets, left, right if pair else left) if (right or not pair) else ():
            links[i] += copies[hit].sum()
            if pair:
                links[hit] += copies[i]
            for j in hit:
                a, b = _root(parent, i), _root(parent, int(j))
                parent[max(a, b)] = min(a, b)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(nodes, pa.binary()),
                pa.array(links, pa.int64()),
                pa.array([nodes[_root(parent, i)] for i in everyone], pa.binary()),
            ],
            names=["node", "links", "root"],
        )


def id_key(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def text_key() -> Column:
    """With the doc_id, what tells a row's text from others: ids may be null or repeated."""
    return F.xxhash64("text").alias("text_key")


def _exact(documents: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, links, root) of the nodes on candidate edges, from the whole text of one row of each."""
    group = components(edges).select(F.col("vertex").alias("node"), F.col("root").alias("grouped"))
    members = materialize(nodes.select("node", "n", "copies", "row").join(group, "node"), "join-groups")
    heavy = members.groupBy("grouped").agg(F.ceil(2 * F.sum("n") / UNIT_SHINGLES).cast("int").alias("blocks")).filter("blocks > 2")
    cut = members.join(heavy, "grouped", "left").withColumn(
        "block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks"))).cast("int")
    )
    partner = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
    units = cut.select("*", partner.alias("other")).select(
        F.xxhash64("grouped", F.least("block", "other"), F.greatest("block", "other")).alias("unit"),
        (F.col("block") != F.col("other")).alias("pair"),
        "block", "node", "copies", id_key("row.doc_id").alias("key"), F.col("row.text_key").alias("text_key"),
    )
    texts = documents.select(id_key("doc_id").alias("key"), text_key(), "text")
    found = (
        texts.join(units.hint("merge"), ["key", "text_key"])  # alike at every size: no broadcast while the groups are few
        .select("unit", "pair", "block", "node", "copies", "text")
        .repartition("unit")
        .sortWithinPartitions("unit", "node")
        .mapInArrow(_verify, "node binary, links bigint, root binary")
    )
    found = materialize(found, "join-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.filter("root <> node").select(F.col("node").alias("u"), F.col("root").alias("v")))
    return links.join(roots.withColumnRenamed("vertex", "node"), "node", "left").select(
        "node", "links", F.coalesce("root", "node").alias("root")
    )


def join_texts(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, node, class_node, class_id, n_links) for every row of ``documents`` (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets reaches THRESHOLD; n_links
    counts the documents a row is linked with, copies too. A class is a connected component of
    links, named by its least doc_id. Equal sets are one node, joined once. A text of fewer than
    NGRAM words is one n-gram; a null text or one without words is a class of its own, without
    links. Null ids and repeated rows stay rows; other columns are ignored.
    """
    kind = dict(documents.dtypes)["doc_id"]
    documents = documents.select("doc_id", "text")
    runs = runs_for(RECALL)
    keyed = documents.select("doc_id", "text", text_key())
    rows = materialize(keyed.mapInArrow(lambda b: _sketches(b, runs), SKETCH.format(kind=kind)), "join-sketches")
    nodes = materialize(
        rows.filter("n > 0")
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.min(F.struct("doc_id", "text_key")).alias("row"),
            F.count("*").alias("copies"),
            F.first("n").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("paths").alias("paths"),
        ),
        "join-nodes",
    )
    exact = materialize(_exact(documents, nodes, candidate_edges(nodes)), "join-exact")
    linked = nodes.select("node", "doc_id", "copies").join(exact, "node", "left")
    linked = materialize(linked.withColumn("root", F.coalesce("root", "node")), "join-classes")
    names = linked.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    of_node = linked.join(names, "root").select(
        "node", F.col("root").alias("class_node"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    worded = F.col("n") > 0
    return rows.select("doc_id", "text_key", "node", "n").join(of_node, "node", "left").select(
        "doc_id",
        "text_key",
        "node",
        F.coalesce("class_node", "node").alias("class_node"),
        F.when(worded, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each(documents: DataFrame) -> DataFrame:
    """One row of each class of ``documents``, all columns as they were: the one of the least doc_id.

    Rows without words are copies of no row and all stay. Of rows alike in id and text, any one
    stays. Null ids and repeated ids stay rows of their own; columns of any name come back as they were.
    """
    ranked = materialize(join_texts(documents).withColumn("key", id_key("doc_id")).drop("class_id", "n_links"), "join-ranked")
    order = [F.col("doc_id").asc_nulls_last(), "node", "text_key"]
    nth = F.row_number().over(Window.partitionBy("class_node").orderBy(*order))
    first = ranked.filter(F.col("node") != F.lit(NO_WORDS)).withColumn("nth", nth).filter("nth = 1").select("key", "text_key")
    repeated = ranked.groupBy("key", "text_key").agg(F.count("*").alias("m")).filter("m > 1")
    named = documents.select(F.struct("*").alias("row"), id_key("doc_id").alias("key"), text_key())
    keys = ["key", "text_key"]
    single = named.join(first.join(repeated, keys, "left_anti"), keys, "left_semi")
    several = named.join(first.join(repeated, keys, "left_semi"), keys, "left_semi").dropDuplicates(keys)
    empty = documents.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return single.select("row.*").unionAll(several.select("row.*")).unionAll(empty)
