"""Quality classifier: a convolutional network over the bytes of whole texts, in numpy.

A text is cut into blocks of BLOCK bytes; two neighbouring blocks are a chunk, so that chunks
overlap by half and every filter window lies whole inside one. A filter's answer for a chunk is
its maximum over the chunk's positions, after ReLU; mean and maximum of the chunks' answers are
the features of a text, from which one logistic unit makes the probability of label 1.

Byte vectors and filters are learned together (Adam, on the driver) from a bounded sample. For
scoring they fold into one table for each place in the window: a filter's answer is a sum of
WIDTH table rows, with no multiplication.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cyclograph.llm.columns import named, others
from cyclograph.llm.words import text_chunks

BLOCK = 128
WIDTH = 5
FILTERS = 24
DIMENSIONS = 8
PADDING = 256
"""Stands for the bytes after a text's end; an empty text is one block of it."""

GROUP = 64
"""Blocks whose answers are computed together, so that they stay in a core's cache."""

STEPS = 500
MINIBATCH = 64
RATE = 0.01
DECAY = 1e-4

SAMPLE_ROWS = 1500
"""Labelled rows of each label from which the network is learned, at most."""

SAMPLE_BLOCKS = 32
"""Blocks of one sampled text that are learned from, evenly spread over the whole text, at most."""

Network = tuple[np.ndarray, np.ndarray, np.ndarray, float]
"""Tables (WIDTH, 257, FILTERS), bias, weights of the features, offset: plain arrays, for broadcast."""


def held_out(doc_id) -> F.Column:
    """Whether a document is kept back for testing: its crc32 is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def blocks_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(blocks with the WIDTH - 1 bytes after them, first block of each text and the end)."""
    lengths = np.diff(offsets)
    n = np.maximum(1, -(-lengths // BLOCK))
    first = np.concatenate([[0], np.cumsum(n)])
    text = np.repeat(np.arange(len(lengths)), n)
    begins = offsets[:-1][text] + (np.arange(first[-1]) - first[:-1][text]) * BLOCK
    at = begins[:, None] + np.arange(BLOCK + WIDTH - 1)
    outside = at >= offsets[1:][text][:, None]
    at[outside] = 0
    blocks = data[at].astype(np.int16) if len(data) else np.zeros(at.shape, np.int16)
    blocks[outside] = PADDING
    return blocks, first


def answers(blocks: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The filters' values at every position of the blocks: (blocks, BLOCK, FILTERS)."""
    total = tables[0][blocks[:, :BLOCK]]
    for j in range(1, WIDTH):
        total += tables[j][blocks[:, j : j + BLOCK]]
    return total


def block_maxima(blocks: np.ndarray, tables: np.ndarray) -> np.ndarray:
    out = np.empty((len(blocks), tables.shape[2]), np.float32)
    for i in range(0, len(blocks), GROUP):
        answers(blocks[i : i + GROUP], tables).max(axis=1, out=out[i : i + GROUP])
    return out


def chunks_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first block of each chunk, first chunk of each text); a single block is a chunk too."""
    n = np.maximum(1, np.diff(first) - 1)
    chunk = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(first[:-1] - chunk[:-1], n) + np.arange(chunk[-1]), chunk


def pooled(maxima: np.ndarray, first: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Features of each text: mean and maximum over its chunks, texts x 2 FILTERS."""
    left, chunk = chunks_of(first)
    alone = np.repeat(np.diff(first) == 1, np.diff(chunk))
    value = np.maximum(maxima[left], maxima[np.where(alone, left, left + 1)])
    value = np.maximum(value.astype(np.float64) + bias, 0.0)
    mean = np.add.reduceat(value, chunk[:-1], axis=0) / np.diff(chunk)[:, None]
    return np.hstack([mean, np.maximum.reduceat(value, chunk[:-1], axis=0)])


def probabilities(column: pa.Array, network: Network) -> np.ndarray:
    """Probability of label 1 of each text; null counts as empty."""
    tables, bias, weights, offset = network
    out = np.zeros(len(column))
    for row, data, offsets in text_chunks(column):
        blocks, first = blocks_of(data, offsets)
        features = pooled(block_maxima(blocks, tables), first, bias)
        logit = (features * weights).sum(axis=1) + offset
        out[row : row + len(logit)] = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
    return out


def learn(texts: list[np.ndarray], labels: np.ndarray, prior: float, seed: int = 5, steps: int = STEPS) -> Network:
    """Fit a network to blocks of texts, each (blocks, BLOCK + WIDTH - 1); ``prior`` is label 1's true share."""
    rng = np.random.default_rng(seed)
    state = {
        "bytes": rng.normal(0, 0.5, (PADDING + 1, DIMENSIONS)),
        "filters": rng.normal(0, 0.3, (WIDTH, DIMENSIONS, FILTERS)),
        "bias": np.zeros(FILTERS),
        "weights": rng.normal(0, 0.1, 2 * FILTERS),
        "offset": np.zeros(1),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in state.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if not len(order):
            order = rng.permutation(len(texts))
        part, order = order[:MINIBATCH], order[MINIBATCH:]
        slopes = gradients(state, [texts[k] for k in part], labels[part])[1]
        for k, slope in slopes.items():
            slope = slope + DECAY * state[k]
            a, b = moments[k]
            a += 0.1 * (slope - a)
            b += 0.001 * (slope * slope - b)
            state[k] = state[k] - RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    share = labels.mean()
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share))
    return folded(state), state["bias"], state["weights"], float(state["offset"][0] + shift)


def folded(state: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([state["bytes"] @ f for f in state["filters"]]).astype(np.float32)


def gradients(state: dict[str, np.ndarray], texts: list[np.ndarray], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean logistic loss of some texts and its slope along every parameter."""
    tables, n = folded(state), len(texts)
    blocks = np.concatenate(texts)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    maxima = np.empty((len(blocks), FILTERS), np.float32)
    place = np.empty((len(blocks), FILTERS), np.int64)
    for i in range(0, len(blocks), GROUP):
        value = answers(blocks[i : i + GROUP], tables)
        place[i : i + GROUP] = value.argmax(axis=1)
        maxima[i : i + GROUP] = np.take_along_axis(value, place[i : i + GROUP, None], axis=1)[:, 0]
    left, chunk = chunks_of(first)
    sizes = np.diff(chunk)
    alone = np.repeat(np.diff(first) == 1, sizes)
    right = np.where(alone, left, left + 1)
    block = np.where(maxima[right] > maxima[left], right[:, None], left[:, None])
    columns = np.arange(FILTERS)
    value = maxima[block, columns].astype(np.float64) + state["bias"]
    positive = value > 0
    value = np.maximum(value, 0)
    mean = np.add.reduceat(value, chunk[:-1], axis=0) / sizes[:, None]
    top = np.maximum.reduceat(value, chunk[:-1], axis=0)
    features = np.hstack([mean, top])
    logit = features @ state["weights"] + state["offset"][0]
    loss = np.mean(np.logaddexp(0, logit) - labels * logit)
    error = (1 / (1 + np.exp(-logit)) - labels) / n
    slope = error[:, None] * state["weights"]
    text = np.repeat(np.arange(n), sizes)
    highest = value >= top[text]
    ties = np.add.reduceat(highest, chunk[:-1], axis=0)[text]
    down = slope[text, :FILTERS] / sizes[text, None] + slope[text, FILTERS:] * highest / ties
    down = down * positive
    row, column = block.ravel(), np.broadcast_to(columns, block.shape).ravel()
    at, weight = place[row, column], down.ravel()
    d_bytes, d_filters = np.zeros_like(state["bytes"]), np.zeros_like(state["filters"])
    for j in range(WIDTH):
        code = blocks[row, at + j].astype(np.int64) * FILTERS + column
        d_table = np.bincount(code, weights=weight, minlength=(PADDING + 1) * FILTERS).reshape(PADDING + 1, FILTERS)
        d_bytes += d_table @ state["filters"][j].T
        d_filters[j] = state["bytes"].T @ d_table
    return loss, {
        "bytes": d_bytes,
        "filters": d_filters,
        "bias": down.sum(axis=0),
        "weights": features.T @ error,
        "offset": np.array([error.sum()]),
    }


def _spread_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of each text as bytes, neighbours in pairs, at most SAMPLE_BLOCKS of them."""
    for batch in batches:
        packed = []
        for _, data, offsets in text_chunks(batch.column(1)):
            blocks, first = blocks_of(data, offsets)
            for a, b in zip(first[:-1], first[1:]):
                chosen = np.arange(a, b)
                if len(chosen) > SAMPLE_BLOCKS:
                    pair = np.linspace(a, b - 2, SAMPLE_BLOCKS // 2).astype(np.int64)
                    chosen = np.unique(np.concatenate([pair, pair + 1]))
                packed.append(blocks[chosen].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["label", "blocks"])


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    """Learn from ``documents`` (doc_id, text) and ``labels`` (doc_id, quality 0 or 1).

    The driver gets at most ``rows`` rows of each label, chosen by a hash of the doc_id among all
    labelled ones, and at most SAMPLE_BLOCKS blocks of each. Other qualities and null ids teach
    nothing. If one label is missing, every score is the smoothed share of label 1 (0.5 without
    any label).
    """
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).filter("label IN (0, 1) AND doc_id IS NOT NULL")
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    zeros, ones = counts.get(0, 0), counts.get(1, 0)
    prior = (ones + 1) / (zeros + ones + 2)
    constant = (np.zeros((WIDTH, PADDING + 1, FILTERS), np.float32), np.zeros(FILTERS), np.zeros(2 * FILTERS), float(np.log(prior / (1 - prior))))
    if not zeros or not ones:
        return constant
    order = [F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality")), F.col("doc_id")]
    chosen = [known.filter(F.col("label") == k).orderBy(*order).limit(rows) for k in (0, 1)]
    sample = F.broadcast(chosen[0].unionAll(chosen[1]))
    texts = documents.select("doc_id", "text").join(sample, "doc_id")
    texts = texts.orderBy(*order, F.xxhash64("text"), "label").limit(2 * rows).select("label", F.col("text").cast("string").alias("text"))
    rows_ = texts.mapInArrow(_spread_blocks, "label int, blocks binary").toArrow()
    labels_ = rows_["label"].to_numpy().astype(float)
    if len(set(labels_)) < 2:
        return constant
    width = BLOCK + WIDTH - 1
    packed = [np.frombuffer(b.as_buffer(), np.int16).reshape(-1, width) for b in rows_["blocks"]]
    return learn(packed, labels_, prior)


def predict(df: DataFrame, network: Network, text: str = "text", into: str = "score") -> DataFrame:
    """Add the probability (0 to 1) that a text's label is 1, from every byte of it.

    A null text counts as empty; an empty text gets the probability of a block of padding. All
    rows and columns stay, repeated rows too; a column named like the new one, whatever its case,
    is replaced. A text's score doesn't depend on the texts beside it.
    """
    shared = df.sparkSession.sparkContext.broadcast(network)

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(probabilities(texts, shared.value))

    return df.select(*others(df, [into]), score(named(text).cast("string")).alias(into))
