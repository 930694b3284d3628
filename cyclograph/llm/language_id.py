"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is one matrix of log-probabilities, buckets x languages, which every executor gets
once. A batch of texts becomes arrays of bucket numbers, the batch's sparse feature rows; the
score of a text is the sum of the matrix rows its n-grams point at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cyclograph.llm.columns import free_name, named, others
from cyclograph.llm.words import text_chunks

BUCKETS = 1 << 16
LENGTHS = (1, 2, 3)
SMOOTHING = 0.1
UNKNOWN = "und"

LEAST_TYPICAL = -20.0
"""Standard deviations below the usual log-probability of a language's n-grams at which a text isn't in it."""

_BLANK = 32


@dataclass(frozen=True)
class Model:
    """Learned languages in order, and the log-probability of each bucket; the last row is zero.

    ``usual``: for each language the mean log-probability of an n-gram over its texts, the variance
    of that between texts, and the variance of n-grams inside a text.
    """

    languages: tuple[str, ...]
    prior: np.ndarray
    weights: np.ndarray
    usual: np.ndarray


_TABLES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Lower-case code point of each letter of the basic plane; a blank for all else."""
    if "letters" in _TABLES:
        return _TABLES["letters"]
    out = _TABLES["letters"] = np.full(1 << 16, _BLANK, np.uint32)
    for point in range(1 << 16):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            out[point] = ord(low) if len(low) == 1 else point
    return out


def bucket_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of bucket numbers for each n-gram length, offsets of the texts in code points).

    Letters are lower-cased, all else is a blank. An n-gram that leaves its text or begins with
    two blanks gets the number BUCKETS, whose weight is zero.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    code = np.where(points < 1 << 16, _letters()[np.minimum(points, (1 << 16) - 1)], points)
    n = len(code)
    blank = code == _BLANK
    rows = np.full((len(LENGTHS), n), BUCKETS, np.uint32)
    ends = at[1:]
    for row, k in zip(rows, LENGTHS):
        if n < k:
            continue
        h = np.full(n - k + 1, k, np.uint32)
        for j in range(k):
            h = (h ^ code[j : n - k + 1 + j]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        row[: n - k + 1] = (h * np.uint32(0x85EBCA6B)) >> np.uint32(16)
        empty = blank[: n - k + 1].copy()
        if k > 1:
            empty &= blank[1 : n - k + 2]
        row[: n - k + 1][empty] = BUCKETS
        for back in range(1, k):
            out = ends - back
            row[out[out >= 0]] = BUCKETS
    return rows, at


def scores(column: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(summed log-probabilities, texts x languages; number of n-grams of each text)."""
    out, n = np.zeros((len(column), weights.shape[1])), np.zeros(len(column), np.int64)
    limit = max(1 << 14, (1 << 21) // max(4, weights.shape[1]))
    for row, data, offsets in text_chunks(column, limit):
        if not len(data):
            continue
        rows, at = bucket_numbers(data, offsets)
        full = np.flatnonzero(np.diff(at))
        for buckets in rows:
            n[row + full] += np.add.reduceat(buckets != BUCKETS, at[full])
            if len(data) > limit:  # such a text is alone, whatever its neighbours
                counts = np.bincount(buckets, minlength=BUCKETS + 1)
                used = np.flatnonzero(counts)
                out[row + full[0]] += counts[used] @ weights[used]
            else:
                out[row + full] += np.add.reduceat(weights[buckets], at[full], axis=0)
    return out, n


def _usual(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each language of (language, text): texts, and sums of their n-grams' mean log-probability, its
    square, and the variance inside the text."""
    total = np.zeros((weights.shape[1], 4))
    both = np.hstack([weights, weights**2])
    for batch in batches:
        language = batch.column(0).to_numpy(zero_copy_only=False)
        summed, n = scores(batch.column(1), both)
        full = n > 0
        language, n = language[full], n[full]
        mean, square = (summed[full, language + k * weights.shape[1]] / n for k in (0, 1))
        np.add.at(total, language, np.stack([np.ones(len(n)), mean, mean**2, np.maximum(square - mean**2, 0)], axis=1))
    columns = [pa.array(np.arange(len(total), dtype=np.int32)), *[pa.array(total[:, k]) for k in range(4)]]
    yield pa.RecordBatch.from_arrays(columns, ["language", "n", "mean", "square", "inside"])


def _counts(batches: Iterator[pa.RecordBatch], n_languages: int) -> Iterator[pa.RecordBatch]:
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        language = batch.column(0).to_numpy(zero_copy_only=False)
        for row, data, offsets in text_chunks(batch.column(1)):
            if not len(data):
                continue
            rows, at = bucket_numbers(data, offsets)
            of_point = np.repeat(language[row : row + len(at) - 1], np.diff(at))
            for i in np.unique(of_point):
                total = found.setdefault(int(i), np.zeros(BUCKETS + 1, np.int64))
                for buckets in rows:
                    total += np.bincount(buckets[of_point == i], minlength=BUCKETS + 1)
    for i, total in found.items():
        used = np.flatnonzero(total[:BUCKETS])
        yield pa.RecordBatch.from_pydict(
            {
                "language": pa.array(np.full(len(used), i, np.int32)),
                "bucket": pa.array(used.astype(np.int32)),
                "n": pa.array(total[used]),
            }
        )


def fit(labelled: DataFrame, rows_per_language: int = 3000, max_languages: int = 256) -> Model:
    """Learn from (doc_id, lang, text); rows without a lang teach nothing.

    ``rows_per_language`` bounds the sample: from a language with more rows, each row is taken
    with equal chance by a hash of its doc_id, so that about that many are read. More than
    ``max_languages`` languages raise, since the matrix has one column for each. Rows without
    text or letters count for the priors only. Without any row, every text is ``und``.
    """
    spark = labelled.sparkSession
    labelled = labelled.filter("lang IS NOT NULL")
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().orderBy("lang").limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"over {max_languages} languages")
    if not sizes:
        return Model((), np.zeros(0), np.zeros((BUCKETS + 1, 0)), np.zeros((0, 3)))
    languages = tuple(sizes)
    known = spark.createDataFrame(
        [(i, name, min(1.0, rows_per_language / n)) for i, (name, n) in enumerate(sizes.items())],
        "language int, lang string, share double",
    )
    part = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.join(F.broadcast(known), "lang").filter(part < F.col("share")).select("language", "text")
    counted = (
        sample.mapInArrow(lambda b: _counts(b, len(languages)), "language int, bucket int, n bigint")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros((BUCKETS, len(languages)))
    counts[counted["bucket"].to_numpy(), counted["language"].to_numpy()] = counted["n"].to_numpy()
    weights = np.zeros((BUCKETS + 1, len(languages)))
    weights[:-1] = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS))
    rows = np.array([sizes[name] for name in languages], float)
    shared = spark.sparkContext.broadcast(weights)
    kinds = "language int, n double, mean double, square double, inside double"
    parts = sample.mapInArrow(lambda batches: _usual(batches, shared.value), kinds)
    found = parts.groupBy("language").agg(*[F.sum(c).alias(c) for c in ("n", "mean", "square", "inside")]).toArrow().sort_by("language")
    n, mean, square, inside = (found[c].to_numpy() / np.maximum(found["n"].to_numpy(), 1) for c in ("n", "mean", "square", "inside"))
    usual = np.zeros((len(languages), 3))
    usual[found["language"].to_numpy()] = np.stack([mean, np.maximum(square - mean**2, 0), inside], axis=1)
    return Model(languages, np.log(rows / rows.sum()), weights, usual)


def typicality(total: np.ndarray, n: np.ndarray, best: np.ndarray, usual: np.ndarray) -> np.ndarray:
    """How many standard deviations a text's mean log-probability lies above its language's usual one.

    The posterior says which language is the likeliest; this says whether the text is like that
    language at all, and doesn't grow with the text's length.
    """
    mean, between, inside = usual[best].T
    own = total[np.arange(len(best)), best] / np.maximum(n, 1)
    spread = np.sqrt(between + inside / np.maximum(n, 1))
    return np.where((n > 0) & (spread > 0), (own - mean) / np.where(spread > 0, spread, 1), 0.0)


def predict(df: DataFrame, model: Model, text: str = "text", into: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """Add the predicted language of every whole text and its posterior probability (0 to 1).

    A third name in ``into`` asks for the text's ``typicality`` too. Texts that are null or hold no
    letter get ``und`` with score and typicality 0. Equal scores go to the first language in order. All
    rows and columns stay; columns named like the new ones, whatever their case, are replaced.
    """
    languages, usual = model.languages, model.usual
    shared = df.sparkSession.sparkContext.broadcast((model.prior, model.weights))

    @arrow_udf("struct<lang: string, score: double, typical: double>")
    def language(texts: pa.Array) -> pa.Array:
        prior, weights = shared.value
        likely, n = scores(texts, weights)
        total = likely + prior
        best = total.argmax(axis=1)
        sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        names = pa.array(languages, pa.string()).take(pa.array(best))
        typical = typicality(likely, n, best, usual)
        return pa.StructArray.from_arrays([names, pa.array(sure), pa.array(typical)], ["lang", "score", "typical"])

    column = named(text)
    if not languages:
        found = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(0.0).alias("typical"))
    else:
        found = language(column)
    lettered = F.coalesce(column.rlike(r"\p{L}"), F.lit(False))
    kept = others(df, into)
    # The helper columns' names are free in df.
    a, b = free_name(df, "found"), free_name(df, "lettered")
    values = [F.when(named(b), named(a)[field]).otherwise(nothing) for field, nothing in (("lang", UNKNOWN), ("score", 0.0), ("typical", 0.0))]
    placed = df.select(*kept, found.alias(a), lettered.alias(b))
    return placed.select(*kept, *[value.alias(name) for value, name in zip(values, into)])


def held_out(doc_id) -> F.Column:
    """Whether a document is kept back for testing: its crc32 leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
