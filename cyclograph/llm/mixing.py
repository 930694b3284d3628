"""Mixing sources to target weights by entropy balancing.

Each document gets a rate, its expected number of copies between 0 and MOST. Among all rates
that meet the sources' token targets, the ones of least relative entropy to a common rate are
exponentially tilted by size: log(rate / (MOST - rate)) = base + tilt of the source x size. The
tilts solve the convex dual; Newton's method finds them, each step one aggregation over the
counts of documents by source and size. Rates are then rounded into whole copies, passing each
document's rounding error on to the next one of its chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cyclograph.llm.columns import free_prefix, named, sort_key
from cyclograph.llm.words import text_chunks, word_counts
from cyclograph.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
CHUNK_ROWS = 2_000
STEPS = 60
PRECISION = 1e-7
ADDED = ("source_size", "target", "copies")


def count_words(text: str) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""

    @arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        parts = [word_counts(data, offsets) for _, data, offsets in text_chunks(texts)]
        return pa.array(np.concatenate(parts) if parts else [], pa.int64())

    return counted(F.col(f"`{text}`"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """source_id, source, source_size, n_rows and target of each source.

    Sources stand in code point order, null last, and take the weights in turn. They divide
    ``share`` of all sizes by weight; what would exceed MOST times a source's own size goes to the
    others by weight, until none is above. With sources ordered by the level at which they are
    full, the level of the others follows from running sums; there is one row for each source here.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("__full", "source_id")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("source_id") - 1) % len(weights) + 1).cast("int"))
    ranked = (
        sources.withColumn("source_id", F.row_number().over(by_name))
        .withColumn("__weight", weight.cast("double"))
        .withColumn("__cap", (MOST * F.col("source_size")).cast("double"))
        .withColumn("__full", F.col("__cap") / F.col("__weight"))
    )
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) * share - F.coalesce(
        F.sum("__cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    level = left / F.sum("__weight").over(by_level.rowsBetween(0, Window.unboundedFollowing))
    reached = ranked.withColumn("__level", level).withColumn("__at", F.row_number().over(by_level))
    fits = F.when(F.col("__level") <= F.col("__full"), F.col("__at"))
    final = F.min_by("__level", fits).over(everything)
    return reached.select(
        "source_id", "source", "source_size", "n_rows",
        F.least("__cap", F.col("__weight") * F.coalesce(final, F.lit(float("inf")))).alias("target"),
    )


def _rate(size: Column, prefix: str = "") -> Column:
    tilt, scale, full = (F.col(prefix + c) for c in ("tilt", "scale", "full"))
    tilted = MOST / (1 + F.exp(-(F.lit(float(np.log(SHARE / (MOST - SHARE)))) + tilt * size / scale)))
    return F.when(full, F.lit(float(MOST))).otherwise(tilted)


def _exact_sum(column: Column) -> Column:
    """A sum that doesn't depend on the order of its terms."""
    return F.sum(column.cast("decimal(38,6)")).cast("double")


def solve(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Tilt of each source: ``wanted`` with columns scale, full, tilt.

    Newton's step is taken where it stays inside the bracket known so far, else the bracket is
    halved or widened. A source whose target is all it can give is full and needs no tilt. A gap
    that is still above PRECISION after STEPS steps raises.
    """
    counts = materialize(counts, "mix-counts")
    start = wanted.select(
        "*",
        F.greatest(F.col("source_size") / F.greatest("n_rows", F.lit(1)), F.lit(1.0)).alias("scale"),
        (F.col("target") >= MOST * F.col("source_size") * (1 - PRECISION)).alias("full"),
        F.lit(0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(None).cast("double").alias("gap"),
    )
    state = materialize(start, "mix-tilts")
    fixed = [c for c in state.columns if c not in ("tilt", "low", "high", "gap")]
    for _ in range(STEPS):
        rate = _rate(F.col("size"))
        sums = (
            counts.join(state.filter("NOT full"), "source_id")
            .withColumn("rate", rate)
            .groupBy("source_id")
            .agg(
                _exact_sum(F.col("n") * F.col("size") * F.col("rate")).alias("words"),
                _exact_sum(F.col("n") * F.col("size") * F.col("size") / F.col("scale") * F.col("rate") * (1 - F.col("rate") / MOST)).alias("slope"),
            )
        )
        over = F.col("words") - F.col("target")
        low = F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - over / F.col("slope")
        inside = (F.col("slope") > 0) & (F.col("low").isNull() | (step > F.col("low"))) & (F.col("high").isNull() | (step < F.col("high")))
        wide = F.when(F.col("low").isNull(), 2 * F.col("high") - 1).when(F.col("high").isNull(), 2 * F.col("low") + 1)
        moved = state.join(sums, "source_id", "left").withColumn("low", low).withColumn("high", high)
        state = materialize(
            moved.select(
                *fixed,
                F.when(F.col("full") | (over == 0) | F.col("words").isNull(), F.col("tilt"))
                .when(inside, step)
                .otherwise(F.coalesce(wide, (F.col("low") + F.col("high")) / 2))
                .alias("tilt"),
                "low",
                "high",
                F.coalesce(F.abs(over) / F.greatest("target", F.lit(1.0)), F.lit(0.0)).alias("gap"),
            ),
            "mix-tilts",
        )
        gap = state.agg(F.max("gap")).first()[0] or 0
        if gap < PRECISION:
            break
    else:
        raise RuntimeError(f"no tilts found: a source is {gap:.2g} of its target away after {STEPS} steps")
    return state.drop("low", "high", "gap").withColumn("tilt", F.round("tilt", 12))


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole copies for rows ordered by source and chunk; the rounding error moves on within a chunk."""
    chunk, error = None, 0.0
    for batch in batches:
        n = batch.num_columns
        source, part, size, rate = (batch.column(i).to_pylist() for i in range(n - 4, n))
        out = np.zeros(batch.num_rows, np.int64)
        for i, (s, p, w, r) in enumerate(zip(source, part, size, rate)):
            if (s, p) != chunk:
                chunk, error = (s, p), 0.0
            if w:
                error += r * w
                out[i] = copies = min(MOST, max(0, int(np.floor(error / w + 0.5))))
                error -= copies * w
        yield pa.RecordBatch.from_arrays(batch.columns[: n - 4] + [pa.array(out)], names=batch.schema.names[: n - 4] + ["copies"])


def mix(documents: DataFrame) -> DataFrame:
    """All rows and columns of ``documents`` (doc_id, source, size and others), with source_size,
    target and copies, the number of times the mix takes the document (0 to MOST).

    Documents of size 0 are taken no time; a null size counts as 0; null is a source of its own,
    the last one. Large sources are rounded in several chunks of about CHUNK_ROWS rows, in falling
    order of size, so that small documents make up for what large ones leave. Reruns agree.
    """
    names = [c for c in documents.columns if c.lower() not in ADDED]
    rows = documents.select(*[named(c) for c in names]).withColumn("size", F.coalesce("size", F.lit(0)).cast("bigint"))
    by_size = materialize(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-sizes")
    wanted = materialize(
        targets(by_size.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_rows"))),
        "mix-targets",
    )
    same = by_size["source"].eqNullSafe(wanted["source"])
    state = solve(by_size.join(wanted, same).select("source_id", "size", "n"), wanted)
    prefix = free_prefix(rows)
    source_id, part, size, rate = (prefix + c for c in ("source_id", "chunk", "size", "rate"))
    state = state.select(*[F.col(c).alias(prefix + c) for c in state.columns])
    joined = rows.join(state, F.col("source").eqNullSafe(F.col(prefix + "source")))
    chunk = F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col(prefix + "n_rows") / CHUNK_ROWS))
    shaped = joined.select(
        *[named(c) for c in names], F.col(prefix + "source_size").alias("source_size"), F.col(prefix + "target").alias("target"),
        F.col(prefix + "source_id").alias(source_id), chunk.alias(part), F.col("size").alias(size), _rate(F.col("size"), prefix).alias(rate),
    )
    ordered = shaped.repartition(source_id, part).sortWithinPartitions(
        source_id, part, F.desc(size), "doc_id", *[sort_key(rows, c) for c in names if c not in ("doc_id", "size", "source")]
    )
    numbered = ordered.toDF(*[f"c{i}" for i in range(len(ordered.columns))])  # mapInArrow takes no dots in names
    schema = numbered.select(numbered.columns[:-4]).schema.add("copies", "long")
    return numbered.mapInArrow(_copies, schema).toDF(*ordered.columns[:-4], "copies")
