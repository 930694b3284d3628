"""Running many checks on one table, and keeping the outcome."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.quality.core import Check

RESULT_SCHEMA = "test_name string, status string, failures bigint, execution_time double"


def _named(check: Check, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(check.name).alias("test_name"), check.status(F.col("failures")).alias("status"), "failures"
    )


def outcomes(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(test_name, status, failures), lazily.

    All checks with a counter share one scan and one aggregation; sets, orders, joins
    and quantiles run as their own sub-plans.
    """
    fused = [c for c in checks if c.counter is not None]
    parts = []
    if fused:
        counts = df.agg(*[c.counter.cast("bigint").alias(f"c{i}") for i, c in enumerate(fused)])
        entries = F.array(
            *[
                F.struct(F.lit(i).alias("i"), F.lit(c.name).alias("test_name"), F.col(f"c{i}").alias("failures"))
                for i, c in enumerate(fused)
            ]
        )
        listed = counts.select(F.inline(entries))
        status = F.lit(None).cast("string")
        for i, check in reversed(list(enumerate(fused))):
            status = F.when(F.col("i") == i, check.status(F.col("failures"))).otherwise(status)
        parts.append(listed.select("test_name", status.alias("status"), "failures"))
    parts += [_named(c, c.failures(df)) for c in checks if c.counter is None]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def run(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The outcomes with their run time: one job for all, so that each reports the time of all."""
    started = time.perf_counter()
    found = outcomes(df, checks).collect()  # one row per check
    seconds = time.perf_counter() - started
    rows = [(r["test_name"], r["status"], r["failures"], seconds) for r in found]
    return df.sparkSession.createDataFrame(rows, RESULT_SCHEMA)
