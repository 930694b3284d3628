"""Keep-latest and upsert (PRJ4, SNK6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_column


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``; among equals, the one of the least digest of its columns.

    ``row_number() = 1`` is recognised by the optimizer, which trims every map-side
    partition to one row per key before the shuffle, so a key that owns a large share
    of the rows never reaches a single task whole.
    """
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    window = Window.partitionBy(*[as_column(k) for k in keys]).orderBy(*order, digest)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def upsert(current: DataFrame, changes: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Matched keys take the incoming row unless it is older; new keys are added."""
    tagged = current.withColumn("__incoming", F.lit(0)).unionByName(changes.withColumn("__incoming", F.lit(1)))
    order = [F.col(version).desc_nulls_last(), F.col("__incoming").desc()]
    return keep_first(tagged, keys, order).drop("__incoming")
