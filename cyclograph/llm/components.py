"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.session import materialize


def _minima(pairs: DataFrame) -> DataFrame:
    """(u, m): the least of each vertex and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) for the vertices of the edges (u, v): root is the least vertex of its component.

    Each round is a few joins of at most as many rows as there are edges; no vertex's neighbours
    are gathered. Loops and repeated edges do no harm, null vertices are left out.
    """
    now = materialize(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).unionAll(
                now.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()
            )
        before = mark
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_minima(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = _minima(large)
        hung = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(hung.unionAll(least.withColumnRenamed("m", "v")).distinct(), "edges")
