"""Exact quantiles with linear interpolation, per group or over the whole table (AG12, AG13, WN14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_column

def exact_quantile(df: DataFrame, value: Column | str, quantile: float, groups: Sequence[Column | str] = ()) -> DataFrame:
    """(groups..., quantile_value); NULL values do not count. Nothing runs until the result is read.
    A group given as a column is named ``__g`` and its position.

    Equal values are counted first. The counts are then cut into ranges of values, which run
    through large groups, and each range is summed up: its first and last value, how many
    rows it holds and how many come before it in its group. The ranges in which the two
    wanted ranks fall give back their values alone, so no task sees more than a range.
    Each range is known by its values, so it doesn't matter how the cut was made.
    """
    keys = [f"__g{i}" for i in range(len(groups))]
    named = [as_column(g).alias(k) for g, k in zip(groups, keys)]
    rows = df.select(*named, as_column(value).cast("double").alias("__v")).filter("__v IS NOT NULL")
    # One constant key stands in for no groups, so that joins below have an equality.
    keys = keys or ["__g"]
    counted = (rows if named else rows.withColumn("__g", F.lit(0))).groupBy(*keys, "__v").agg(F.count("*").alias("__times"))

    ranged = counted.repartitionByRange(*[F.col(k) for k in [*keys, "__v"]])
    sizes = (
        ranged.withColumn("__range", F.spark_partition_id())
        .groupBy(*keys, "__range")
        .agg(F.sum("__times").alias("__size"), F.min("__v").alias("__from"), F.max("__v").alias("__to"))
    )
    earlier = Window.partitionBy(*keys).orderBy("__from").rowsBetween(Window.unboundedPreceding, -1)
    exact_rank = (F.sum("__size").over(Window.partitionBy(*keys)) - 1) * F.lit(float(quantile))
    ranges = sizes.select(
        *[F.col(k).alias(f"{k}r") for k in keys],
        "__from",
        "__to",
        F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"),
        "__size",
        exact_rank.alias("__rank"),
    )
    low, high = F.floor("__rank"), F.ceil("__rank")
    holds_a_rank = (low < F.col("__before") + F.col("__size")) & (high >= F.col("__before"))
    same = [F.col(k).eqNullSafe(F.col(f"{k}r")) for k in keys]
    within = F.col("__v").between(F.col("__from"), F.col("__to"))
    candidates = counted.join(ranges.filter(holds_a_rank), _all([*same, within]))
    inside = Window.partitionBy(*keys, "__from").orderBy("__v")
    upto = F.col("__before") + F.sum("__times").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    placed = candidates.withColumn("__upto", upto).withColumn("__start", F.col("__upto") - F.col("__times"))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("__start") <= rank) & (rank < F.col("__upto")), F.col("__v")))

    found = placed.groupBy(*keys).agg(at(low).alias("a"), at(high).alias("b"), F.max("__rank").alias("r"))
    between = F.expr("CASE WHEN a = b THEN a ELSE (ceil(r) - r) * a + (r - floor(r)) * b END")
    names = [g if isinstance(g, str) else k for g, k in zip(groups, keys)]
    result = found.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], between.alias("quantile_value"))
    return result if named else result.agg(F.max("quantile_value").alias("quantile_value"))


def _all(conditions: list[Column]) -> Column:
    combined = conditions[0]
    for condition in conditions[1:]:
        combined = combined & condition
    return combined


def quantile_over(df: DataFrame, value: str, quantile: float, groups: Sequence[str], name: str) -> DataFrame:
    """Every row with the quantile of its group beside it."""
    per_group = exact_quantile(df, value, quantile, groups)
    renamed = per_group.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)], F.col("quantile_value").alias(name)
    )
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]
    if not same:
        return df.withColumn(name, renamed.scalar())
    return df.join(renamed, _all(same), "left").drop(*[f"__g{i}" for i in range(len(same))])
