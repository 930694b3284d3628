"""Previous value in a global or per-group order, without a single-task window (WN4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclograph.operators.ranges import with_joined_ranges

PREVIOUS = "value_field_lag"


def breaks_in_order(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    groups: Sequence[str],
    broken: Column,
) -> DataFrame:
    """Rows for which ``broken`` (over ``value`` and PREVIOUS) holds against the row before.

    A plain window would pull one group - the whole table if there are none - into one
    task. Instead the rows are cut into ranges of (groups, order) that share their border rows,
    and the range number is the key of the only shuffle: a frequent group or sort value is spread
    over many ranges as long as ``order`` ends in a distinct column. ``lag`` runs inside each
    range, where every row that is judged there has its predecessor.
    """
    sorting = [*groups, *order]
    inside = Window.partitionBy("__range").orderBy(*sorting, F.col("__own"))
    # Carry the whole previous row: a NULL value there must stay NULL.
    current = F.struct(F.col(value).alias("v"), *[F.col(g).alias(f"g{i}") for i, g in enumerate(groups)])
    same_group = F.lit(True)
    for i, group in enumerate(groups):
        same_group = same_group & F.col(group).eqNullSafe(F.col(f"__before.g{i}"))
    return (
        with_joined_ranges(df, sorting)
        .withColumn("__before", F.lag(current).over(inside))
        .filter("__own")
        .withColumn(PREVIOUS, F.when(same_group, F.col("__before.v")))
        .filter(broken)
        .select(*df.columns, PREVIOUS)
    )
