"""Cutting a table into ranges of a sort order, known before anything is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLED_PER_RANGE = 20
"""Sampled rows for each range; a table of fewer rows gets fewer ranges."""

_SEED = 17


def _with_cuts(df: DataFrame, sorting: Sequence[str], ranges: int | None) -> tuple[DataFrame, Column, Column]:
    """(rows with ``__cuts``, their sort key, the number of cuts up to the key).

    The cuts are rows of a random sample of at most ``SAMPLED_PER_RANGE`` rows for each range (by
    default as many ranges as shuffle partitions), found by a sub-query in one pass over the sort
    columns; a row finds its range by binary search.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(sorting)])
    sample = df.select(key.alias("k"), F.rand(_SEED).alias("r")).orderBy("r").limit(n * SAMPLED_PER_RANGE)
    together = F.col("r") < 0  # the same for all: the sample is small
    placed = sample.withColumn("i", F.row_number().over(Window.partitionBy(together).orderBy("k")))
    chosen = placed.filter(F.col("i") % SAMPLED_PER_RANGE == 0).groupBy(together).agg(F.sort_array(F.collect_set("k")).alias("cuts"))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n.bit_length()))])

    def nearer(low: Column, step: Column) -> Column:
        higher = low + step
        return F.when((higher <= F.size("__cuts")) & (F.get("__cuts", higher - 1) <= key), higher).otherwise(low)

    number = F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), nearer))
    return df.withColumn("__cuts", chosen.select("cuts").scalar()), key, number


def with_range(df: DataFrame, sorting: Sequence[str], name: str = "__range", ranges: int | None = None) -> DataFrame:
    """Add each row's range: 0, 1, 2 ... along ``sorting`` (ascending, nulls first), of similar sizes.

    Where the cuts fall varies with the data's layout. Equal rows fall into one range, so a long
    run of rows that ``sorting`` can't tell apart stays together.
    """
    rows, _, number = _with_cuts(df, sorting, ranges)
    return rows.withColumn(name, number).drop("__cuts")


def with_joined_ranges(df: DataFrame, sorting: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Rows with ``__range`` and ``__own``, in ranges that share their border rows.

    A cut is itself a row of the table: it ends one range as the range's ``__own`` row and begins
    the next one as a copy, not ``__own``. So every own row but the very first has the row before
    it in its range, and the range number can be the only key of a single shuffle.
    """
    rows, key, number = _with_cuts(df, sorting, ranges)
    numbered = rows.withColumn("__n", number)
    is_cut = (F.col("__n") > 0) & key.eqNullSafe(F.get("__cuts", F.col("__n") - 1))
    here = F.struct(F.col("__n").alias("range"), F.lit(True).alias("own"))
    both = F.array(F.struct((F.col("__n") - 1).alias("range"), F.lit(True).alias("own")), F.struct(F.col("__n").alias("range"), F.lit(False).alias("own")))
    placed = numbered.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(F.when(is_cut, both).otherwise(F.array(here))).alias("__at"))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], F.col("__at.range").alias("__range"), F.col("__at.own").alias("__own"))


def with_rows_before(df: DataFrame, sorting: Sequence[str], reach: int, ranges: int | None = None) -> DataFrame:
    """Rows with ``__range`` and ``__own``: each range also holds copies, not ``__own``, of the
    ``reach`` rows before it, so that frames reaching back that far see what they would see in the
    whole order. ``sorting`` tells all rows apart.

    Only the last ``reach`` rows of each range can be among the rows before another one. These are
    few; numbered along the order, each range takes those just below its own first number.
    """
    placed = with_range(df, sorting, ranges=ranges)
    columns = [F.col(f"`{c}`") for c in df.columns]
    order = [F.col(f"`{c}`") for c in sorting]
    # Null keys sort first going up, so last going down.
    inside = Window.partitionBy("__range").orderBy(*[c.desc_nulls_last() for c in order])
    last = placed.withColumn("__back", F.row_number().over(inside)).filter(F.col("__back") <= reach)
    few = Window.partitionBy(F.col("__back") < 0).orderBy(*[c.asc_nulls_first() for c in order])
    numbered = last.withColumn("__number", F.row_number().over(few))
    # The first of a range's numbers: the rows before it are those of the reach numbers below.
    firsts = numbered.groupBy("__range").agg(F.min("__number").alias("__first")).filter("__first > 1")
    below = F.sequence(F.greatest(F.lit(1), F.col("__first") - reach), F.col("__first") - 1)
    wanted = firsts.select(F.col("__range").alias("__to"), F.explode(below).alias("__number"))
    copies = numbered.join(wanted, "__number").select(*columns, F.col("__to").alias("__range"), F.lit(False).alias("__own"))
    return placed.select(*columns, "__range", F.lit(True).alias("__own")).unionAll(copies)
