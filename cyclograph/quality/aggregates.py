"""Checks on one figure per table or group (DQ10-DQ26)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_expression
from cyclograph.operators.quantiles import exact_quantile
from cyclograph.quality.core import (
    Check,
    Condition,
    aggregate_check,
    between,
    equal_expression,
    is_violation,
    where,
)


def _range_check(name, aggregate, column, min_value, max_value, group_by, row_condition, strictly, fusible=True):
    return aggregate_check(
        name,
        aggregate,
        as_expression(column),
        lambda figure: between(figure, min_value, max_value, strictly),
        group_by,
        row_condition,
        fusible,
    )


def _distinct_check(name, column, accept, group_by, row_condition):
    # Distinct counts get their own job: sharing a pass would multiply every row.
    return aggregate_check(name, F.count_distinct, as_expression(column), accept, group_by, row_condition, fusible=False)


def distinct_count_to_be_greater_than(column, value, group_by=None, row_condition: Condition = None) -> Check:
    return _distinct_check(
        f"distinct_count_greater_than_{column}", column, lambda n: n > value, group_by, row_condition
    )


def distinct_count_to_be_less_than(column, value, group_by=None, row_condition: Condition = None) -> Check:
    return _distinct_check(f"distinct_count_less_than_{column}", column, lambda n: n < value, group_by, row_condition)


def distinct_count_to_equal(column, value, group_by=None, row_condition: Condition = None) -> Check:
    return _distinct_check(f"distinct_count_equal_{column}", column, lambda n: n == value, group_by, row_condition)


def distinct_count_to_equal_other_table(
    column,
    compare: DataFrame | None = None,
    compare_column=None,
    row_condition: Condition = None,
    compare_row_condition: Condition = None,
) -> Check:
    return equal_expression(
        F.count_distinct(as_expression(column)),
        compare,
        F.count_distinct(as_expression(compare_column or column)),
        row_condition=row_condition,
        compare_row_condition=compare_row_condition,
        name=f"distinct_count_equal_other_table_{column}",
    )


def _members(df: DataFrame, values: Sequence) -> DataFrame:
    literals = F.array(*[F.lit(v) for v in values])
    return df.sparkSession.range(1).select(F.explode(literals).alias("value_field")).distinct()


def distinct_values_to_be_in_set(column, values: Sequence, row_condition: Condition = None) -> Check:
    """Distinct values outside the set; NULL is one of them."""

    def violations(df: DataFrame) -> DataFrame:
        value = as_expression(column)
        outside = ~F.coalesce(value.isin(list(values)), F.lit(False))
        return where(df, row_condition).filter(outside).select(value.alias("value_field")).distinct()

    return Check(f"distinct_values_in_set_{column}", violations)


def distinct_values_to_contain_set(column, values: Sequence, row_condition: Condition = None) -> Check:
    """Members of the set that never occur."""

    def violations(df: DataFrame) -> DataFrame:
        value = as_expression(column)
        seen = where(df, row_condition).filter(value.isin(list(values))).select(value.alias("value_field")).distinct()
        return _members(df, values).join(seen, "value_field", "left_anti")

    return Check(f"distinct_values_contain_set_{column}", violations)


def distinct_values_to_equal_set(column, values: Sequence, row_condition: Condition = None) -> Check:
    """Values outside the set and members that never occur, side by side."""

    def violations(df: DataFrame) -> DataFrame:
        seen = where(df, row_condition).select(as_expression(column).alias("column_value")).distinct()
        both = seen.join(_members(df, values), F.col("column_value") == F.col("value_field"), "full")
        return both.filter("column_value IS NULL OR value_field IS NULL")

    return Check(f"distinct_values_equal_set_{column}", violations)


def column_max_to_be_between(
    column, min_value=None, max_value=None, group_by=None, row_condition: Condition = None, strictly=False
) -> Check:
    return _range_check(f"max_between_{column}", F.max, column, min_value, max_value, group_by, row_condition, strictly)


def column_min_to_be_between(
    column, min_value=None, max_value=None, group_by=None, row_condition: Condition = None, strictly=False
) -> Check:
    return _range_check(f"min_between_{column}", F.min, column, min_value, max_value, group_by, row_condition, strictly)


def column_mean_to_be_between(
    column, min_value=None, max_value=None, group_by=None, row_condition: Condition = None, strictly=False
) -> Check:
    return _range_check(f"mean_between_{column}", F.avg, column, min_value, max_value, group_by, row_condition, strictly)


def column_stdev_to_be_between(
    column, min_value=None, max_value=None, group_by=None, row_condition: Condition = None, strictly=False
) -> Check:
    """Sample standard deviation; NULL, and thus passing, for a single value."""
    return _range_check(
        f"stdev_between_{column}", F.stddev_samp, column, min_value, max_value, group_by, row_condition, strictly
    )


def column_sum_to_be_between(
    column, min_value=None, max_value=None, group_by=None, row_condition: Condition = None, strictly=False
) -> Check:
    return _range_check(f"sum_between_{column}", F.sum, column, min_value, max_value, group_by, row_condition, strictly)


def column_unique_value_count_to_be_between(
    column, min_value=None, max_value=None, group_by=None, row_condition: Condition = None, strictly=False
) -> Check:
    return _range_check(
        f"unique_value_count_between_{column}",
        F.count_distinct,
        column,
        min_value,
        max_value,
        group_by,
        row_condition,
        strictly,
        fusible=False,
    )


def column_proportion_of_unique_values_to_be_between(
    column, min_value=None, max_value=None, group_by=None, row_condition: Condition = None, strictly=False
) -> Check:
    """Distinct over non-NULL values; 1 when there are none."""

    def proportion(value):
        present = F.count(value)
        return F.when(present == 0, F.lit(1.0)).otherwise(
            F.count_distinct(value).cast("double") / F.nullif(present, F.lit(0))
        )

    return _range_check(
        f"proportion_of_unique_values_between_{column}",
        proportion,
        column,
        min_value,
        max_value,
        group_by,
        row_condition,
        strictly,
        fusible=False,
    )


def column_quantile_values_to_be_between(
    column,
    quantile: float,
    min_value=None,
    max_value=None,
    group_by=None,
    row_condition: Condition = None,
    strictly=False,
    approximate: bool = False,
) -> Check:
    """Exact quantile with linear interpolation; ``approximate`` settles for a sketch."""
    inside = between(F.col("expression"), min_value, max_value, strictly)
    keys = list(group_by or [])

    def violations(df: DataFrame) -> DataFrame:
        scoped = where(df, row_condition)
        if approximate:
            figures = scoped.groupBy(*map(as_expression, keys)).agg(
                F.percentile_approx(as_expression(column), F.lit(float(quantile)), F.lit(10_000)).alias("expression")
            )
        else:
            figures = exact_quantile(scoped, as_expression(column), quantile, [as_expression(k) for k in keys])
            figures = figures.withColumnsRenamed({"quantile_value": "expression"} | {f"__g{i}": k for i, k in enumerate(keys)})
        return figures.filter(is_violation(inside))

    return Check(f"quantile_between_{column}", violations)


def column_median_to_be_between(
    column, min_value=None, max_value=None, group_by=None, row_condition: Condition = None, strictly=False
) -> Check:
    check = column_quantile_values_to_be_between(
        column, 0.5, min_value, max_value, group_by, row_condition, strictly
    )
    return check.configured(name=f"median_between_{column}")


def column_most_common_value_to_be_in_set(
    column, values: Sequence, top_n: int, data_type: str | None = None, row_condition: Condition = None
) -> Check:
    """The value ranked exactly ``top_n`` by frequency (ties by value) must be in the set; NULL passes."""

    def violations(df: DataFrame) -> DataFrame:
        value = as_expression(column) if data_type is None else as_expression(column).cast(data_type)
        counts = where(df, row_condition).groupBy(value.alias("value_field")).agg(F.count(F.lit(1)).alias("n"))
        order = [F.col("n").desc(), F.col("value_field").asc_nulls_last()]
        # Only the leading rows reach the window.
        leading = counts.orderBy(*order).limit(top_n)
        ranked = leading.withColumn("rank", F.row_number().over(Window.orderBy(*order)))
        return ranked.filter((F.col("rank") == top_n) & ~F.col("value_field").isin(list(values))).select("value_field")

    return Check(f"most_common_value_in_set_{column}", violations)
