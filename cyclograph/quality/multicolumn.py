"""Checks that relate several columns (DQ50-DQ55)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_expression
from cyclograph.quality.core import (
    Check,
    Condition,
    aggregate_check,
    bad_row_check,
    is_violation,
    present,
    row_check,
    where,
)


def pair_values_A_to_be_greater_than_B(column_a, column_b, or_equal: bool = False, row_condition: Condition = None) -> Check:
    a, b = as_expression(column_a), as_expression(column_b)
    return row_check(f"pair_greater_{column_a}_{column_b}", a >= b if or_equal else a > b, row_condition)


def pair_values_to_be_equal(column_a, column_b, row_condition: Condition = None) -> Check:
    return row_check(f"pair_equal_{column_a}_{column_b}", as_expression(column_a) == as_expression(column_b), row_condition)


def pair_values_to_be_in_set(column_a, column_b, pairs: Sequence[Sequence], row_condition: Condition = None) -> Check:
    """Plain boolean logic: a NULL next to a value no pair has fails, otherwise it passes."""
    allowed = F.lit(False)
    for pair in pairs:
        if len(pair) != 2:
            raise ValueError(f"expected pairs of two values, got {pair!r}")
        allowed = allowed | ((as_expression(column_a) == F.lit(pair[0])) & (as_expression(column_b) == F.lit(pair[1])))
    return row_check(f"pair_in_set_{column_a}_{column_b}", allowed, row_condition)


def compound_columns_to_be_unique(
    columns: Sequence[str], ignore_row_if: str = "all_values_are_missing", row_condition: Condition = None
) -> Check:
    """Repeated keys with their number of records. Rows that are not ignored compare NULL as equal."""
    if not columns:
        raise ValueError("give at least one column")
    considered = present(columns, ignore_row_if)

    def violations(df: DataFrame) -> DataFrame:
        rows = where(df, row_condition).filter(considered)
        return rows.groupBy(*map(as_expression, columns)).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")

    return Check(f"compound_unique_{'_'.join(columns)}", violations)


def multicolumn_sum_to_equal(
    columns: Sequence[str],
    sum_total: Column | str | int | float,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    tolerance: float | None = None,
) -> Check:
    """Sum of the columns' sums against a number, or against the sum of another column.

    Exact, unless a tolerance is given.
    """
    fixed = isinstance(sum_total, (int, float))
    keys = list(group_by or [])

    def compare(df: DataFrame) -> DataFrame:
        total = F.sum(as_expression(columns[0]))
        for column in columns[1:]:
            total = total + F.sum(as_expression(column))
        target = F.lit(sum_total) if fixed else F.sum(as_expression(sum_total))
        same = total == target if tolerance is None else F.abs(total - target) <= tolerance
        return where(df, row_condition).groupBy(*map(as_expression, keys)).agg(same.alias("expression"))

    return Check(
        f"multicolumn_sum_{'_'.join(columns)}", lambda df: compare(df).filter(is_violation(F.col("expression")))
    )


def select_column_values_to_be_unique_within_record(
    columns: Sequence[str], ignore_row_if: str = "all_values_are_missing", row_condition: Condition = None
) -> Check:
    """Fewer different non-NULL values than columns, so a partly NULL record fails by default."""
    texts = F.array(*[as_expression(c).cast("string") for c in columns])
    different = F.size(F.array_distinct(F.array_compact(texts)))
    bad = present(columns, ignore_row_if) & (different < len(columns))
    return bad_row_check(f"unique_within_record_{'_'.join(columns)}", bad, row_condition)
