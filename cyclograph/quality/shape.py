"""Checks on columns and row counts of a table (DQ80-DQ93)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclograph.quality.core import Check, Condition, aggregate_check, between, equal_expression

# The ways column names can be compared.
TRANSFORMS = {"upper": str.upper, "lower": str.lower, None: str}


def column_list(df: DataFrame, transform: str | None = "upper") -> list[str]:
    return [TRANSFORMS[transform](c) for c in df.columns]


def common_members(first: Sequence[str], second: Sequence[str]) -> list[str]:
    """Members of the first list that the second has, too."""
    return [m for m in first if m in set(second)]


def _frame(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def column_to_exist(column: str, column_index: int | None = None, transform: str | None = "upper") -> Check:
    """1-based position; 0 or none leaves it open."""

    def violations(df: DataFrame) -> DataFrame:
        names, wanted = column_list(df, transform), TRANSFORMS[transform](column)
        at = names.index(wanted) if wanted in names else -1
        placed = not column_index or at == max(column_index - 1, 0)
        rows = [] if at >= 0 and placed else [(wanted, at, placed)]
        return _frame(df, rows, "column_name string, matching_column_index int, column_index_matches boolean")

    return Check(f"column_exists_{column}", violations)


def table_column_count_to_be_between(min_value: int | None = None, max_value: int | None = None) -> Check:
    """A bound of 0 counts as absent."""
    if min_value is None and max_value is None:
        raise ValueError("give a minimum, a maximum or both")

    def violations(df: DataFrame) -> DataFrame:
        n = len(df.columns)
        fine = (not min_value or n >= min_value) and (not max_value or n <= max_value)
        rows = [] if fine else [(n, min_value or 0, max_value or 0)]
        return _frame(df, rows, "number_actual_columns int, min_value int, max_value int")

    return Check("column_count_between", violations)


def table_column_count_to_equal(value: int) -> Check:
    def violations(df: DataFrame) -> DataFrame:
        n = len(df.columns)
        return _frame(df, [] if n == value else [(n, value)], "number_actual_columns int, value int")

    return Check("column_count_equal", violations)


def table_column_count_to_equal_other_table(compare: DataFrame) -> Check:
    return table_column_count_to_equal(len(compare.columns)).configured(name="column_count_equal_other_table")


def table_columns_to_contain_set(columns: Sequence[str], transform: str | None = "upper") -> Check:
    def violations(df: DataFrame) -> DataFrame:
        names = column_list(df, transform)
        missing = [(c, None) for c in map(TRANSFORMS[transform], columns) if c not in names]
        return _frame(df, missing, "input_column string, relation_column string")

    return Check("columns_contain_set", violations)


def table_columns_to_not_contain_set(columns: Sequence[str], transform: str | None = "upper") -> Check:
    def violations(df: DataFrame) -> DataFrame:
        wanted = [TRANSFORMS[transform](c) for c in columns]
        found = [(c, c) for c in common_members(wanted, column_list(df, transform))]
        return _frame(df, found, "input_column string, relation_column string")

    return Check("columns_not_contain_set", violations)


def table_columns_to_match_set(columns: Sequence[str], transform: str | None = "upper") -> Check:
    def violations(df: DataFrame) -> DataFrame:
        wanted, names = [TRANSFORMS[transform](c) for c in columns], column_list(df, transform)
        rows = [(n, None) for n in names if n not in wanted] + [(None, c) for c in wanted if c not in names]
        return _frame(df, rows, "relation_column string, input_column string")

    return Check("columns_match_set", violations)


def table_columns_to_match_ordered_list(columns: Sequence[str], transform: str | None = "upper") -> Check:
    """Names and positions."""

    def violations(df: DataFrame) -> DataFrame:
        wanted = list(enumerate((TRANSFORMS[transform](c) for c in columns), start=1))
        names = list(enumerate(column_list(df, transform), start=1))
        rows = [(i, n, None, None) for i, n in names if (i, n) not in wanted]
        rows += [(None, None, i, c) for i, c in wanted if (i, c) not in names]
        return _frame(
            df, rows, "relation_column_idx int, relation_column string, input_column_idx int, input_column string"
        )

    return Check("columns_match_ordered_list", violations)


def table_row_count_to_be_between(
    min_value: int | None = None,
    max_value: int | None = None,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    strictly: bool = False,
) -> Check:
    return aggregate_check(
        "row_count_between",
        F.count,
        F.lit(1),
        lambda n: between(n, min_value, max_value, strictly),
        group_by,
        row_condition,
    )


def table_row_count_to_equal(value: int, group_by: Sequence[str] | None = None, row_condition: Condition = None) -> Check:
    return aggregate_check("row_count_equal", F.count, F.lit(1), lambda n: n == value, group_by, row_condition)


def table_row_count_to_equal_other_table(
    compare: DataFrame,
    factor: float = 1,
    group_by: Sequence[Column | str] | None = None,
    compare_group_by: Sequence[Column | str] | None = None,
    row_condition: Condition = None,
    compare_row_condition: Condition = None,
) -> Check:
    """The other table's count is multiplied by ``factor``."""
    return equal_expression(
        F.count(F.lit(1)),
        compare,
        F.count(F.lit(1)) * F.lit(factor),
        group_by=group_by,
        compare_group_by=compare_group_by,
        row_condition=row_condition,
        compare_row_condition=compare_row_condition,
        name="row_count_equal_other_table",
    )


def table_row_count_to_equal_other_table_times_factor(compare: DataFrame, factor: float, **options) -> Check:
    return table_row_count_to_equal_other_table(compare, factor, **options).configured(
        name="row_count_equal_other_table_times_factor"
    )


def table_aggregation_to_equal_other_table(
    expression: Column | str, compare: DataFrame, compare_expression: Column | str | None = None, **options
) -> Check:
    return equal_expression(
        expression, compare, compare_expression, name="aggregation_equal_other_table", **options
    )
