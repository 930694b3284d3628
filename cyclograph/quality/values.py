"""Checks on the values of one column (DQ30-DQ40, DQ95-DQ98)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_expression
from cyclograph.operators.ordered import PREVIOUS, breaks_in_order
from cyclograph.quality.aggregates import distinct_values_to_be_in_set
from cyclograph.quality.core import Check, Condition, bad_row_check, between, row_check, where
from cyclograph.quality.multicolumn import compound_columns_to_be_unique


def values_to_be_between(
    column, min_value=None, max_value=None, row_condition: Condition = None, strictly: bool = False
) -> Check:
    return row_check(
        f"values_between_{column}", between(as_expression(column), min_value, max_value, strictly), row_condition
    )


def _ordered_check(name, column, sort_column, strictly, step, group_by, row_condition, tiebreak, rising) -> Check:
    keys = list(group_by or [])
    order = [sort_column or column, *([tiebreak] if isinstance(tiebreak, str) else tiebreak or [])]
    names = list(dict.fromkeys([*keys, *order, column]))
    inner = {n: f"__c{i}" for i, n in enumerate(names)}
    value, before = F.col(inner[column]), F.col(PREVIOUS)
    if rising:
        fine, difference = (value > before if strictly else value >= before), value - before
    else:
        fine, difference = (value < before if strictly else value <= before), before - value
    if step is not None:
        fine = fine & (difference == F.lit(step))
    # A NULL value next to a known predecessor makes ``fine`` NULL, and that passes.
    broken = before.isNotNull() & ~fine

    def violations(df: DataFrame) -> DataFrame:
        rows = where(df, row_condition).select(*[as_expression(n).alias(c) for n, c in inner.items()])
        # Ending in the value makes the order total, as far as these columns go.
        sorting = list(dict.fromkeys([*[inner[o] for o in order], inner[column]]))
        bad = breaks_in_order(rows, inner[column], sorting, [inner[k] for k in keys], broken)
        return bad.withColumnsRenamed({c: n for n, c in inner.items()})

    return Check(name, violations)


def values_to_be_increasing(
    column,
    sort_column=None,
    strictly: bool = True,
    step=None,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    tiebreak: str | Sequence[str] | None = None,
) -> Check:
    """Each value against the one before it in sort order; the first value passes.

    Rows with equal sort values stand in the order of ``tiebreak``, then of the value itself.
    Columns and groups are SQL fragments.
    """
    return _ordered_check(
        f"values_increasing_{column}", column, sort_column, strictly, step, group_by, row_condition, tiebreak, True
    )


def values_to_be_decreasing(
    column,
    sort_column=None,
    strictly: bool = True,
    step=None,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    tiebreak: str | Sequence[str] | None = None,
) -> Check:
    return _ordered_check(
        f"values_decreasing_{column}", column, sort_column, strictly, step, group_by, row_condition, tiebreak, False
    )


def values_to_be_in_set(column, values: Sequence, row_condition: Condition = None) -> Check:
    """NULL is outside every set."""
    outside = ~F.coalesce(as_expression(column).isin(list(values)), F.lit(False))
    return bad_row_check(f"values_in_set_{column}", outside, row_condition)


def values_to_not_be_in_set(column, values: Sequence, row_condition: Condition = None) -> Check:
    """One violation per row, however often the set repeats the value; NULL passes."""
    return bad_row_check(f"values_not_in_set_{column}", as_expression(column).isin(list(values)), row_condition)


def values_to_be_in_type_list(column: str, types: Sequence[str]) -> Check:
    """Spark type names, in any case; a column that does not exist passes."""
    allowed = [t.upper() for t in types]

    def violations(df: DataFrame) -> DataFrame:
        bad = [
            (f.name.upper(), f.dataType.simpleString().upper())
            for f in df.schema.fields
            if f.name.upper() == column.upper() and f.dataType.simpleString().upper() not in allowed
        ]
        return df.sparkSession.createDataFrame(bad, "relation_column string, relation_column_type string")

    return Check(f"values_in_type_list_{column}", violations)


def values_to_be_of_type(column: str, column_type: str) -> Check:
    return values_to_be_in_type_list(column, [column_type]).configured(name=f"values_of_type_{column}")


def values_to_be_null(column, row_condition: Condition = None) -> Check:
    return row_check(f"values_null_{column}", as_expression(column).isNull(), row_condition)


def values_to_not_be_null(column, row_condition: Condition = None) -> Check:
    return row_check(f"values_not_null_{column}", as_expression(column).isNotNull(), row_condition)


def values_to_be_unique(column: str, row_condition: Condition = None) -> Check:
    """NULLs are ignored."""
    return compound_columns_to_be_unique([column], row_condition=row_condition).configured(
        name=f"values_unique_{column}"
    )


def values_to_have_consistent_casing(column, display_inconsistent_columns: bool = False) -> Check:
    """Values that differ only in case. The summary form also fails on a NULL value."""

    def violations(df: DataFrame) -> DataFrame:
        distinct = df.select(as_expression(column).alias("v")).distinct()
        if display_inconsistent_columns:
            return (
                distinct.groupBy(F.lower("v").alias("inconsistent_columns"))
                .agg(F.count("v").alias("set_count_case_insensitive"))
                .filter("set_count_case_insensitive > 1")
            )
        # Grouping by the lowered value first avoids a second distinct over all values.
        per_value = distinct.groupBy(F.lower("v").alias("lowered")).agg(F.count(F.lit(1)).alias("n"))
        return per_value.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("set_count"),
            F.count("lowered").alias("set_count_case_insensitive"),
        ).filter("set_count <> set_count_case_insensitive")

    return Check(f"values_consistent_casing_{column}", violations)


# --- plain table tests -------------------------------------------------------------


def unique(column: str, row_condition: Condition = None) -> Check:
    return values_to_be_unique(column, row_condition).configured(name=f"unique_{column}")


def not_null(column: str, row_condition: Condition = None) -> Check:
    return values_to_not_be_null(column, row_condition).configured(name=f"not_null_{column}")


def accepted_values(column: str, values: Sequence, row_condition: Condition = None) -> Check:
    return distinct_values_to_be_in_set(column, values, row_condition).configured(name=f"accepted_values_{column}")


def relationships(column: str, to: DataFrame, field: str, row_condition: Condition = None) -> Check:
    """Child values without a parent, with the number of records that carry each.

    Children are counted per value before the join, so a frequent key is one row there.
    """

    def violations(df: DataFrame) -> DataFrame:
        children = (
            where(df, row_condition)
            .filter(as_expression(column).isNotNull())
            .groupBy(as_expression(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
        )
        return children.join(to.select(F.col(field).alias("value_field")), "value_field", "left_anti")

    return Check(f"relationships_{column}", violations, weight=F.col("n_records"))
