"""Check objects and the generic checks everything else is built from (DQ1-DQ5)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_expression

Condition = Column | str | None


@dataclass(frozen=True)
class Check:
    """``violations(df)`` yields bad rows. ``counter``, where present, is an aggregate
    expression for their number, which lets a suite share one scan between checks."""

    name: str
    violations: Callable[[DataFrame], DataFrame]
    counter: Column | None = None
    weight: Column = field(default_factory=lambda: F.lit(1))  # records one violation stands for
    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.violations(df)

    def configured(self, **options) -> Check:
        """Copy with another name, severity or thresholds such as ``error_if='> 10'``."""
        return replace(self, **options)

    def status(self, failures: Column) -> Column:
        """pass, warn or fail. The thresholds are compared as SQL on the failure count."""
        over = lambda rule: F.expr(f"`failures` {rule}")
        verdict = F.when(over(self.warn_if), "warn").otherwise("pass")
        if self.severity == "error":
            verdict = F.when(over(self.error_if), "fail").otherwise(verdict)
        return verdict

    def failures(self, df: DataFrame) -> DataFrame:
        """One row with the number of bad records."""
        return self.violations(df).agg(F.coalesce(F.sum(self.weight), F.lit(0)).cast("bigint").alias("failures"))


def where(df: DataFrame, row_condition: Condition) -> DataFrame:
    return df if row_condition is None else df.filter(as_expression(row_condition))


def within(row_condition: Condition) -> Column:
    return F.lit(True) if row_condition is None else as_expression(row_condition)


def is_violation(expression: Column) -> Column:
    """Only a definite FALSE counts; NULL passes."""
    return F.coalesce(~expression, F.lit(False))


def row_check(name: str, expression: Column, row_condition: Condition = None) -> Check:
    """Bad rows are those for which ``expression`` is false."""
    bad = is_violation(expression) & F.coalesce(within(row_condition), F.lit(False))
    return Check(name, lambda df: df.filter(bad), F.count_if(bad))


def bad_row_check(name: str, bad: Column, row_condition: Condition = None) -> Check:
    """Bad rows are those for which ``bad`` is true (used where NULL must fail)."""
    bad = F.coalesce(bad, F.lit(False)) & F.coalesce(within(row_condition), F.lit(False))
    return Check(name, lambda df: df.filter(bad), F.count_if(bad))


def between(value: Column, low, high, strictly: bool = False) -> Column:
    """Inclusive unless ``strictly``; either bound may be absent, but not both."""
    if low is None and high is None:
        raise ValueError("give a minimum, a maximum or both")
    bounded = F.lit(True)
    if low is not None:
        low = low if isinstance(low, Column) else F.lit(low)
        bounded = bounded & (value > low if strictly else value >= low)
    if high is not None:
        high = high if isinstance(high, Column) else F.lit(high)
        bounded = bounded & (value < high if strictly else value <= high)
    return bounded


def aggregate_check(
    name: str,
    aggregate: Callable[[Column], Column],
    value: Column,
    accept: Callable[[Column], Column],
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    fusible: bool = True,
) -> Check:
    """``aggregate(value)`` over the table or per group must satisfy ``accept``.

    Violations show the group and the offending figure as ``expression``.
    """
    keys = list(group_by or [])

    def violations(df: DataFrame) -> DataFrame:
        figures = where(df, row_condition).groupBy(*map(as_expression, keys)).agg(aggregate(value).alias("expression"))
        return figures.filter(is_violation(accept(F.col("expression"))))

    counter = None
    if fusible and not keys:
        scoped = value if row_condition is None else F.when(within(row_condition), value)
        counter = F.when(is_violation(accept(aggregate(scoped))), 1).otherwise(0)
    return Check(name, violations, counter)


def expression_is_true(
    expression: Column | str,
    test_condition: str = "= true",
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    name: str = "expression_is_true",
) -> Check:
    """Free-form check: a row expression, or an aggregate, optionally per group."""
    keys = list(group_by or [])

    def violations(df: DataFrame) -> DataFrame:
        scoped = where(df, row_condition)
        tested = truth_expression(expression)
        shown = scoped.groupBy(*map(as_expression, keys)).agg(tested) if keys else scoped.select(tested)
        return shown.filter(f"NOT (expression {test_condition})")

    return Check(name, violations)


def truth_expression(expression: Column | str) -> Column:
    return as_expression(expression).alias("expression")


def expression_between(
    expression: Column | str,
    min_value=None,
    max_value=None,
    group_by: Sequence[str] | None = None,
    row_condition: Condition = None,
    strictly: bool = False,
    name: str = "expression_between",
) -> Check:
    inside = between(as_expression(expression), min_value, max_value, strictly)
    return expression_is_true(inside, group_by=group_by, row_condition=row_condition, name=name)


def equal_expression(
    expression: Column | str,
    compare: DataFrame | None = None,
    compare_expression: Column | str | None = None,
    group_by: Sequence[Column | str] | None = None,
    compare_group_by: Sequence[Column | str] | None = None,
    row_condition: Condition = None,
    compare_row_condition: Condition = None,
    tolerance: float = 0.0,
    tolerance_percent: float | None = None,
    name: str = "equal_expression",
) -> Check:
    """The same aggregate on two tables, per group if asked for.

    A missing side counts as 0. A relative tolerance refers to the left value and passes
    when that is 0 or missing. NULL groups never match each other.
    """
    other_expression = expression if compare_expression is None else compare_expression
    other_condition = row_condition if compare_row_condition is None else compare_row_condition
    keys = list(group_by or [])
    other_keys = list(compare_group_by or keys)

    def aggregated(df, figure, condition, columns, label):
        named = [as_expression(c).alias(f"col_{i}") for i, c in enumerate(columns, start=1)]
        return where(df, condition).groupBy(*named).agg(as_expression(figure).alias(label))

    def violations(df: DataFrame) -> DataFrame:
        left = aggregated(df, expression, row_condition, keys, "expression")
        right = aggregated(
            df if compare is None else compare, other_expression, other_condition, other_keys, "compare_expression"
        )
        shared = [f"col_{i}" for i in range(1, len(keys) + 1)]
        # Without keys both sides are a single row.
        both = left.join(right, shared, "full") if shared else left.withColumn("compare_expression", right.scalar())
        gap = F.abs(F.coalesce("expression", F.lit(0)) - F.coalesce("compare_expression", F.lit(0)))
        measured = both.select(*shared, "expression", "compare_expression", gap.alias("expression_difference")).withColumn(
            "expression_difference_percent",
            F.col("expression_difference") / F.nullif(F.col("expression") * F.lit(1.0), F.lit(0.0)),
        )
        if tolerance_percent:
            return measured.filter(F.col("expression_difference_percent") > tolerance_percent)
        return measured.filter(F.col("expression_difference") > tolerance)

    return Check(name, violations)


def present(columns: Sequence[str], ignore_row_if: str) -> Column:
    """Rows to look at: skip those with all, or any, of the columns missing."""
    missing = [as_expression(c).isNull() for c in columns]
    skip = missing[0]
    for other in missing[1:]:
        if ignore_row_if == "all_values_are_missing":
            skip = skip & other
        else:
            skip = skip | other
    if ignore_row_if not in ("all_values_are_missing", "any_value_is_missing"):
        raise ValueError(f"unknown ignore_row_if: {ignore_row_if!r}")
    return ~skip
