"""Numeric helpers (SF16, SF17, SF22) and guarded statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_column


def safe_log(value: Column | str) -> Column:
    """Natural logarithm; 0 for zero, NULL or negative input."""
    column = as_column(value)
    return F.coalesce(F.ln(F.nullif(column, F.lit(0))), F.lit(0.0))


def uniform_random(seed: int) -> Column:
    return F.rand(seed)


def remainder(dividend: Column | str, divisor: int) -> Column:
    """Sign follows the dividend."""
    return as_column(dividend) % F.lit(divisor)


def pearson(x: Column | str, y: Column | str) -> Column:
    """Correlation from mergeable moments; NULL when either side does not vary.

    The built-in ``corr`` divides by zero under ANSI mode in that case. Rows with a
    NULL on either side are left out of every moment.
    """
    x, y = as_column(x).cast("double"), as_column(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
