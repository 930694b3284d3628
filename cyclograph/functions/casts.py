"""Guarded casts (PRJ1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted target names and the Spark type each one stands for.
TARGET_TYPES = {
    "int": "bigint",
    "bigint": "bigint",
    "timestamp": "timestamp",
    "date": "date",
    "double": "double",
    "double precision": "double",
    "varchar": "string",
    "text": "string",
    "boolean": "boolean",
    "bool": "boolean",
}


def as_column(value: Column | str) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def as_expression(value: Column | str) -> Column:
    """Strings are SQL fragments, the extension point of the data checks."""
    return value if isinstance(value, Column) else F.expr(value)


def guarded_cast(value: Column | str, target: str, strict: bool = False) -> Column:
    """Cast to ``target``. Bad input becomes NULL, or raises when ``strict``."""
    spark_type = TARGET_TYPES.get(target.lower(), target)
    column = as_column(value)
    return column.cast(spark_type) if strict else column.try_cast(spark_type)
