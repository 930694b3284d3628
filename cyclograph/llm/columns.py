"""Column names of tables whose other columns aren't known: nothing clashes, nothing is lost."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, new: Iterable[str]) -> list[Column]:
    """All columns but those that a new column replaces; names differ by more than case."""
    taken = {n.lower() for n in new}
    return [named(c) for c in df.columns if c.lower() not in taken]


def free_prefix(df: DataFrame) -> str:
    """Underscores with which no column begins."""
    prefix = "__"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def sort_key(df: DataFrame, name: str) -> Column:
    """The column, or its JSON where its type has no order."""
    kind = df.schema[name].dataType.simpleString()
    return F.to_json(F.struct(named(name))) if "map<" in kind or "variant" in kind else named(name)


def free_name(df: DataFrame, stem: str) -> str:
    """A name like ``stem`` that no column has, whatever its case."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name
