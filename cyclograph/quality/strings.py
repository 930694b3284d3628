"""Checks on text (DQ60-DQ69). NULL text passes all of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_expression
from cyclograph.functions.text import matches_like, matches_regex
from cyclograph.quality.core import Check, Condition, between, row_check


def _combined(tests: Sequence[Column], match_on: str) -> Column:
    if match_on not in ("any", "all"):
        raise ValueError(f"match_on must be 'any' or 'all', got {match_on!r}")
    combined = tests[0]
    for test in tests[1:]:
        combined = combined & test if match_on == "all" else combined | test
    return combined


def _pattern_check(name: str, column, patterns, test: Callable[[str], Column], match_on, positive, row_condition) -> Check:
    tests = [test(p) if positive else ~test(p) for p in patterns]
    return row_check(f"{name}_{column}", _combined(tests, match_on), row_condition)


def value_lengths_to_be_between(
    column, min_value=None, max_value=None, row_condition: Condition = None, strictly: bool = False
) -> Check:
    length = F.char_length(as_expression(column))
    return row_check(f"value_lengths_between_{column}", between(length, min_value, max_value, strictly), row_condition)


def value_lengths_to_equal(column, value: int, row_condition: Condition = None) -> Check:
    return row_check(f"value_lengths_equal_{column}", F.char_length(as_expression(column)) == value, row_condition)


def match_like_pattern(column, pattern: str, row_condition: Condition = None) -> Check:
    return match_like_pattern_list(column, [pattern], "all", row_condition)


def match_like_pattern_list(column, patterns: Sequence[str], match_on: str = "any", row_condition: Condition = None) -> Check:
    return _pattern_check(
        "match_like", column, patterns, lambda p: matches_like(column, p), match_on, True, row_condition
    )


def not_match_like_pattern(column, pattern: str, row_condition: Condition = None) -> Check:
    return not_match_like_pattern_list(column, [pattern], "all", row_condition)


def not_match_like_pattern_list(
    column, patterns: Sequence[str], match_on: str = "any", row_condition: Condition = None
) -> Check:
    """``any``: one pattern that does not match is enough to pass."""
    return _pattern_check(
        "not_match_like", column, patterns, lambda p: matches_like(column, p), match_on, False, row_condition
    )


def match_regex(column, regex: str, row_condition: Condition = None, is_raw: bool = False, flags: str = "") -> Check:
    return match_regex_list(column, [regex], "all", row_condition, is_raw, flags)


def match_regex_list(
    column, regexes: Sequence[str], match_on: str = "any", row_condition: Condition = None, is_raw: bool = False, flags: str = ""
) -> Check:
    test = lambda p: matches_regex(column, p, is_raw, flags)
    return _pattern_check("match_regex", column, regexes, test, match_on, True, row_condition)


def not_match_regex(column, regex: str, row_condition: Condition = None, is_raw: bool = False, flags: str = "") -> Check:
    return not_match_regex_list(column, [regex], "all", row_condition, is_raw, flags)


def not_match_regex_list(
    column, regexes: Sequence[str], match_on: str = "any", row_condition: Condition = None, is_raw: bool = False, flags: str = ""
) -> Check:
    """``any``: one pattern that does not match is enough to pass."""
    test = lambda p: matches_regex(column, p, is_raw, flags)
    return _pattern_check("not_match_regex", column, regexes, test, match_on, False, row_condition)
