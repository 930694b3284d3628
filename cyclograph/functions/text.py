"""String helpers: concatenation, splitting, patterns (SF1-SF3, SF18-SF21)."""

from __future__ import annotations

import warnings

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_column

# The flags of the regex dialect checks are written in.
REGEX_FLAGS = "imsU-"


def normalized(value: Column | str) -> Column:
    """Upper case without surrounding blanks."""
    return F.upper(F.trim(as_column(value)))


def composite_key(*parts: Column | str, separator: str = "|") -> Column:
    """Parts joined by a separator; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(as_column(part))
    return F.concat(*pieces)


def key_part(value: Column | str, position: int, separator: str = "|") -> Column:
    """1-based part of a composite key."""
    return F.split_part(as_column(value), F.lit(separator), F.lit(position))


def regex_with_flags(pattern: str, flags: str = "") -> str:
    """Inline the flags. Unknown flags warn; ungreedy mode has no Java equivalent and raises."""
    if not flags:
        return pattern
    unknown = sorted(set(flags) - set(REGEX_FLAGS))
    if unknown:
        warnings.warn(f"unsupported regex flags: {''.join(unknown)}", stacklevel=2)
    switched_on, _, _ = flags.partition("-")
    if "U" in switched_on:
        raise ValueError("regex flag U (ungreedy) is not available: Java gives (?U) another meaning")
    kept = "".join(f for f in flags if f in REGEX_FLAGS and f != "U").rstrip("-")
    return f"(?{kept}){pattern}" if kept else pattern


def regex_position(
    value: Column | str,
    pattern: str,
    position: int = 1,
    occurrence: int = 1,
    is_raw: bool = False,
    flags: str = "",
) -> Column:
    """1-based position of the n-th match at or after ``position``; 0 when there is none.

    ``is_raw`` is accepted for call compatibility: Python patterns need no SQL escaping.
    """
    del is_raw
    column, regex = as_column(value), regex_with_flags(pattern, flags)
    if position == 1 and occurrence == 1:
        return F.regexp_instr(column, F.lit(regex))
    text = F.substr(column, F.lit(position))
    matches = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    between = F.split(text, regex, -1)
    before = _total_length(between, occurrence) + _total_length(matches, occurrence - 1)
    return F.when(F.size(matches) >= occurrence, before + position).when(column.isNotNull(), F.lit(0))


def _total_length(pieces: Column, count: int) -> Column:
    return F.aggregate(F.slice(pieces, 1, count), F.lit(0), lambda total, piece: total + F.char_length(piece))


def matches_regex(value: Column | str, pattern: str, is_raw: bool = False, flags: str = "") -> Column:
    return regex_position(value, pattern, is_raw=is_raw, flags=flags) > 0


def matches_like(value: Column | str, pattern: str) -> Column:
    return as_column(value).like(pattern)


def digest(value: Column | str) -> Column:
    return F.md5(as_column(value).cast("string"))
