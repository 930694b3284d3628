"""Calendar expressions (CAL1-CAL29, CAL36).

Anything relative to "now" takes ``as_of``; it defaults to the current timestamp.
Weeks named ``iso_*`` start on Monday, the others on Sunday.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclograph.functions.casts import as_column

DEFAULT_ZONE = "UTC"

# Languages for localised day and month names.
LANGUAGES = ("en", "nl", "de", "fr", "es", "it", "pt", "pl", "da", "sv", "tr", "cs", "fi")

# Seconds per unit of fixed length.
SECONDS_PER = {"second": 1, "minute": 60, "hour": 3600}


# --- literals and time zones -------------------------------------------------------


def date_literal(year: int, month: int, day: int) -> Column:
    return F.make_date(F.lit(year), F.lit(month), F.lit(day))


def datetime_literal(
    year: int, month: int, day: int, hour: int = 0, minute: int = 0, second: int = 0, zone: str | None = None
) -> Column:
    parts = [F.lit(v) for v in (year, month, day, hour, minute, second)]
    return F.make_timestamp(*parts, F.lit(zone)) if zone else F.make_timestamp_ntz(*parts)


def convert_timezone(value: Column | str, target: str = DEFAULT_ZONE, source: str = "UTC") -> Column:
    """Wall-clock time in ``target`` of a wall-clock time in ``source``."""
    return F.convert_timezone(F.lit(source), F.lit(target), as_column(value).cast("timestamp_ntz"))


def from_unix(epochs: Column | str, unit: str = "seconds") -> Column:
    column = as_column(epochs)
    if unit == "seconds":
        return F.timestamp_seconds(column)
    if unit == "milliseconds":
        return F.timestamp_millis(column.cast("bigint"))
    if unit == "microseconds":
        return F.timestamp_micros(column.cast("bigint"))
    if unit == "nanoseconds":
        return F.timestamp_micros(F.floor(column.cast("bigint") / 1000))
    raise ValueError(f"unknown epoch unit: {unit}")


def to_unix(value: Column | str) -> Column:
    return F.unix_timestamp(as_column(value).cast("timestamp"))


def now(zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return convert_timezone(F.current_timestamp() if as_of is None else as_of, zone)


def today(zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return now(zone, as_of).cast("date")


def _day(value: Column | str | None, zone: str, as_of: Column | None) -> Column:
    return today(zone, as_of) if value is None else as_column(value).cast("date")


# --- parts and names ---------------------------------------------------------------


def date_part(part: str, value: Column | str) -> Column:
    return F.date_part(F.lit(part), as_column(value))


def day_of_month(value: Column | str) -> Column:
    return F.dayofmonth(as_column(value))


def day_of_year(value: Column | str) -> Column:
    return F.dayofyear(as_column(value))


def day_of_week(value: Column | str, iso: bool = True) -> Column:
    """Monday=1..Sunday=7, or Sunday=1..Saturday=7."""
    column = as_column(value)
    return F.weekday(column) + 1 if iso else F.dayofweek(column)


def week_start(value: Column | str) -> Column:
    day = as_column(value).cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_end(value: Column | str) -> Column:
    return F.date_add(week_start(value), 6)


def week_of_year(value: Column | str) -> Column:
    """Week 1 starts on 1 January."""
    return F.ceil(F.dayofyear(as_column(value)) / 7).cast("int")


def iso_week_start(value: Column | str) -> Column:
    day = as_column(value).cast("date")
    return F.date_sub(day, F.weekday(day))


def iso_week_end(value: Column | str) -> Column:
    return F.date_add(iso_week_start(value), 6)


def iso_week_of_year(value: Column | str) -> Column:
    return F.weekofyear(as_column(value))


def iso_year_week(value: Column | str) -> Column:
    """``YYYY-Www``; the ISO year of a day is the calendar year of that week's Thursday."""
    thursday = F.date_add(iso_week_start(value), 3)
    return F.concat(
        F.year(thursday).cast("string"), F.lit("-W"), F.lpad(iso_week_of_year(value).cast("string"), 2, "0")
    )


def _localized(day: Column, pattern: str, language: str) -> Column:
    """Names come from the JVM's locale data, by way of the CSV writer's locale option."""
    return F.to_csv(F.struct(day.cast("date").alias("d")), {"dateFormat": pattern, "locale": language})


def _check_language(language: str) -> None:
    if language not in LANGUAGES:
        raise ValueError(f"unknown language {language!r}; known: {', '.join(LANGUAGES)}")


def day_name(value: Column | str, short: bool = True, language: str = "en") -> Column:
    _check_language(language)
    column = as_column(value)
    if language == "en":
        return F.date_format(column, "E" if short else "EEEE")
    name = _localized(column, "E" if short else "EEEE", language)
    if language == "fi" and not short:
        return F.regexp_replace(name, "na$", "")  # locale data holds the "on Monday" form
    if language == "sv" and short:
        return F.substring(name, 1, 3)
    return F.rtrim(name, F.lit("."))


def month_name(value: Column | str, short: bool = True, language: str = "en") -> Column:
    _check_language(language)
    column = as_column(value)
    if language == "en":
        return F.date_format(column, "MMM" if short else "MMMM")
    name = _localized(column, "LLL" if short else "LLLL", language)
    if language == "sv" and short:
        return F.substring(name, 1, 3)
    if language == "cs" and short:
        return F.when(F.month(column) == 6, F.lit("čer")).otherwise(name)
    return F.rtrim(name, F.lit("."))


# --- relative dates ----------------------------------------------------------------


def yesterday(value: Column | str | None = None, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_days_ago(1, value, zone, as_of)


def tomorrow(value: Column | str | None = None, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_days_away(1, value, zone, as_of)


def n_days_ago(n: int, value=None, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return F.date_add(_day(value, zone, as_of), -int(n))


def n_days_away(n: int, value=None, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_days_ago(-int(n), value, zone, as_of)


def n_weeks_ago(n: int, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return iso_week_start(n_days_ago(7 * int(n), None, zone, as_of))


def n_weeks_away(n: int, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_weeks_ago(-int(n), zone, as_of)


def n_months_ago(n: int, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return F.trunc(F.add_months(today(zone, as_of), -int(n)), "month")


def n_months_away(n: int, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_months_ago(-int(n), zone, as_of)


def last_week(zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_weeks_ago(1, zone, as_of)


def next_week(zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_weeks_away(1, zone, as_of)


def last_month(zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_months_ago(1, zone, as_of)


def next_month(zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return n_months_away(1, zone, as_of)


def last_month_name(short: bool = True, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return month_name(last_month(zone, as_of), short)


def next_month_name(short: bool = True, zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return month_name(next_month(zone, as_of), short)


def last_month_number(zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return F.month(last_month(zone, as_of))


def next_month_number(zone: str = DEFAULT_ZONE, as_of: Column | None = None) -> Column:
    return F.month(next_month(zone, as_of))


# --- differences and rounding ------------------------------------------------------


def boundaries_between(start: Column | str, end: Column | str, part: str) -> Column:
    """How many boundaries of ``part`` lie between two moments (not complete units)."""
    start, end, part = as_column(start), as_column(end), part.lower()
    if part == "day":
        return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    if part == "week":
        days = F.datediff(iso_week_start(end), iso_week_start(start))
        return (days / 7).cast("bigint")
    if part == "month":
        return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("bigint")
    if part == "quarter":
        return ((F.year(end) - F.year(start)) * 4 + F.quarter(end) - F.quarter(start)).cast("bigint")
    if part == "year":
        return (F.year(end) - F.year(start)).cast("bigint")
    if part in SECONDS_PER:
        size = SECONDS_PER[part]
        tick = lambda c: F.floor(F.unix_seconds(c.cast("timestamp")) / size)
        return (tick(end) - tick(start)).cast("bigint")
    raise ValueError(f"unknown date part: {part}")


def periods_since(
    value: Column | str, period: str = "day", zone: str = DEFAULT_ZONE, as_of: Column | None = None
) -> Column:
    return boundaries_between(value, now(zone, as_of), period)


def add_parts(value: Column | str, count: Column | int, part: str) -> Column:
    quantity = count if isinstance(count, Column) else F.lit(count)
    return F.timestamp_add(part.upper(), quantity.cast("int"), as_column(value))


def truncate(value: Column | str, part: str) -> Column:
    """Start of the part, as a timestamp. Weeks start on Monday."""
    return F.date_trunc(part, as_column(value).cast("timestamp"))


def part_end(value: Column | str, part: str) -> Column:
    """Last day of the month, quarter or year."""
    months = {"month": 1, "quarter": 3, "year": 12}[part]
    return F.date_sub(F.add_months(F.trunc(as_column(value).cast("date"), part), months), 1)


def round_to_day(value: Column | str) -> Column:
    return truncate(as_column(value) + F.expr("INTERVAL 12 HOURS"), "day")


def as_timestamp(value: str | dt.date | Column) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")
