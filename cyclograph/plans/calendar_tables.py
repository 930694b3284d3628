"""Calendar tables: spines, date dimensions, the 4-5-4 fiscal calendar (CAL30-CAL37)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclograph.functions import calendar as cal


def number_series(spark: SparkSession, upper: int) -> DataFrame:
    """1..upper in column ``generated_number``."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row (start, end) from literals."""
    return spark.range(1).select(cal.as_timestamp(start).alias("start"), cal.as_timestamp(end).alias("end"))


def bounds_of(*series: tuple[DataFrame, str]) -> DataFrame:
    """One row (start, end) over several timestamp columns; empty sources are ignored."""
    parts = [df.agg(F.min(c).alias("start"), F.max(c).alias("end")) for df, c in series]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.agg(F.min("start").alias("start"), F.max("end").alias("end"))


SPINE_BLOCK = 10_000


def spine_steps(limits: DataFrame, part: str = "day") -> DataFrame:
    """(start, step): 0, 1, 2 and so on, one for each boundary from the start to the end.

    Long spines are made in blocks, which spread over tasks.
    """
    steps = cal.boundaries_between("start", "end", part)
    # Also where the filter drops the row, the optimizer may evaluate the sequence.
    last = F.greatest(steps - 1, F.lit(0)).cast("bigint")
    blocks = limits.filter(steps > 0).select(
        "start", steps.alias("__n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(SPINE_BLOCK).cast("bigint"))).alias("__at")
    )
    end = F.least(F.col("__at") + SPINE_BLOCK, "__n") - 1
    return blocks.repartition("__at").select("start", F.explode(F.sequence("__at", end)).alias("step"))


def date_spine(limits: DataFrame, part: str = "day") -> DataFrame:
    """``date_<part>``: as many steps from the start as there are boundaries up to the end,
    so the end itself is excluded."""
    moment = cal.add_parts("start", F.col("step"), part).cast("timestamp")
    return spine_steps(limits, part).select(moment.alias(f"date_{part}"))


def base_dates(
    spark: SparkSession,
    start: str | None = None,
    end: str | None = None,
    n_parts: int | None = None,
    part: str = "day",
    as_of: Column | None = None,
) -> DataFrame:
    """Spine between two dates, or of the last ``n_parts`` up to and including today."""
    if start and end:
        return date_spine(bounds(spark, start, end), part)
    if not n_parts:
        raise ValueError("give start and end, or n_parts")
    day = cal.today(as_of=as_of)
    limits = spark.range(1).select(
        cal.add_parts(day.cast("timestamp"), -n_parts, part).alias("start"),
        cal.tomorrow(as_of=as_of).cast("timestamp").alias("end"),
    )
    return date_spine(limits, part)


def date_dimension(days: DataFrame, languages: Sequence[str] = ()) -> DataFrame:
    """One wide row per ``date_day``; every language adds long and short names."""
    d = days.select(F.col("date_day").cast("date"))
    day = F.col("date_day")
    last_year = F.add_months(day, -12)
    same_weekday = F.date_sub(day, 364)
    localized = {}
    for language in languages:
        localized[f"day_of_week_name_{language}"] = cal.day_name(day, short=False, language=language)
        localized[f"day_of_week_name_short_{language}"] = cal.day_name(day, language=language)
        localized[f"month_name_{language}"] = cal.month_name(day, short=False, language=language)
        localized[f"month_name_short_{language}"] = cal.month_name(day, language=language)
    columns = {
        "prior_date_day": cal.yesterday(day),
        "next_date_day": cal.tomorrow(day),
        "prior_year_date_day": last_year,
        "prior_year_over_year_date_day": same_weekday,
        "day_of_week": cal.day_of_week(day, iso=False),
        "day_of_week_iso": cal.day_of_week(day, iso=True),
        "day_of_week_name": cal.day_name(day, short=False),
        "day_of_week_name_short": cal.day_name(day),
        "day_of_month": cal.day_of_month(day),
        "day_of_year": cal.day_of_year(day),
        "week_start_date": cal.week_start(day),
        "week_end_date": cal.week_end(day),
        "prior_year_week_start_date": cal.week_start(same_weekday),
        "prior_year_week_end_date": cal.week_end(same_weekday),
        "week_of_year": cal.week_of_year(day),
        "iso_week_start_date": cal.iso_week_start(day),
        "iso_week_end_date": cal.iso_week_end(day),
        "prior_year_iso_week_start_date": cal.iso_week_start(same_weekday),
        "prior_year_iso_week_end_date": cal.iso_week_end(same_weekday),
        "iso_week_of_year": cal.iso_week_of_year(day),
        "iso_year_week": cal.iso_year_week(day),
        "prior_year_week_of_year": cal.week_of_year(same_weekday),
        "prior_year_iso_week_of_year": cal.iso_week_of_year(same_weekday),
        "month_of_year": F.month(day),
        "month_name": cal.month_name(day, short=False),
        "month_name_short": cal.month_name(day),
        "month_start_date": F.trunc(day, "month"),
        "month_end_date": cal.part_end(day, "month"),
        "prior_year_month_start_date": F.trunc(last_year, "month"),
        "prior_year_month_end_date": cal.part_end(last_year, "month"),
        "quarter_of_year": F.quarter(day),
        "quarter_start_date": F.trunc(day, "quarter"),
        "quarter_end_date": cal.part_end(day, "quarter"),
        "year_number": F.year(day),
        "year_start_date": F.trunc(day, "year"),
        "year_end_date": cal.part_end(day, "year"),
    }
    return d.select(day, *[c.alias(n) for n, c in {**columns, **localized}.items()])


def project_dates(limits: DataFrame) -> DataFrame:
    """The model's own day dimension, both ends included."""
    days = limits.filter("start IS NOT NULL").select(
        F.explode(F.sequence(F.to_date("start"), F.to_date("end"))).alias("date_key")
    )
    day = F.col("date_key")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        cal.day_name(day, short=False).alias("day_name"),
        cal.month_name(day, short=False).alias("month_name"),
        F.trunc(day, "month").alias("month_start"),
        F.trunc(day, "quarter").alias("quarter_start"),
    )


def fiscal_year_dates(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """Days with their fiscal year and week. A fiscal year ends on the week end closest to
    the end of ``year_end_month``; two equally close week ends both count.

    ``dates`` is a date dimension. Range conditions are turned into equi-joins: a year
    is expanded to its days, and a day's week follows from its weekday.
    """
    year = (F.col("year_number") - shift_year).alias("fiscal_year_number")
    month_ends = dates.filter(F.col("month_of_year") == year_end_month).select(year, "month_end_date").distinct()
    week_ends = (
        dates.filter((F.col("day_of_week") == week_start_day) & (F.col("month_of_year") == year_end_month))
        .select(year, F.date_add("date_day", 6).alias("week_end_date"))
        .distinct()
    )
    closest = Window.partitionBy("fiscal_year_number").orderBy(
        F.abs(F.datediff("month_end_date", "week_end_date"))
    )
    # One row per fiscal year from here on, so an unpartitioned window is harmless.
    ends = (
        week_ends.join(month_ends, "fiscal_year_number")
        .withColumn("__closeness", F.rank().over(closest))
        .filter("__closeness = 1")
    )
    years = ends.select(
        "fiscal_year_number",
        F.date_add(F.lag("week_end_date").over(Window.orderBy("week_end_date")), 1).alias("fiscal_year_start_date"),
        F.col("week_end_date").alias("fiscal_year_end_date"),
    ).filter("fiscal_year_start_date IS NOT NULL AND fiscal_year_start_date <= fiscal_year_end_date")
    year_days = years.withColumn(
        "date_day", F.explode(F.sequence("fiscal_year_start_date", "fiscal_year_end_date"))
    )
    week_starts = dates.filter(F.col("day_of_week") == week_start_day).select(
        F.col("date_day").alias("week_start_date"), F.date_add("date_day", 6).alias("week_end_date")
    )
    days_into_week = F.pmod(F.col("day_of_week") - week_start_day, F.lit(7)).cast("int")
    days = dates.select("date_day", F.date_sub("date_day", days_into_week).alias("week_start_date"))
    week_number = F.dense_rank().over(Window.partitionBy("fiscal_year_number").orderBy("week_start_date"))
    return (
        days.join(week_starts, "week_start_date")
        .join(year_days, "date_day")
        .select(
            "date_day",
            "fiscal_year_number",
            "fiscal_year_start_date",
            "fiscal_year_end_date",
            "week_start_date",
            "week_end_date",
            week_number.alias("fiscal_week_of_year"),
        )
    )


def fiscal_periods(
    dates: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1
) -> DataFrame:
    """4-5-4 periods: quarters of 13 weeks; a 53rd week belongs to the last period."""
    weeks = fiscal_year_dates(dates, year_end_month, week_start_day, shift_year)
    week = F.col("fiscal_week_of_year")
    in_quarter = (week - 1) % 13
    period_of_quarter = (
        F.when(week == 53, 3).when(in_quarter <= 3, 1).when(in_quarter <= 8, 2).otherwise(3)
    )
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    numbered = weeks.withColumns(
        {
            "fiscal_period_of_quarter": period_of_quarter,
            "fiscal_quarter_number": quarter + 1,
            "fiscal_period_number": quarter * 3 + period_of_quarter,
        }
    )
    # The rank runs over the period number of all years together.
    by_period = Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")
    return numbered.select(
        "date_day",
        "fiscal_year_number",
        "week_start_date",
        "week_end_date",
        "fiscal_week_of_year",
        F.dense_rank().over(by_period).alias("fiscal_week_of_period"),
        "fiscal_period_number",
        "fiscal_quarter_number",
        "fiscal_period_of_quarter",
    )
