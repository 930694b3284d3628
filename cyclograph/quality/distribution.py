"""Checks on distributions, completeness and recency (DQ70-DQ74)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclograph.functions import calendar as cal
from cyclograph.functions.casts import as_expression
from cyclograph.functions.numeric import safe_log
from cyclograph.operators.ranges import with_rows_before
from cyclograph.plans.calendar_tables import bounds, spine_steps
from cyclograph.quality.core import Check, Condition, where

EPOCH_START = "1970-01-01"


def within_n_stdevs(column: str, group_by: Sequence[str] | None = None, sigma_threshold: float = 3) -> Check:
    """Sums per group whose z-score among all groups is too large.

    Mean and deviation come from a one-row aggregate instead of a window over everything.
    """
    keys = list(group_by or [])

    def violations(df: DataFrame) -> DataFrame:
        sums = df.groupBy(*map(as_expression, keys)).agg(F.sum(as_expression(column)).alias(column))
        spread = sums.agg(F.struct(F.avg(column).alias("average"), F.stddev_samp(column).alias("stddev"))).scalar()
        placed = sums.withColumn("__spread", spread).select(
            "*", F.col("__spread.average").alias(f"{column}_average"), F.col("__spread.stddev").alias(f"{column}_stddev")
        )
        sigma = (F.col(column) - F.col(f"{column}_average")) / F.nullif(F.col(f"{column}_stddev"), F.lit(0.0))
        scored = placed.drop("__spread").withColumn(f"{column}_sigma", sigma)
        return scored.filter(F.abs(f"{column}_sigma") > sigma_threshold)

    return Check(f"within_n_stdevs_{column}", violations)


def within_n_moving_stdevs(
    column: str,
    date_column: str,
    group_by: Sequence[str] | None = None,
    period: str = "day",
    lookback_periods: int = 1,
    trend_periods: int = 7,
    test_periods: int = 14,
    sigma_threshold: float = 3,
    sigma_threshold_upper: float | None = None,
    sigma_threshold_lower: float | None = None,
    take_diffs: bool = True,
    take_logs: bool = True,
    as_of: Column | None = None,
) -> Check:
    """Period sums against the mean and deviation of the periods before them.

    The windows see one row per group and period. Frames count rows: missing periods
    are not filled in. A window without deviation passes. The periods are cut into ranges, and
    each range carries along as many of the rows before it as its frames reach back, so no task
    holds all periods.
    """
    keys = list(group_by or [])
    upper = sigma_threshold_upper if sigma_threshold_upper else sigma_threshold
    lower = sigma_threshold_lower if sigma_threshold_lower else -sigma_threshold
    metric = safe_log if take_logs else (lambda c: F.coalesce(F.col(c), F.lit(0)))

    def violations(df: DataFrame) -> DataFrame:
        ordered = Window.partitionBy("__range", *[F.col(f"`{k}`") for k in keys]).orderBy("metric_period")
        trend = ordered.rowsBetween(-trend_periods, -1)
        groups = [as_expression(k).alias(k) for k in keys]
        sums = df.groupBy(cal.truncate(as_expression(date_column), period).alias("metric_period"), *groups).agg(
            F.sum(as_expression(column)).alias("agg_metric_value")
        )
        reach = trend_periods + (lookback_periods if take_diffs else 0)
        sums = with_rows_before(sums, [*keys, "metric_period"], reach)
        tested = metric("agg_metric_value")
        if take_diffs:
            sums = sums.withColumn(
                "prior_agg_metric_value", F.lag("agg_metric_value", lookback_periods).over(ordered)
            )
            tested = tested - metric("prior_agg_metric_value")
        moving = sums.withColumn("metric_test_value", tested).withColumns(
            {
                "metric_test_rolling_average": F.avg("metric_test_value").over(trend),
                "metric_test_rolling_stddev": F.stddev_samp("metric_test_value").over(trend),
            }
        )
        delta = F.col("metric_test_value") - F.col("metric_test_rolling_average")
        scored = moving.withColumns(
            {
                "metric_test_delta": delta,
                "metric_test_sigma": delta / F.nullif(F.col("metric_test_rolling_stddev"), F.lit(0.0)),
            }
        )
        this_period = cal.truncate(cal.now(as_of=as_of), period)
        recent = (F.col("metric_period") >= cal.add_parts(this_period, -test_periods, period)) & (
            F.col("metric_period") < this_period
        )
        own = scored.filter("__own").drop("__range", "__own")
        return own.filter(recent & ~F.col("metric_test_sigma").between(lower, upper))

    return Check(f"within_n_moving_stdevs_{column}", violations)


def row_values_to_have_data_for_every_n_datepart(
    date_column: str,
    date_part: str = "day",
    interval: int | None = None,
    row_condition: Condition = None,
    exclusion_condition: Column | str | None = None,
    test_start_date: str | None = None,
    test_end_date: str | None = None,
) -> Check:
    """Periods without rows between the first and the last date (the last is excluded).

    With an interval, n periods from the start form one bucket.
    """
    bucket = f"date_{date_part}"

    def violations(df: DataFrame) -> DataFrame:
        rows = where(df, row_condition)
        start, end = F.min(F.to_date(as_expression(date_column))), F.max(F.to_date(as_expression(date_column)))
        if test_start_date and test_end_date:
            limits = bounds(df.sparkSession, test_start_date, test_end_date)
        else:
            limits = rows.agg(
                F.lit(test_start_date).alias("start") if test_start_date else start.alias("start"),
                F.lit(test_end_date).alias("end") if test_end_date else end.alias("end"),
            )
        limits = limits.select(F.col("start").cast("timestamp"), F.col("end").cast("timestamp"))
        n = interval or 1
        # Each bucket with its n periods; a bucket is missing if none of them has rows. The limits
        # and the dates are one scan each.
        buckets = spine_steps(limits, date_part).filter(F.col("step") % n == 0)
        starts = buckets.select(cal.add_parts("start", F.col("step"), date_part).cast("timestamp").alias(bucket))
        offset = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("__offset")
        periods = starts.select(bucket, offset).select(
            bucket, cal.add_parts(bucket, F.col("__offset"), date_part).cast("timestamp").alias("__period")
        )
        dates = rows.select(cal.truncate(as_expression(date_column), date_part).cast("timestamp").alias("__period")).distinct()
        here = periods.join(dates.withColumn("__here", F.lit(1)), "__period", "left")
        missing = here.groupBy(bucket).agg(F.max("__here").alias("__here")).filter("__here IS NULL").select(
            bucket, F.lit(True).alias("is_missing"), F.lit(0).cast("bigint").alias("row_cnt")
        )
        return missing if exclusion_condition is None else missing.filter(as_expression(exclusion_condition))

    return Check(f"data_for_every_{date_part}_{date_column}", violations)


def _cutoff(datepart: str, interval: int, as_of: Column | None) -> Column:
    return cal.add_parts(cal.now(as_of=as_of).cast("timestamp"), -interval, datepart)


def row_values_to_have_recent_data(
    column: str, datepart: str, interval: int, row_condition: Condition = None, as_of: Column | None = None
) -> Check:
    """The latest time that is not in the future must be recent; no rows at all fails."""

    def violations(df: DataFrame) -> DataFrame:
        moment = as_expression(column).cast("timestamp")
        rows = where(df, row_condition).filter(moment <= cal.now(as_of=as_of).cast("timestamp"))
        latest = rows.agg(F.max(moment).alias("max_timestamp"))
        known = F.coalesce("max_timestamp", F.lit(EPOCH_START).cast("timestamp"))
        return latest.filter(known < _cutoff(datepart, interval, as_of))

    return Check(f"recent_data_{column}", violations)


def grouped_row_values_to_have_recent_data(
    group_by: Sequence[str],
    column: str,
    datepart: str,
    interval: int,
    row_condition: Condition = None,
    as_of: Column | None = None,
) -> Check:
    """Groups whose latest time is too old; groups with no qualifying row do not appear."""

    def violations(df: DataFrame) -> DataFrame:
        moment = as_expression(column).cast("timestamp")
        rows = where(df, row_condition).filter(moment <= cal.now(as_of=as_of).cast("timestamp"))
        latest = rows.groupBy(*map(as_expression, group_by)).agg(F.max(moment).alias("latest_timestamp_column"))
        return latest.filter(F.col("latest_timestamp_column") < _cutoff(datepart, interval, as_of))

    return Check(f"grouped_recent_data_{column}", violations)
