"""Dashboard and documented queries (Q1-Q19). Orderings carry a tiebreak."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclograph.functions.calendar import truncate
from cyclograph.functions.text import key_part
from cyclograph.plans.marts import NEARBY_INCIDENTS

UNASSIGNED_AREA = 0
VIOLENT_TYPES = ("THEFT", "BATTERY", "ROBBERY")
FRESHNESS_LIMITS = (300, 900)  # seconds: warn, bad


def top_areas(incidents: DataFrame, areas: DataFrame, n: int = 15) -> DataFrame:
    """Incidents per area name. Counting by id first leaves one row per area to join."""
    per_area = (
        incidents.filter(F.col("community_area_id") != UNASSIGNED_AREA)
        .groupBy("community_area_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    named = per_area.join(areas, "community_area_id").groupBy("community_area_name")
    counted = named.agg(F.sum("n").alias("crime_count"))
    return counted.orderBy(F.desc("crime_count"), "community_area_name").limit(n)


def top_types(incidents: DataFrame, n: int = 10) -> DataFrame:
    by_type = incidents.groupBy(key_part("crime_type_key", 1).alias("primary_type"))
    counted = by_type.agg(F.count(F.lit(1)).alias("crime_count"))
    return counted.orderBy(F.desc("crime_count"), "primary_type").limit(n)


def trips_by_hour(trips: DataFrame) -> DataFrame:
    by_hour = trips.groupBy(F.hour("started_at").alias("hour_of_day"))
    return by_hour.agg(F.count(F.lit(1)).alias("trip_count")).orderBy("hour_of_day")


def busy_station_hours(trips: DataFrame, n: int = 20) -> DataFrame:
    """Hourly profile of the busiest stations. Trips are read once: the hourly counts
    serve both the ranking and the result."""
    hourly = trips.groupBy(
        F.hour("started_at").alias("hour_of_day"), F.col("start_station_id").alias("station_id")
    ).agg(F.count(F.lit(1)).alias("trip_count"))
    totals = hourly.withColumn("__total", F.sum("trip_count").over(Window.partitionBy("station_id")))
    # At most 24 rows for each station; each task passes on the rows of its own first n stations only.
    busiest = Window.orderBy(F.desc("__total"), F.col("station_id").asc_nulls_last())
    ranked = totals.withColumn("__place", F.dense_rank().over(busiest)).filter(F.col("__place") <= n)
    # A group without a station may be ranked, but is not shown.
    return ranked.filter("station_id IS NOT NULL").drop("__total", "__place").orderBy("station_id", "hour_of_day")


def monthly_series(incidents: DataFrame, trips: DataFrame) -> DataFrame:
    def per_month(df, moment, name):
        return df.groupBy(truncate(moment, "month").alias("time")).agg(F.count(F.lit(1)).alias(name))

    crimes = per_month(incidents, "occurred_at", "monthly_crime_count")
    rides = per_month(trips, "started_at", "monthly_trip_count")
    joined = crimes.join(rides, "time", "left")
    return joined.select(
        "time", "monthly_crime_count", F.coalesce("monthly_trip_count", F.lit(0)).alias("monthly_trip_count")
    ).orderBy("time")


def incidents_by_weekday_hour(incidents: DataFrame) -> DataFrame:
    """Sunday is 0."""
    grouped = incidents.groupBy(
        F.hour("occurred_at").alias("hour_of_day"), (F.dayofweek("occurred_at") - 1).alias("day_of_week")
    )
    return grouped.agg(F.count(F.lit(1)).alias("crime_count")).orderBy("day_of_week", "hour_of_day")


def recent_scatter(station_day: DataFrame, as_of: Column, days: int = 30, n: int = 5000) -> DataFrame:
    recent = station_day.filter(F.col("date_key") >= F.date_sub(as_of.cast("date"), days))
    order = [F.desc("trip_count"), F.desc(NEARBY_INCIDENTS), F.col("station_id"), F.col("date_key")]
    return recent.orderBy(*order).limit(n).select("trip_count", NEARBY_INCIDENTS)


def overall_correlation(correlation: DataFrame) -> DataFrame:
    return correlation.filter("scope = 'overall'").select("correlation_coefficient")


def row_counts(**tables: DataFrame) -> DataFrame:
    """One row per table, in a single unioned job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def hourly_trips(trips: DataFrame, n: int = 168) -> DataFrame:
    by_hour = trips.groupBy(truncate("started_at", "hour").alias("time"))
    return by_hour.agg(F.count(F.lit(1)).alias("trips_ingested")).orderBy(F.desc("time")).limit(n)


def freshness(trips: DataFrame, as_of: Column) -> DataFrame:
    """Whole seconds since the last trip, graded."""
    latest = trips.agg(F.max("started_at").alias("latest"))
    seconds = latest.select(F.timestamp_diff("SECOND", F.col("latest"), as_of).alias("seconds_since_last_trip"))
    warn, bad = FRESHNESS_LIMITS
    age = F.col("seconds_since_last_trip")
    return seconds.withColumn("level", F.when(age >= bad, "bad").when(age >= warn, "warn").otherwise("ok"))


def latest_incident(incidents: DataFrame) -> DataFrame:
    return incidents.agg(F.max("occurred_at").alias("latest_crime_time"))


def latest_test_outcomes(results: DataFrame) -> DataFrame:
    """Counts for the newest run. ``max`` and the counts come out of one aggregation by
    run time, instead of a second scan for the maximum."""
    counts = {"passing": "pass", "failing": "fail", "warnings": "warn"}
    per_run = results.groupBy("generated_at").agg(
        *[F.count_if(F.col("status") == status).alias(name) for name, status in counts.items()]
    )
    newest = per_run.filter("generated_at IS NOT NULL").orderBy(F.desc("generated_at")).limit(1)
    # An aggregate without keys: one row of zeros when there is no run at all.
    return newest.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts])


def failed_tasks(tasks: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = tasks.filter(F.col("start_date") > as_of - F.make_dt_interval(days=F.lit(days)))
    return recent.filter(F.col("state").isin("failed", "upstream_failed")).agg(F.count(F.lit(1)).alias("failed_tasks"))


def runs_by_state(runs: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = runs.filter(F.col("start_date") > as_of - F.make_dt_interval(days=F.lit(days)))
    return recent.groupBy("state").agg(F.count(F.lit(1)).alias("run_count")).orderBy(F.desc("run_count"), "state")


def recent_task_runs(tasks: DataFrame, as_of: Column, days: int = 2, n: int = 50) -> DataFrame:
    recent = tasks.filter(F.col("start_date") > as_of - F.make_dt_interval(days=F.lit(days)))
    micros = F.unix_micros("end_date") - F.unix_micros("start_date")
    order = [F.desc("start_date"), F.col("dag_id"), F.col("task_id"), F.col("run_id")]
    return recent.orderBy(*order).limit(n).select(
        "dag_id", "task_id", "run_id", "state", "start_date", "end_date", (micros / 1_000_000).alias("duration_seconds")
    )


def average_bikes(reads: DataFrame, n: int = 5) -> DataFrame:
    averaged = reads.groupBy("station_id").agg(
        F.count(F.lit(1)).alias("polls"),
        F.round(F.avg("num_bikes_available"), 2).alias("avg_bikes_available"),
        F.round(F.avg("total_vehicles_available"), 2).alias("avg_total_vehicles"),
    )
    return averaged.orderBy(F.col("avg_bikes_available").desc_nulls_last(), "station_id").limit(n)


def flag_combinations(status: DataFrame) -> DataFrame:
    return status.groupBy("is_installed", "is_renting", "is_returning").agg(F.count(F.lit(1)).alias("n"))


def rows_per_minute(status: DataFrame, moment: str = "ingest_timestamp") -> DataFrame:
    return status.groupBy(truncate(moment, "minute").alias("minute")).agg(F.count(F.lit(1)).alias("n")).orderBy("minute")


def area_months(
    incidents: DataFrame, reads: DataFrame, station_areas: DataFrame, violent: Sequence[str] = VIOLENT_TYPES
) -> DataFrame:
    """Incidents against station activity per area and month; either side may be missing.

    Reads are reduced to (station, month) sums before they meet the station's area.
    """
    month = lambda c: truncate(c, "month")
    crimes = incidents.groupBy("community_area_id", month("occurred_at").alias("month")).agg(
        F.count(F.lit(1)).alias("crime_count"),
        F.sum(F.when(F.col("primary_type").isin(list(violent)), 1).otherwise(0)).alias("violent_crime_count"),
    )
    per_station = reads.groupBy("station_id", month("reported_at").alias("month")).agg(
        F.sum("num_bikes_available").alias("bikes"),
        F.count("num_bikes_available").alias("known"),
        F.count(F.lit(1)).alias("polls"),
    )
    activity = (
        per_station.join(station_areas, "station_id")
        .groupBy("community_area_id", "month")
        .agg(
            (F.sum("bikes") / F.nullif(F.sum("known"), F.lit(0))).alias("avg_bikes_available"),
            F.sum("polls").alias("poll_count"),
        )
    )
    joined = crimes.join(activity, ["community_area_id", "month"], "full")
    return joined.orderBy("community_area_id", "month")
