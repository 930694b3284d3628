"""Facts, dimensions and the station-day mart (PRJ7-PRJ12, AG1-AG3, AG7, CAL37)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.functions.geo import QUARTER_MILE_M
from cyclograph.functions.text import composite_key
from cyclograph.operators.dedup import keep_first
from cyclograph.operators.nearby import nearby_counts
from cyclograph.plans.staging import INCIDENT_BOX, Box

NEARBY_INCIDENTS = "crime_count_within_quarter_mile"


def incident_facts(staged: DataFrame) -> DataFrame:
    return staged.filter("crime_id IS NOT NULL").select(
        "crime_id",
        "occurred_at",
        F.to_date("occurred_at").alias("date_key"),
        "community_area_id",
        "primary_type",
        composite_key("primary_type", "description").alias("crime_type_key"),
        "arrest",
        "domestic",
        "latitude",
        "longitude",
        "district_id",
        "ward_id",
        "year",
    )


def trip_facts(staged: DataFrame) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at"))
    return staged.select("*", F.to_date("started_at").alias("date_key"), seconds.alias("trip_duration_seconds"))


def station_read_facts(staged: DataFrame) -> DataFrame:
    vehicles = (
        F.col("num_bikes_available")
        + F.col("num_ebikes_available")
        + F.coalesce(F.col("num_scooters_available"), F.lit(0))
    )
    return staged.filter("station_id IS NOT NULL AND reported_at IS NOT NULL").select(
        "station_id",
        "reported_at",
        F.to_date("reported_at").alias("date_key"),
        "ingested_at",
        "num_bikes_available",
        "num_bikes_disabled",
        "num_docks_available",
        "num_docks_disabled",
        "num_ebikes_available",
        "num_scooters_available",
        "num_scooters_unavailable",
        "is_installed",
        "is_renting",
        "is_returning",
        "eightd_has_available_keys",
        vehicles.alias("total_vehicles_available"),
        F.col("num_docks_available").alias("total_docks_available"),
        "kafka_partition",
        "kafka_offset",
        "kafka_timestamp",
    )


def incident_types(staged: DataFrame) -> DataFrame:
    return (
        staged.filter("primary_type IS NOT NULL AND description IS NOT NULL")
        .select(composite_key("primary_type", "description").alias("crime_type_key"), "primary_type", "description")
        .distinct()
    )


def areas(seed: DataFrame) -> DataFrame:
    return seed.select(
        F.col("community_area_id").cast("bigint"), F.col("community_area_name").cast("string")
    )


def stations(staged_trips: DataFrame) -> DataFrame:
    """Most frequent (name, position) of each station; ties by position, then name."""
    counted = (
        staged_trips.filter("start_station_id IS NOT NULL AND start_lat IS NOT NULL AND start_lng IS NOT NULL")
        .groupBy(
            F.col("start_station_id").alias("station_id"),
            F.col("start_station_name").alias("station_name"),
            F.col("start_lat").alias("lat"),
            F.col("start_lng").alias("lng"),
        )
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    order = [F.col("occurrences").desc(), F.col("lat"), F.col("lng"), F.col("station_name")]
    return keep_first(counted, ["station_id"], order).drop("occurrences")


def trips_per_station_day(trips: DataFrame) -> DataFrame:
    """From the stored fact this reads one column besides the partition column."""
    return (
        trips.filter("start_station_id IS NOT NULL")
        .groupBy(F.col("start_station_id").alias("station_id"), "date_key")
        .agg(F.count(F.lit(1)).alias("trip_count"))
    )


def station_day(
    trips: DataFrame,
    station_dim: DataFrame,
    incidents: DataFrame,
    radius_m: float = QUARTER_MILE_M,
    lookback_days: int = 0,
) -> DataFrame:
    """Trips and nearby incidents per station and day (the flagship mart).

    Both inputs of the last join hold at most one row per (station, day). Incidents are
    matched to stations, not to station-days, so trips never multiply incidents.
    """
    points = incidents.select(
        "crime_id", "date_key", F.col("latitude").alias("lat"), F.col("longitude").alias("lng")
    )
    near = nearby_counts(station_dim, points, "station_id", "date_key", radius_m, lookback_days)
    return (
        trips_per_station_day(trips)
        .join(near.withColumnRenamed("n", NEARBY_INCIDENTS), ["station_id", "date_key"], "left")
        .select(
            "station_id",
            "date_key",
            "trip_count",
            F.coalesce(F.col(NEARBY_INCIDENTS), F.lit(0)).alias(NEARBY_INCIDENTS),
        )
    )


def out_of_bounds(staged_incidents: DataFrame, box: Box = INCIDENT_BOX) -> DataFrame:
    """Rows whose position is known and outside the box; an empty result passes."""
    return staged_incidents.filter(
        "latitude IS NOT NULL AND longitude IS NOT NULL"
    ).filter(~box.contains("latitude", "longitude")).select("crime_id", "latitude", "longitude", "occurred_at")
