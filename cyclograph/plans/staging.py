"""Cleaning and staging (PRJ2-PRJ6)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclograph.functions.casts import guarded_cast
from cyclograph.functions.text import normalized
from cyclograph.operators.dedup import keep_first


@dataclass(frozen=True)
class Box:
    """Latitude/longitude rectangle, edges included."""

    south: float
    north: float
    west: float
    east: float

    def contains(self, lat: str, lng: str) -> Column:
        return F.col(lat).between(self.south, self.north) & F.col(lng).between(self.west, self.east)

    def allows(self, lat: str, lng: str) -> Column:
        """No latitude, or inside. A latitude without a longitude is not allowed."""
        return F.col(lat).isNull() | self.contains(lat, lng)


# Plausible positions for incidents and for trip starts.
INCIDENT_BOX = Box(41.64, 42.03, -87.95, -87.52)
TRIP_BOX = Box(41.0, 42.5, -88.5, -87.0)
FIRST_YEAR = 2018


def clean_incidents(landed: DataFrame) -> DataFrame:
    """Typed, de-duplicated landing records; missing coordinates are kept.

    The survivor of equal ids is the one updated last.
    """
    typed = landed.withColumns(
        {"id": guarded_cast("id", "bigint"), "updated_on": guarded_cast("updated_on", "timestamp")}
    ).filter("id IS NOT NULL")
    order = [F.col("updated_on").desc_nulls_last(), F.col("date").desc_nulls_last(), F.col("case_number").desc()]
    return keep_first(typed, ["id"], order).withColumns(
        {
            "date": guarded_cast("date", "timestamp"),
            "primary_type": normalized("primary_type"),
            "community_area": F.col("community_area").try_cast("int"),
        }
    )


def stage_incidents(landed: DataFrame, first_year: int = FIRST_YEAR, box: Box = INCIDENT_BOX) -> DataFrame:
    """Rename, cast, filter, then keep the latest version of each raw key.

    The filter comes first: when the newest version is outside the box, an older one
    inside it survives.
    """
    wanted = landed.filter((F.col("year") >= first_year) & box.allows("latitude", "longitude"))
    order = [F.col("updated_on").desc_nulls_last(), F.col("case_number").desc_nulls_last()]
    return keep_first(wanted, ["unique_key"], order).select(
        guarded_cast("unique_key", "bigint").alias("crime_id"),
        F.col("case_number").cast("string"),
        guarded_cast("date", "timestamp").alias("occurred_at"),
        F.col("primary_type").cast("string"),
        F.col("description").cast("string"),
        F.col("location_description").cast("string"),
        F.col("arrest").cast("boolean"),
        F.col("domestic").cast("boolean"),
        guarded_cast("community_area", "int").alias("community_area_id"),
        guarded_cast("district", "int").alias("district_id"),
        guarded_cast("ward", "int").alias("ward_id"),
        guarded_cast("latitude", "double").alias("latitude"),
        guarded_cast("longitude", "double").alias("longitude"),
        guarded_cast("year", "bigint").alias("year"),
        guarded_cast("updated_on", "timestamp").alias("updated_at"),
    )


def stage_trips(landed: DataFrame, box: Box = TRIP_BOX) -> DataFrame:
    """Typed trips with a plausible or missing start. The raw start time must be present,
    but may fail to parse; ride ids are not de-duplicated."""
    return landed.filter(
        F.col("ride_id").isNotNull() & F.col("started_at").isNotNull() & box.allows("start_lat", "start_lng")
    ).select(
        *[F.col(c).cast("string") for c in ("ride_id", "rideable_type")],
        *[guarded_cast(c, "timestamp").alias(c) for c in ("started_at", "ended_at")],
        *[
            F.col(c).cast("string")
            for c in ("start_station_name", "start_station_id", "end_station_name", "end_station_id")
        ],
        *[guarded_cast(c, "double").alias(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")],
        *[F.col(c).cast("string") for c in ("member_casual", "source_month")],
    )


def stage_station_status(raw: DataFrame) -> DataFrame:
    """Latest ingest per message position. A missing ingest time counts as the latest."""
    order = [F.col("ingest_timestamp").desc_nulls_first()]
    latest = keep_first(raw, ["kafka_partition", "kafka_offset"], order)
    counts = ("num_bikes_available", "num_bikes_disabled", "num_docks_available", "num_docks_disabled")
    flags = ("is_installed", "is_renting", "is_returning")
    return latest.select(
        F.col("station_id").cast("string"),
        *[F.col(c).cast("int") for c in counts],
        *[F.col(c).cast("boolean") for c in flags],
        F.col("last_reported").cast("timestamp").alias("reported_at"),
        F.col("legacy_id").cast("string"),
        F.col("num_ebikes_available").cast("int"),
        F.col("eightd_has_available_keys").cast("boolean"),
        F.col("num_scooters_available").cast("int"),
        F.col("num_scooters_unavailable").cast("int"),
        F.col("kafka_partition").cast("int"),
        F.col("kafka_offset").cast("bigint"),
        F.col("kafka_timestamp").cast("timestamp"),
        F.col("ingest_timestamp").cast("timestamp").alias("ingested_at"),
    )
