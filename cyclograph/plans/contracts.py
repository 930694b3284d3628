"""What every table of the model must satisfy, as checks per table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cyclograph import quality as q
from cyclograph.operators.regression import FEATURES, LABEL
from cyclograph.plans.marts import NEARBY_INCIDENTS
from cyclograph.plans.staging import INCIDENT_BOX, TRIP_BOX, Box
from cyclograph.quality.core import Check

# Ranges the tables promise.
CALENDAR_YEARS = (2018, 2026)
AREA_IDS = (1, 77)
COUNT_RANGE = (0, 100)  # bikes, docks, vehicles at one station
TRIPS_PER_DAY = (0, 10_000)
SCOPES = ("overall", "per_station", "per_month")


def _not_null(*columns: str) -> list[Check]:
    return [q.not_null(c) for c in columns]


def _key(column: str) -> list[Check]:
    return [q.unique(column), q.not_null(column)]


def _inside(box: Box, lat: str, lng: str) -> list[Check]:
    return [q.values_to_be_between(lat, box.south, box.north), q.values_to_be_between(lng, box.west, box.east)]


def checks(tables: dict[str, DataFrame], calendar_years: tuple[int, int] = CALENDAR_YEARS) -> dict[str, list[Check]]:
    """Checks for each of the named tables; foreign keys refer to the other tables."""
    days = ("date_key", tables["dates"], "date_key")
    contracts = {
        "dates": [
            *_key("date_key"),
            *_not_null("year", "month"),
            q.values_to_be_between("year", *calendar_years),
            q.values_to_be_between("month", 1, 12),
        ],
        "areas": [
            *_key("community_area_id"),
            q.values_to_be_between("community_area_id", *AREA_IDS),
            *_not_null("community_area_name"),
        ],
        "incident_types": [*_key("crime_type_key"), *_not_null("primary_type")],
        "stations": [*_key("station_id"), *_not_null("station_name", "lat", "lng"), *_inside(TRIP_BOX, "lat", "lng")],
        "incidents": [
            *_key("crime_id"),
            *_not_null("date_key", "crime_type_key"),
            q.relationships(*days),
            q.relationships(
                "community_area_id", tables["areas"], "community_area_id", row_condition="community_area_id <> 0"
            ),
            q.relationships("crime_type_key", tables["incident_types"], "crime_type_key"),
            *_inside(INCIDENT_BOX, "latitude", "longitude"),
        ],
        "trips": [*_not_null("ride_id", "started_at", "date_key"), q.relationships(*days)],
        "station_day": [
            *_not_null("station_id", "date_key", "trip_count", NEARBY_INCIDENTS),
            q.relationships(*days),
            q.values_to_be_between("trip_count", *TRIPS_PER_DAY),
        ],
        "correlation": [*_not_null("scope", "observation_count"), q.accepted_values("scope", SCOPES)],
        "training": [
            *_not_null(LABEL, *FEATURES, "station_id"),
            q.values_to_be_between(LABEL, *TRIPS_PER_DAY),
            q.values_to_be_between("day_of_week", 1, 7),
            q.values_to_be_between("month", 1, 12),
        ],
        "weights": _not_null("processed_input"),
        "predictions": _not_null("station_id", "date_key", LABEL, f"predicted_{LABEL}"),
        "station_reads": [
            *_not_null("station_id", "reported_at", "date_key", "is_renting", "is_returning"),
            q.relationships(*days),
            *_not_null("num_bikes_available", "num_docks_available", "total_vehicles_available"),
            *[
                q.values_to_be_between(c, *COUNT_RANGE)
                for c in ("num_bikes_available", "num_docks_available", "total_vehicles_available")
            ],
        ],
    }
    return {
        name: [c.configured(name=f"{name}.{c.name}") for c in contracts[name]] for name in tables if name in contracts
    }
