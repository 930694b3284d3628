"""Correlation of ridership and incidents at three scopes (AG4-AG6, AG16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.functions.numeric import pearson

MIN_OBSERVATIONS = 30


def scoped_correlation(
    station_day: DataFrame,
    trips: str = "trip_count",
    incidents: str = "crime_count_within_quarter_mile",
    min_observations: int = MIN_OBSERVATIONS,
) -> DataFrame:
    """Rows for ``overall``, each ``per_station`` and each ``per_month``.

    One scan and one shuffle of partial moments by way of grouping sets; the minimum
    number of observations does not apply to the overall row.
    """
    rows = station_day.select("station_id", F.trunc("date_key", "month").alias("month"), trips, incidents)
    station, month = F.col("station_id"), F.col("month")
    grouped = rows.groupingSets([[], [station], [month]], station, month).agg(
        F.grouping_id().alias("__level"),
        pearson(trips, incidents).alias("correlation_coefficient"),
        F.count(F.lit(1)).alias("observation_count"),
        F.avg(trips).alias("avg_trips"),
        F.avg(incidents).alias("avg_crimes"),
    )
    # Bits of the level: 2 = station rolled up, 1 = month rolled up.
    scope = F.when(F.col("__level") == 3, "overall").when(F.col("__level") == 1, "per_station").otherwise("per_month")
    averages = {c: F.when(F.col("scope") != "per_month", F.col(c)) for c in ("avg_trips", "avg_crimes")}
    return (
        grouped.withColumn("scope", scope)
        .filter((F.col("scope") == "overall") | (F.col("observation_count") >= min_observations))
        .withColumns(averages)
        .select(
            "scope",
            "station_id",
            "month",
            "correlation_coefficient",
            "observation_count",
            "avg_trips",
            "avg_crimes",
        )
    )
