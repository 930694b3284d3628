"""Distance join (JN1): how many dated points lie within a radius of each place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.functions.geo import QUARTER_MILE_M, Grid, haversine_m


def nearby_pairs(places: DataFrame, points: DataFrame, radius_m: float = QUARTER_MILE_M) -> DataFrame:
    """Inner join on distance. Both sides need ``lat`` and ``lng``; their other columns must differ.

    An equi-join on grid cells followed by the exact distance. Points stay one row each; a
    place is repeated for the few cells it reaches, at most nine. No broadcast is forced: the
    optimizer chooses one for few places, and points are not shuffled then. Beyond that both
    sides are shuffled by cell, and the adaptive planner splits crowded cells by their size.
    """
    grid = Grid(radius_m)
    place_columns = [F.col(c) for c in places.columns if c not in ("lat", "lng")]
    spread = (
        places.filter("lat IS NOT NULL AND lng IS NOT NULL")
        .select(*place_columns, F.col("lat").alias("__lat"), F.col("lng").alias("__lng"))
        .withColumn("__band", F.explode(grid.neighbour_bands(F.col("__lat"))))
        .withColumn("__cell", F.explode(grid.cells_touched(F.col("__lat"), F.col("__lng"), F.col("__band"))))
    )
    keyed = (
        points.filter("lat IS NOT NULL AND lng IS NOT NULL")
        .withColumn("__band", grid.band(F.col("lat")))
        .withColumn("__cell", grid.cell(F.col("lng"), F.col("__band")))
    )
    near = haversine_m(F.col("__lat"), F.col("__lng"), F.col("lat"), F.col("lng")) <= radius_m
    return keyed.join(spread, ["__band", "__cell"]).filter(near).drop("__band", "__cell", "__lat", "__lng")


CELL_PARTS = 4
"""Cells for counting are this many times smaller than the radius: more of them lie wholly inside it."""


def matches(
    places: DataFrame, points: DataFrame, place_id: str, date: str, radius_m: float = QUARTER_MILE_M
) -> tuple[DataFrame, DataFrame]:
    """(place_id, date, n) of the cells wholly inside the radius, and of the positions in the cells on its rim.

    Points are counted by day and position, and these counts by day and cell, before they meet a
    place. A cell inside the radius then brings one row a day, however many points it holds; only
    positions on the rim are compared with the place.
    """
    grid = Grid(radius_m, CELL_PARTS)
    spread = (
        places.filter("lat IS NOT NULL AND lng IS NOT NULL")
        .select(place_id, F.col("lat").alias("__lat"), F.col("lng").alias("__lng"))
        .withColumn("__band", F.explode(grid.bands_touched(F.col("__lat"))))
        .withColumn("__cell", F.explode(grid.cells_touched(F.col("__lat"), F.col("__lng"), F.col("__band"))))
        .withColumn("__is", grid.relation(F.col("__lat"), F.col("__lng"), F.col("__band"), F.col("__cell")))
    )
    positions = (
        points.filter(F.col(date).isNotNull() & F.col("lat").isNotNull() & F.col("lng").isNotNull())
        .groupBy(date, "lat", "lng")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("__band", grid.band(F.col("lat")))
        .withColumn("__cell", grid.cell(F.col("lng"), F.col("__band")))
    )
    cells = positions.groupBy("__band", "__cell", date).agg(F.sum("n").alias("n"))
    inner = cells.join(spread.filter("__is = 'inside'").select(place_id, "__band", "__cell"), ["__band", "__cell"])
    rim = positions.join(spread.filter("__is = 'rim'").drop("__is"), ["__band", "__cell"])
    near = haversine_m(F.col("__lat"), F.col("__lng"), F.col("lat"), F.col("lng")) <= radius_m
    return inner.select(place_id, date, "n"), rim.filter(near).select(place_id, date, "n")


def nearby_counts(
    places: DataFrame,
    points: DataFrame,
    place_id: str,
    date: str,
    radius_m: float = QUARTER_MILE_M,
    lookback_days: int = 0,
) -> DataFrame:
    """(place_id, date, n): points on that date, or in the ``lookback_days`` before it, too."""
    inner, rim = matches(places, points, place_id, date, radius_m)
    counts = inner.unionAll(rim).groupBy(place_id, date).agg(F.sum("n").alias("n"))
    if not lookback_days:
        return counts
    ahead = F.explode(F.sequence(F.lit(0), F.lit(lookback_days))).alias("__ahead")
    moved = counts.select(place_id, date, "n", ahead).withColumn(date, F.date_add(F.col(date), F.col("__ahead")))
    return moved.groupBy(place_id, date).agg(F.sum("n").alias("n"))
