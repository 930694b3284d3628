"""Great-circle distance (SF11) and the grid that turns it into an equi-join."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_010.0
QUARTER_MILE_M = 402.0
_MARGIN = 1.01  # cells and windows are 1 % larger than needed, so rounding cannot lose a pair
_SURE_RADIUS_M, _SURE_LATITUDE = 10_000.0, 80.0


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance in metres on a sphere."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lng = F.sin(F.radians(lng2 - lng1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


class Grid:
    """Latitude bands at least ``radius_m`` high, each cut into equal longitude cells.

    A circle of ``radius_m`` touches at most its own band and the two beside it; in
    each of them it covers a short run of cells. Longitude wraps at the date line, and
    the cell count of a band shrinks towards the poles, so the scheme is valid anywhere.
    With ``parts`` the bands are that many times lower, and cells smaller in proportion.
    """

    def __init__(self, radius_m: float, parts: int = 1):
        self.radius_m, self.angle = radius_m, radius_m / EARTH_RADIUS_M
        self.reach = math.degrees(self.angle) * _MARGIN
        self.height = self.reach / parts

    def band(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.height)

    def cells_in(self, band: Column) -> Column:
        """Number of cells in a band, from the band edge that lies farther from the equator."""
        low = band * F.lit(self.height) - 90
        edge = F.least(F.lit(90.0), F.greatest(F.abs(low), F.abs(low + self.height)))
        return F.greatest(F.lit(1), F.floor(F.cos(F.radians(edge)) * 360 / self.height))

    def _index(self, lng: Column, cells: Column) -> Column:
        return F.floor((lng + 180) / 360 * cells)

    def cell(self, lng: Column, band: Column) -> Column:
        cells = self.cells_in(band)
        return F.pmod(self._index(lng, cells), cells)

    def neighbour_bands(self, lat: Column) -> Column:
        band = self.band(lat)
        return F.array(band - 1, band, band + 1)

    def bands_touched(self, lat: Column) -> Column:
        """Array of the bands that a circle around a place can reach."""
        return F.sequence(self.band(lat - self.reach), self.band(lat + self.reach))

    def relation(self, lat: Column, lng: Column, band: Column, cell: Column) -> Column:
        """``inside`` if the cell lies wholly in the circle around (lat, lng), ``outside`` if it lies
        wholly out of it, else ``rim``. In doubt it is ``rim``: for wide circles and near the poles."""
        south = band * F.lit(self.height) - 90
        north = south + self.height
        width = F.lit(360.0) / self.cells_in(band)
        west = cell * width - 180
        corners = [haversine_m(lat, lng, y, x) for y in (south, north) for x in (west, west + width)]
        ahead = F.pmod(lng - west, F.lit(360.0))
        beside = F.when(ahead <= width, F.lit(0.0)).otherwise(F.least(ahead - width, 360 - ahead))
        nearest = haversine_m(lat, F.lit(0.0), F.greatest(south, F.least(north, lat)), beside)
        # A parallel isn't a shortest way, so these distances are off by a share that stays below the margins here.
        sure = (F.abs(lat) <= _SURE_LATITUDE) & F.lit(self.radius_m <= _SURE_RADIUS_M)
        inside = F.greatest(*corners) * _MARGIN <= self.radius_m
        return F.when(sure & inside, "inside").when(sure & (nearest > self.radius_m * _MARGIN), "outside").otherwise("rim")

    def cells_touched(self, lat: Column, lng: Column, band: Column) -> Column:
        """Array of the cells of ``band`` that a circle around (lat, lng) can reach."""
        ratio = F.lit(math.sin(self.angle)) / F.cos(F.radians(lat))
        near_pole = F.radians(F.abs(lat)) + self.angle >= math.pi / 2
        half = F.when(near_pole, F.lit(180.0)).otherwise(
            F.degrees(F.asin(F.least(F.lit(1.0), ratio))) * _MARGIN
        )
        cells = self.cells_in(band)
        first, last = self._index(lng - half, cells), self._index(lng + half, cells)
        # A run as long as the band or longer is the whole band, each cell once.
        last = F.least(last, first + cells - 1)
        return F.transform(F.sequence(first, last), lambda i: F.pmod(i, cells))
