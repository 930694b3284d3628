"""Registration and the frames most queries start from."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclograph.plans import marts, staging
from cyclograph.session import use_utc, zoneless
from cyclograph.sources import fixtures
from cyclograph.workload import ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# The test data ends before the years the model was made for.
FIRST_YEAR = 1996
SPLIT_DATE = "2000-01-01"


class Domain:
    """The layered model over one data folder; nothing is computed until used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = use_utc(spark), folder

    def table(self, name: str) -> DataFrame:
        return fixtures.table(self.spark, self.folder, name)

    @cached_property
    def landed_trips(self) -> DataFrame:
        return fixtures.landed_trips(self.spark, self.folder)

    @cached_property
    def landed_incidents(self) -> DataFrame:
        return fixtures.landed_incidents(self.spark, self.folder)

    @cached_property
    def raw_status(self) -> DataFrame:
        return fixtures.raw_station_status(self.spark, self.folder)

    @cached_property
    def staged_trips(self) -> DataFrame:
        return staging.stage_trips(self.landed_trips)

    @cached_property
    def staged_incidents(self) -> DataFrame:
        return staging.stage_incidents(self.landed_incidents, FIRST_YEAR)

    @cached_property
    def trips(self) -> DataFrame:
        return marts.trip_facts(self.staged_trips)

    @cached_property
    def incidents(self) -> DataFrame:
        return marts.incident_facts(self.staged_incidents)

    @cached_property
    def reads(self) -> DataFrame:
        return marts.station_read_facts(staging.stage_station_status(self.raw_status))

    @cached_property
    def stations(self) -> DataFrame:
        return marts.stations(self.staged_trips)

    @cached_property
    def areas(self) -> DataFrame:
        return marts.areas(fixtures.area_seed(self.spark, self.folder))

    @cached_property
    def station_day(self) -> DataFrame:
        return marts.station_day(self.trips, self.stations, self.incidents)

    def latest(self, df: DataFrame, column: str) -> Column:
        """Maximum of a timestamp column, as a literal: the data's own 'now'."""
        return F.lit(df.agg(F.max(F.col(column).cast("timestamp")).cast("string")).first()[0]).cast("timestamp")


def register(name: str, sql: str | None = None, ints: str = ""):
    """Add a query. ``sql`` may start from the shared table expressions in ``ctes``.

    ``ints`` names columns that are 32-bit in Spark but 64-bit in the SQL engine.
    """

    def wrap(build: Callable[[Domain], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: zoneless(build(Domain(spark, folder)))
        if sql is not None:
            SQL[name] = ctes.expand(sql)
            if ints:
                casts = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in ints.split())
                SQL[name] = f"SELECT * REPLACE ({casts}) FROM ({SQL[name]})"
        return build

    return wrap


def rounded(column: Column | str, digits: int = 6) -> Column:
    """Sums of doubles depend on the order of addition; compare them rounded (and without -0)."""
    return F.round(column, digits) + F.lit(0.0)
