"""Building the whole model: tables that don't wait for each other run at once, and a later run
rewrites only the months whose inputs changed.

Every table is a ``VersionedTable``: readers see it before or after a build, never in between.
Dated tables have a folder for each month. A ledger beside them holds a digest of the rows of each
landed month, so that the next run knows which months to look at. Layers are folders: staged
incidents are written, because three tables need their de-duplicated rows; staged trips and station
status remain views. ``mart`` holds the tables and ``observability`` the outcomes of the checks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclograph.functions.casts import guarded_cast
from cyclograph.operators import regression as reg
from cyclograph.operators.correlation import scoped_correlation
from cyclograph.plans import contracts, marts, staging
from cyclograph.plans.calendar_tables import bounds_of, project_dates
from cyclograph.quality import suite
from cyclograph.session import materialize, use_utc
from cyclograph.sources import sinks
from cyclograph.sources.versions import VersionedTable

# The model learns from the days before this one.
TRAINED_BEFORE = "2024-01-01"

MONTH = "table_month"
UNDATED = "__HIVE_DEFAULT_PARTITION__"
JOBS_AT_ONCE = 8
DIGESTS = "digests"


@dataclass
class Landed:
    """Raw tables; station status is optional because it arrives by stream."""

    incidents: DataFrame
    trips: DataFrame
    areas: DataFrame
    station_status: DataFrame | None = None


def in_dependency_order(steps: dict[str, tuple[Sequence[str], Callable[[], object]]], at_once: int = JOBS_AT_ONCE) -> None:
    """Run each step once the steps that it names are done; independent ones run at the same time.

    The first failure is raised, after the steps already running have ended.
    """
    order = TopologicalSorter({name: set(needs) & steps.keys() for name, (needs, _) in steps.items()})
    order.prepare()
    with ThreadPoolExecutor(at_once) as pool:
        running = {}
        while order.is_active():
            for name in order.get_ready():
                running[pool.submit(steps[name][1])] = name
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(done)
                done.result()
                order.done(name)


def month_digests(rows: DataFrame, moment) -> dict[str, str]:
    """A digest of the rows of each month, in any order; one entry a month."""
    value = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])
    parts = rows.select(month_name(moment).alias("month"), value.alias("v")).groupBy("month")
    # Count, parity of every bit, and a sum that equal rows don't cancel from.
    found = parts.agg(F.count("*"), F.bit_xor("v"), F.sum(F.col("v").bitwiseAND(F.lit((1 << 28) - 1)))).collect()
    return {r[0]: f"{r[1]}:{r[2]}:{r[3]}" for r in found}


def month_name(moment):
    return F.coalesce(sinks.month_of(moment), F.lit(UNDATED))


def changed_months(before: dict[str, str], now: dict[str, str]) -> set[str]:
    return {m for m in before.keys() | now.keys() if before.get(m) != now.get(m)}


class ModelBuild:
    """``rebuilt``: for each table of the last run the months that were written, or None for all of it.
    Tables that aren't named there stayed as they were."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        first_year: int = staging.FIRST_YEAR,
        trained_before: str = TRAINED_BEFORE,
    ):
        self.spark = use_utc(spark)
        self.root = root.rstrip("/")
        self.first_year, self.trained_before = first_year, trained_before
        self.tables: dict[str, DataFrame] = {}
        self.rebuilt: dict[str, set[str] | None] = {}
        self._dated: dict[tuple[str, str], DataFrame] = {}

    def path(self, name: str, layer: str = "mart") -> str:
        return f"{self.root}/{layer}/{name}"

    def table(self, name: str, dated: bool = True, layer: str = "mart") -> VersionedTable:
        return VersionedTable(self.spark, self.path(name, layer), [MONTH] if dated else [])

    def days(self, name: str, first=None, last=None, day: str = "date_key") -> DataFrame:
        """Rows of a stored table from one day to another, reading their months only."""
        rows = self.table(name).read()
        if first is not None:
            start = F.lit(first).cast("date")
            rows = rows.filter((F.col(MONTH) >= sinks.month_of(start)) & (F.col(day) >= start))
        if last is not None:
            end = F.lit(last).cast("date")
            rows = rows.filter((F.col(MONTH) <= sinks.month_of(end)) & (F.col(day) < F.date_add(end, 1)))
        return rows.drop(MONTH)

    # --- storing -------------------------------------------------------------------

    def _whole(self, name: str, df: DataFrame, layer: str = "mart") -> None:
        table = self.table(name, False, layer)
        table.overwrite(df)
        self.rebuilt[name] = None
        self.tables[name] = table.read()

    def _months(
        self,
        name: str,
        df: DataFrame,
        day: str,
        cluster: tuple[str, ...],
        months: set[str] | None,
        layer: str = "mart",
        placed: bool = False,
    ) -> None:
        """Write the rows of the given months, or of all; months without rows any more go.

        ``placed``: the rows come from a table with the same months, so they lie by month already.
        """
        table = self.table(name, layer=layer)
        rows = df.withColumn(MONTH, sinks.month_of(day))
        if months is None:
            table.overwrite(rows, (day, *cluster), placed=placed)
        elif months:
            wanted = rows.filter(month_name(day).isin(sorted(months)))
            table.replace(wanted, [f"{MONTH}={m}" for m in months], (day, *cluster), placed=placed)
        if months is None or months:
            self.rebuilt[name if layer == "mart" else f"{layer}/{name}"] = months
        self._dated[layer, name] = table.read()
        if layer == "mart":
            self.tables[name] = self._stored(name)

    def _stored(self, name: str, months: set[str] | None = None, layer: str = "mart") -> DataFrame:
        """A dated table, or the given months of it; other folders aren't opened."""
        rows = self._dated[layer, name]
        if months is not None:
            rows = rows.filter(F.coalesce(MONTH, F.lit(UNDATED)).isin(sorted(months)))
        return rows.drop(MONTH)

    def _again(self, name: str, build: Callable[[], DataFrame], because: bool) -> None:
        """A table without months: built anew if something that it is made of changed."""
        if because:
            self._whole(name, build())
        else:
            self.tables[name] = self.table(name, False).read()

    # --- what changed --------------------------------------------------------------

    def _digests(self, landed: Landed) -> dict[str, Callable[[], dict[str, str]]]:
        """How to find the digests of each input's months."""
        moments = {
            "incidents": (landed.incidents, guarded_cast("date", "timestamp")),
            "trips": (landed.trips, guarded_cast("started_at", "timestamp")),
            "areas": (landed.areas, F.lit(None).cast("timestamp")),
            "station_status": (landed.station_status, F.col("last_reported").cast("timestamp")),
        }
        return {name: lambda rows=rows, moment=moment: month_digests(rows, moment) for name, (rows, moment) in moments.items() if rows is not None}

    def _ledger(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/ledger")

    def _rules(self) -> list:
        return [self.first_year, self.trained_before]

    def _staged_incidents(self, landed: DataFrame, months: set[str] | None) -> set[str] | None:
        """Bring the staged incidents up to date; returns the months whose rows are others now.

        A key's newest version may lie in another month than the rest. So all versions are read of
        the keys that a changed month holds now, or of which it held the survivor; survivors that
        differ from the stored ones name the months.
        """
        table = self.table("incidents", layer="staging")
        rows = lambda df: staging.stage_incidents(df, self.first_year)
        if months is None:
            self._months("incidents", rows(landed), "occurred_at", (), None, "staging")
            return None
        base = table.current()
        self._dated["staging", "incidents"] = stored = table.read(base)
        if not months:
            return set()
        changed = sorted(months)
        now = landed.filter(month_name(guarded_cast("date", "timestamp")).isin(changed)).select(guarded_cast("unique_key", "bigint").alias("k"))
        then = stored.filter(F.coalesce(MONTH, F.lit(UNDATED)).isin(changed)).select(F.col("crime_id").alias("k"))
        keys = materialize(now.unionAll(then).distinct(), "changed-keys")
        raw = landed.withColumn("__key", guarded_cast("unique_key", "bigint"))
        new = rows(raw.join(keys, F.col("__key").eqNullSafe(F.col("k")), "left_semi").drop("__key")).withColumn(MONTH, sinks.month_of("occurred_at"))
        old = stored.join(keys, F.col("crime_id").eqNullSafe(F.col("k")), "left_semi")
        new = materialize(new.select(*old.columns), "changed-incidents")
        marked = new.withColumn("n", F.lit(1)).unionAll(old.withColumn("n", F.lit(-1)))
        differing = marked.groupBy(*old.columns).agg(F.sum("n").alias("n")).filter("n <> 0")
        touched = {r[0] for r in differing.select(F.coalesce(MONTH, F.lit(UNDATED))).distinct().collect()}  # one a month
        if touched:
            here = F.coalesce(MONTH, F.lit(UNDATED)).isin(sorted(touched))
            kept = stored.filter(here).join(keys, F.col("crime_id").eqNullSafe(F.col("k")), "left_anti")
            emptied = [f"{MONTH}={m}" for m in touched]
            table.replace(kept.unionAll(new.filter(here)), emptied, ("occurred_at",), base=base)
            self.rebuilt["staging/incidents"] = touched
            self._dated["staging", "incidents"] = table.read()
        return touched

    # --- the build -----------------------------------------------------------------

    def run(self, landed: Landed) -> dict[str, DataFrame]:
        """Bring all tables up to date."""
        self.tables, self.rebuilt = {}, {}
        find, ledger = self._digests(landed), self._ledger()
        notes, digests = ledger.current().notes, {}
        before = notes.get(DIGESTS, {}) if notes.get("rules") == self._rules() and not notes.get("building") else {}
        ledger.note(building=True)

        def digest(name: str) -> Callable[[], None]:
            return lambda: digests.update({name: find[name]()})

        if before.keys() == find.keys():
            in_dependency_order({name: ((), digest(name)) for name in find})
            changed = {name: changed_months(before[name], digests[name]) for name in find}
        else:  # a first run, one with other inputs or rules, or the last one was cut short: all of it
            changed = dict.fromkeys(find)
        staged_trips = staging.stage_trips(landed.trips)
        state: dict[str, set[str] | None] = {}

        def anything(*names: str) -> bool:
            return any(state.get(n, changed.get(n)) is None or state.get(n, changed.get(n)) for n in names)

        def incidents(months: set[str] | None = None) -> DataFrame:
            return self._stored("incidents", months, "staging")

        def stage() -> None:
            state["staged"] = self._staged_incidents(landed.incidents, changed["incidents"])

        def incident_facts() -> None:
            self._months("incidents", marts.incident_facts(incidents(state["staged"])), "date_key", ("community_area_id",), state["staged"], placed=True)

        def trip_facts() -> None:
            self._months("trips", marts.trip_facts(staged_trips), "date_key", ("start_station_id",), changed["trips"])

        def stations() -> None:
            before = self.table("stations", False).current()
            self._again("stations", lambda: marts.stations(self.tables["trips"]), anything("trips"))
            moved = "schema" not in before.notes or not self._same(self.table("stations", False).read(before), self.tables["stations"])
            trips, near = changed["trips"], state["staged"]
            state["station_day"] = None if moved or trips is None or near is None else trips | near

        def station_day() -> None:
            months = state["station_day"]
            mart = marts.station_day(self._stored("trips", months), self.tables["stations"], self._stored("incidents", months))
            self._months("station_day", mart, "date_key", ("station_id",), months)

        def dates() -> None:
            moments = ((incidents(), "occurred_at"), (self.tables["trips"], "started_at"))
            self._again("dates", lambda: project_dates(bounds_of(*moments)), anything("staged", "trips"))

        def training() -> None:
            build = lambda: reg.training_rows(self.tables["station_day"], before=self.trained_before)
            self._again("training", build, anything("station_day"))

        def regression() -> None:
            if not anything("station_day"):
                for name in ("weights", "evaluation", "predictions"):
                    self.tables[name] = self.table(name, False).read()
                return
            rows = self.tables["training"]
            chosen = reg.in_training_split("station_id", "date_key")
            model = reg.fit(rows.filter(chosen))
            later = reg.training_rows(self.tables["station_day"], since=self.trained_before)
            results = {
                "weights": lambda: model.weight_rows(),
                "evaluation": lambda: reg.evaluate(model.predict(rows.filter(~chosen))),
                "predictions": lambda: model.predict(later),
            }
            in_dependency_order({n: ((), lambda n=n, make=make: self._whole(n, make())) for n, make in results.items()})

        steps: dict[str, tuple[Iterable[str], Callable[[], object]]] = {
            "staged": ((), stage),
            "trips": ((), trip_facts),
            "areas": ((), lambda: self._again("areas", lambda: marts.areas(landed.areas), anything("areas"))),
            "incidents": (("staged",), incident_facts),
            "incident_types": (("staged",), lambda: self._again("incident_types", lambda: marts.incident_types(incidents()), anything("staged"))),
            "dates": (("staged", "trips"), dates),
            "stations": (("staged", "trips"), stations),
            "station_day": (("incidents", "trips", "stations"), station_day),
            "correlation": (("station_day",), lambda: self._again("correlation", lambda: scoped_correlation(self.tables["station_day"]), anything("station_day"))),
            "training": (("station_day",), training),
            "regression": (("training",), regression),
        }
        if landed.station_status is not None:
            reads = marts.station_read_facts(staging.stage_station_status(landed.station_status))
            steps["station_reads"] = ((), lambda: self._months("station_reads", reads, "date_key", ("station_id",), changed["station_status"]))
        if not digests:  # only the next run needs them: beside the steps that leave cores free
            steps |= {f"digest of {name}": (("station_day",), digest(name)) for name in find}
        in_dependency_order(steps)
        ledger.note(**{DIGESTS: digests, "rules": self._rules(), "building": False})
        return self.tables

    @staticmethod
    def _same(a: DataFrame, b: DataFrame) -> bool:
        return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()

    def check(self, calendar_years: tuple[int, int] = contracts.CALENDAR_YEARS) -> DataFrame:
        """Run the contracts of all tables at once and keep their outcomes under a new invocation id."""
        found: dict[str, DataFrame] = {}

        def run(name: str, checks: list) -> Callable[[], None]:
            return lambda: found.update({name: suite.run(self.tables[name], checks)})

        checks = contracts.checks(self.tables, calendar_years)
        in_dependency_order({name: ((), run(name, table_checks)) for name, table_checks in checks.items()})
        outcomes = None
        for name in checks:
            outcomes = found[name] if outcomes is None else outcomes.unionByName(found[name])
        now = F.current_timestamp()
        results = outcomes.select(
            F.lit(str(uuid.uuid4())).alias("invocation_id"),
            now.alias("generated_at"),
            "test_name",
            "status",
            F.col("failures").cast("int"),
            "execution_time",
            now.alias("recorded_at"),
        )
        sinks.record_results(results, self.path("test_results", "observability"))
        return results
