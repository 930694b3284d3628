"""Jobs for spark-submit.

    clean-incidents SOURCE TARGET [--files N]
    load-trips FOLDER TARGET [--month M | --from M --to M] [--dry-run]
    stream SERVERS TOPIC TARGET CHECKPOINT [--once]
    build INCIDENTS TRIPS AREAS ROOT [--status PATH]
"""

from __future__ import annotations

import argparse
import sys

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from cyclograph.plans import staging
from cyclograph.plans.build import Landed, ModelBuild
from cyclograph.session import use_utc
from cyclograph.sources import landing, sinks
from cyclograph.streaming import station_status as live


def clean_incidents(spark: SparkSession, args) -> int:
    """Clean landed incidents, write them, and compare what was written with what is there."""
    cleaned = staging.clean_incidents(landing.read_parquet(spark, args.source))
    written = sinks.write_files(cleaned, args.target, args.files or None)
    complete = sinks.verify_written(spark, args.target, written)
    print(f"{written} rows written" if complete else f"WARNING: {written} rows written, another number found")
    return 0 if complete else 1


def load_trips(spark: SparkSession, args) -> int:
    """Load monthly files, one job each. A month that is loaded again replaces itself; one that
    can't be read is reported, and the others are loaded all the same."""
    chosen = landing.select_months(landing.list_folder(spark, args.folder), args.month, args.first, args.last)
    if args.dry_run or not chosen:
        print("\n".join(chosen) or "no months match")
        return 0
    failed = 0
    for path in chosen:
        try:
            sinks.replace_partitions(landing.read_trip_files(spark, [path]), args.target, ["source_month"])
            print(f"loaded {path}")
        except (PySparkException, Py4JError) as error:
            failed += 1
            print(f"FAIL {path}: {str(error).splitlines()[0][:200]}")
    return 1 if failed else 0


def stream(spark: SparkSession, args) -> int:
    records = live.topic_source(spark, args.servers, args.topic)
    status = live.drop_stale(live.parse_messages(records))
    query = live.start(status, sinks.BatchAppender(args.target), args.checkpoint, args.once)
    query.awaitTermination()
    return 0


def build(spark: SparkSession, args) -> int:
    """Build the model and run its contracts; fails if a contract fails."""
    landed = Landed(
        landing.keyed_incidents(landing.read_parquet(spark, args.incidents)),
        landing.read_parquet(spark, args.trips),
        landing.read_areas(spark, args.areas),
        landing.read_parquet(spark, args.status) if args.status else None,
    )
    model = ModelBuild(spark, args.root, args.first_year, args.trained_before)
    model.run(landed)
    failed = [r for r in model.check().collect() if r["status"] == "fail"]  # one row per check
    for row in failed:
        print(f"FAIL {row['test_name']}: {row['failures']}")
    return 1 if failed else 0


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="cyclograph", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = root.add_subparsers(dest="job", required=True)

    def job(name, run, *positional):
        sub = jobs.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        sub.set_defaults(run=run)
        return sub

    job("clean-incidents", clean_incidents, "source", "target").add_argument(
        "--files", type=int, default=0, help="number of files; 0 lets Spark decide"
    )
    trips = job("load-trips", load_trips, "folder", "target")
    trips.add_argument("--month")
    trips.add_argument("--from", dest="first")
    trips.add_argument("--to", dest="last")
    trips.add_argument("--dry-run", action="store_true")
    job("stream", stream, "servers", "topic", "target", "checkpoint").add_argument("--once", action="store_true")
    model = job("build", build, "incidents", "trips", "areas", "root")
    model.add_argument("--status")
    model.add_argument("--first-year", type=int, default=staging.FIRST_YEAR)
    model.add_argument("--trained-before", default="2024-01-01")
    return root


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    spark = use_utc(SparkSession.builder.appName(f"cyclograph-{args.job}").getOrCreate())
    return args.run(spark, args)


if __name__ == "__main__":
    sys.exit(main())
