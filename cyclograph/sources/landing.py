"""Reading what has landed (SRC1-SRC7)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cyclograph.functions.casts import as_column

# Landed trip files and their columns.
# A month's data is a file ``YYYYMM-*``, or a folder of that name (possibly ``key=YYYYMM-*``).
TRIP_FILE_PATTERN = r"(\d{6})-[^/]*(?:/[^/]+)?$"
MONTH_PREFIX = re.compile(r"(?:^|=)(\d{6})-")
TRIP_SCHEMA = (
    "ride_id string, rideable_type string, started_at string, ended_at string,"
    " start_station_name string, start_station_id string, end_station_name string, end_station_id string,"
    " start_lat double, start_lng double, end_lat double, end_lng double, member_casual string"
)
OTHER_TIME_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy H:mm")  # besides ISO
AREA_SCHEMA = "community_area_id int, community_area_name string"

# Incident columns that need coercion on landing.
NUMERIC_COLUMNS = ("latitude", "longitude", "district", "ward", "community_area", "year")
FLAG_COLUMNS = ("arrest", "domestic")
COMPUTED_PREFIX = ":@computed_region"

# One station's entry in the status feed; also the payload of a topic message.
STATION_SCHEMA = T.StructType(
    [
        T.StructField("station_id", T.StringType()),
        T.StructField("num_bikes_available", T.IntegerType()),
        T.StructField("num_bikes_disabled", T.IntegerType()),
        T.StructField("num_docks_available", T.IntegerType()),
        T.StructField("num_docks_disabled", T.IntegerType()),
        T.StructField("is_installed", T.IntegerType()),
        T.StructField("is_renting", T.IntegerType()),
        T.StructField("is_returning", T.IntegerType()),
        T.StructField("last_reported", T.LongType()),
        T.StructField("legacy_id", T.StringType()),
        T.StructField("num_ebikes_available", T.IntegerType()),
        T.StructField("eightd_has_available_keys", T.BooleanType()),
        T.StructField("num_scooters_available", T.IntegerType()),
        T.StructField("num_scooters_unavailable", T.IntegerType()),
    ]
)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def file_month(path: str) -> str | None:
    """``YYYYMM`` from the name of a monthly file or folder, if it has one."""
    found = MONTH_PREFIX.search(path.rstrip("/").rsplit("/", 1)[-1])
    return found.group(1) if found else None


def list_folder(spark: SparkSession, folder: str) -> list[str]:
    """Direct children, through the Hadoop file system the path belongs to."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f.getPath().toString() for f in files)


def select_months(
    paths: list[str], month: str | None = None, first: str | None = None, last: str | None = None
) -> list[str]:
    """Files of one month, of an inclusive range, or of all months, in order.

    Works on names alone, so it doubles as the dry run and keeps other files unread.
    """
    dated = sorted((m, p) for p in paths if (m := file_month(p)))
    if month:
        return [p for m, p in dated if m == month]
    return [p for m, p in dated if (not first or m >= first) and (not last or m <= last)]


def _lenient_time(text: Column) -> Column:
    return F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(p)) for p in OTHER_TIME_FORMATS])


def read_trip_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Monthly CSV files as one table. Unreadable times become NULL; every row carries its month."""
    raw = spark.read.csv(paths, schema=TRIP_SCHEMA, header=True, enforceSchema=False)
    times = {c: _lenient_time(F.col(c)) for c in ("started_at", "ended_at")}
    month = F.regexp_extract(F.col("_metadata.file_path"), TRIP_FILE_PATTERN, 1)
    return raw.withColumn("source_month", month).withColumns(times)


def normalize_incidents(feed: DataFrame) -> DataFrame:
    """Download quirks: drop nested and computed columns, coerce numbers and flags."""
    dropped = [c for c in feed.columns if c == "location" or c.startswith(COMPUTED_PREFIX)]
    kept = feed.drop(*dropped)
    coerced: dict[str, Column] = {
        c: F.col(c).try_cast("double") for c in NUMERIC_COLUMNS if c in kept.columns
    }
    for c in FLAG_COLUMNS:
        if c in kept.columns:
            text = F.lower(F.col(c).cast("string"))
            coerced[c] = F.when(text == "true", True).when(text == "false", False)
    return kept.withColumns(coerced)


def keyed_incidents(incidents: DataFrame) -> DataFrame:
    """Incidents as the model build reads them: cleaned ones call their key ``id``, landed ones ``unique_key``."""
    return incidents if "unique_key" in incidents.columns else incidents.withColumnRenamed("id", "unique_key")


def station_messages(feed: DataFrame, body: Column | str = "value") -> DataFrame:
    """One (key, value) message per station of a feed snapshot; blank ids are skipped.

    The value keeps every field of the entry, known or not: entries stay JSON text.
    """
    envelope = "struct<last_updated: bigint, data: struct<stations: array<string>>>"
    entries = feed.select(F.explode(F.from_json(as_column(body), envelope)["data"]["stations"]).alias("value"))
    keyed = entries.select(F.get_json_object("value", "$.station_id").alias("key"), "value")
    return keyed.filter("key IS NOT NULL AND key <> ''")


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """The seed list of areas."""
    return spark.read.csv(path, schema=AREA_SCHEMA, header=True)
