"""Queries on landing, cleaning, staging and sinks (SRC*, SNK*, PRJ*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.functions.casts import guarded_cast
from cyclograph.operators.dedup import keep_first, upsert
from cyclograph.plans import marts, staging
from cyclograph.session import new_folder
from cyclograph.sources import fixtures, landing, sinks
from cyclograph.sources.versions import VersionedTable
from cyclograph.workload.registry import Domain, register


@register(
    "src1_parquet_scan",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'",
)
def parquet_scan(d: Domain) -> DataFrame:
    lines = landing.read_parquet(d.spark, f"{d.folder}/lineitem.parquet")
    return lines.filter("l_quantity > 45 AND l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")


@register(
    "src2_src3_monthly_trip_files",
    """SELECT ride_id, CASE WHEN CAST(ride_id AS BIGINT) % 83 <> 0 THEN started_at END AS started_at, ended_at,
  start_station_id, start_lat, end_lng, member_casual, source_month
FROM landed_trips WHERE source_month BETWEEN '199601' AND '199712'""",
)
def monthly_trip_files(d: Domain) -> DataFrame:
    """Trips written as one CSV folder per month, then two years of them read back."""
    folder = new_folder(d.spark, "trip-files")
    clock = "yyyy-MM-dd HH:mm:ss"
    text = d.landed_trips.withColumns(
        {
            "started_at": F.when(F.expr("CAST(ride_id AS BIGINT) % 83 <> 0"), F.date_format("started_at", clock)).otherwise("soon"),
            "ended_at": F.date_format("ended_at", clock),
            "month": F.concat("source_month", F.lit("-trips")),
        }
    ).drop("source_month")
    text.hint("rebalance", F.col("month")).write.partitionBy("month").csv(folder, header=True)
    wanted = landing.select_months(landing.list_folder(d.spark, folder), first="199601", last="199712")
    return landing.read_trip_files(d.spark, wanted).select(
        "ride_id", "started_at", "ended_at", "start_station_id", "start_lat", "end_lng", "member_casual", "source_month"
    )


@register(
    "src4_incident_landing",
    """SELECT unique_key AS id, case_number, latitude, longitude, try_cast(district AS DOUBLE) AS district,
  try_cast(ward AS DOUBLE) AS ward, try_cast(community_area AS DOUBLE) AS community_area, CAST(year AS DOUBLE) AS year,
  CASE WHEN ward <> '7' THEN arrest END AS arrest, domestic
FROM landed_incidents""",
)
def incident_landing(d: Domain) -> DataFrame:
    return landing.normalize_incidents(fixtures.incident_feed(d.spark, d.folder)).select(
        "id", "case_number", *landing.NUMERIC_COLUMNS, *landing.FLAG_COLUMNS
    )


@register(
    "src5_station_messages",
    """SELECT CAST(user_id AS VARCHAR) AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS docks, event_id
FROM events WHERE event_id % 19 <> 0""",
)
def feed_messages(d: Domain) -> DataFrame:
    """Feed snapshots of up to ten stations, exploded to one message per station."""
    entry = F.struct(
        F.expr("CASE WHEN event_id % 19 <> 0 THEN CAST(user_id AS STRING) ELSE '' END").alias("station_id"),
        F.expr("CAST(get_json_object(props, '$.k') AS BIGINT)").alias("docks"),
        F.col("event_id"),
    )
    stations = F.struct(F.collect_list(entry).alias("stations")).alias("data")
    snapshots = (
        d.table("events")
        .groupBy(F.expr("event_id DIV 10").alias("snapshot"))
        .agg(F.max("event_id").alias("last_updated"), stations)
        .select(F.to_json(F.struct("last_updated", "data")).alias("value"))
    )
    message = landing.station_messages(snapshots)
    return message.select(
        "key",
        F.get_json_object("value", "$.docks").cast("bigint").alias("docks"),
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
    )


@register("src7_prj11_areas", "SELECT community_area_id, community_area_name FROM areas")
def area_list(d: Domain) -> DataFrame:
    folder = new_folder(d.spark, "areas")
    fixtures.area_seed(d.spark, d.folder).write.csv(folder, header=True)
    return marts.areas(landing.read_areas(d.spark, folder))


@register(
    "prj1_guarded_cast",
    """SELECT community_area, try_cast(community_area AS BIGINT) AS as_int, try_cast(case_number AS DOUBLE) AS as_double,
  try_cast(concat('2020-01-', district) AS DATE) AS as_date, count(*) AS n FROM landed_incidents GROUP BY ALL""",
)
def casts(d: Domain) -> DataFrame:
    typed = d.landed_incidents.select(
        "community_area",
        guarded_cast("community_area", "int").alias("as_int"),
        guarded_cast("case_number", "double").alias("as_double"),
        guarded_cast(F.concat(F.lit("2020-01-"), "district"), "date").alias("as_date"),
    )
    return typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("n"))


@register("prj2_clean_incidents", "SELECT * FROM clean_incidents")
def clean(d: Domain) -> DataFrame:
    landed = d.landed_incidents.withColumnRenamed("unique_key", "id")
    return staging.clean_incidents(landed).select(
        "id", "date", "primary_type", "description", "community_area", "latitude", "longitude", "updated_on"
    )


@register("prj3_staged_incidents", "SELECT * FROM staged_incidents")
def staged_incidents(d: Domain) -> DataFrame:
    return d.staged_incidents


@register(
    "prj4_wn1_latest_per_key",
    """SELECT user_id, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_key(d: Domain) -> DataFrame:
    rows = d.table("events").select("user_id", "event_id", "ts", "value")
    return keep_first(rows, ["user_id"], [F.desc("ts"), F.desc("event_id")])


@register("prj5_staged_trips", "SELECT * FROM staged_trips")
def staged_trips(d: Domain) -> DataFrame:
    return d.staged_trips


@register("prj6_staged_status", "SELECT * FROM staged_status")
def staged_status(d: Domain) -> DataFrame:
    return staging.stage_station_status(d.raw_status)


@register("prj7_incident_facts", "SELECT * FROM incidents")
def incident_facts(d: Domain) -> DataFrame:
    return d.incidents


@register("prj8_trip_facts", "SELECT * FROM trips")
def trip_facts(d: Domain) -> DataFrame:
    return d.trips


@register("prj9_station_read_facts", "SELECT * FROM reads")
def station_reads(d: Domain) -> DataFrame:
    return d.reads


@register(
    "prj10_st5_incident_types",
    """SELECT DISTINCT primary_type || '|' || description AS crime_type_key, primary_type, description
FROM staged_incidents WHERE primary_type IS NOT NULL AND description IS NOT NULL""",
)
def incident_types(d: Domain) -> DataFrame:
    return marts.incident_types(d.staged_incidents)


@register(
    "prj12_out_of_bounds",
    """SELECT unique_key AS crime_id, latitude, longitude, date AS occurred_at FROM landed_incidents
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND (latitude NOT BETWEEN 41.64 AND 42.03 OR longitude NOT BETWEEN -87.95 AND -87.52)""",
)
def out_of_bounds(d: Domain) -> DataFrame:
    renamed = d.landed_incidents.withColumnsRenamed({"unique_key": "crime_id", "date": "occurred_at"})
    return marts.out_of_bounds(renamed)


@register(
    "snk1_snk2_verified_write",
    """SELECT year(date) AS year, count(*) AS n, count(latitude) AS located, true AS complete
FROM clean_incidents GROUP BY ALL""",
    ints="year",
)
def verified_write(d: Domain) -> DataFrame:
    path = new_folder(d.spark, "clean-incidents")
    cleaned = staging.clean_incidents(d.landed_incidents.withColumnRenamed("unique_key", "id"))
    written = sinks.write_files(cleaned, path)
    complete = sinks.verify_written(d.spark, path, written)
    return d.spark.read.parquet(path).groupBy(F.year("date").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("latitude").alias("located"), F.lit(complete).alias("complete")
    )


@register(
    "snk4_test_results",
    """SELECT CAST(user_id AS VARCHAR) AS invocation_id, date_trunc('second', ts) AS generated_at,
  concat('unique_', event_type, '.', event_id) AS test_name, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'pass' END AS status,
  CAST(event_id % 4 AS INT) AS failures, value AS execution_time FROM events""",
)
def recorded_results(d: Domain) -> DataFrame:
    """Every event is a run-result document with one test and one model in it."""
    documents = d.table("events").select(
        F.expr(
            """to_json(named_struct(
                'metadata', named_struct('invocation_id', CAST(user_id AS STRING),
                                         'generated_at', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
                'results', array(
                    named_struct('unique_id', concat('test.shop.unique_', event_type, '.', event_id, '.ab12'),
                                 'status', CASE WHEN event_type = 'error' THEN 'fail' ELSE 'pass' END,
                                 'failures', CAST(event_id % 4 AS INT), 'execution_time', value),
                    named_struct('unique_id', concat('model.shop.', event_type),
                                 'status', 'success', 'failures', 0, 'execution_time', 1.0D))))"""
        ).alias("value")
    )
    return sinks.test_results(documents).drop("recorded_at")


@register(
    "snk5_partitioned_mart",
    """SELECT date_key, start_station_id, count(*) AS n, CAST(sum(trip_duration_seconds) AS BIGINT) AS seconds
FROM trips WHERE date_key BETWEEN DATE '1997-03-10' AND DATE '1998-06-20' GROUP BY ALL""",
)
def partitioned_mart(d: Domain) -> DataFrame:
    """Written by month, sorted by day; read back from one day to another."""
    path = new_folder(d.spark, "trips-by-month")
    sinks.write_by_month(d.trips, path, "date_key", ["start_station_id"])
    written = sinks.read_by_month(d.spark, path, d.trips.schema, "date_key", "1997-03-10", "1998-06-20")
    return written.groupBy("date_key", "start_station_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("trip_duration_seconds").alias("seconds")
    )


@register(
    "snk4_recorded_twice",
    """SELECT CAST(user_id AS VARCHAR) AS invocation_id, event_id, value FROM events
WHERE user_id % 5 <> 0 OR (user_id % 10 = 0 AND event_id % 2 = 0)""",
)
def recorded_twice(d: Domain) -> DataFrame:
    """Results recorded, then some invocations again with fewer rows and some with none."""
    path = new_folder(d.spark, "results")
    rows = d.table("events").select(F.col("user_id").cast("string").alias("invocation_id"), "event_id", "value", "ts")
    number = F.col("invocation_id").cast("long")
    sinks.record_results(rows, path, day="ts")
    again = rows.filter((number % 10 == 0) & (F.col("event_id") % 2 == 0))
    ids = rows.filter(number % 5 == 0).select("invocation_id").distinct()
    sinks.record_results(again, path, ids, day="ts")
    return sinks.results_table(d.spark, path).read().select("invocation_id", "event_id", "value")


@register(
    "snk6_upsert_partitions",
    """SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 0 THEN 'X'
  ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM orders
UNION ALL SELECT -o_orderkey - 1, o_orderpriority, 'N', o_orderdate FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderkey % 7 = 0""",
)
def upserted_partitions(d: Domain) -> DataFrame:
    """A stored table by priority, two of whose partitions take changes."""
    path = new_folder(d.spark, "orders-by-priority")
    current = d.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    table = VersionedTable(d.spark, path, ["o_orderpriority"])
    table.overwrite(current)
    changed = current.filter("o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("X"))
    fresh = current.filter("o_orderpriority = '2-HIGH' AND o_orderkey % 7 = 0").withColumns(
        {"o_orderkey": -F.col("o_orderkey") - 1, "o_orderstatus": F.lit("N")}
    )
    keys = ["o_orderkey", "o_orderpriority"]
    sinks.upsert_partitions(d.spark, path, changed.unionByName(fresh), keys, "o_orderdate", "o_orderpriority")
    return table.read().select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_orderdate")


@register(
    "snk6_upsert",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS o_orderdate FROM orders
UNION ALL SELECT -o_orderkey - 1, 'N', o_orderdate FROM orders WHERE o_orderkey % 7 = 0""",
)
def upserted(d: Domain) -> DataFrame:
    current = d.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    newer = current.filter("o_orderkey % 5 = 0").withColumns(
        {"o_orderstatus": F.lit("X"), "o_orderdate": F.expr("o_orderdate + INTERVAL 1 DAY")}
    )
    older = current.filter("o_orderkey % 5 = 1").withColumns(
        {"o_orderstatus": F.lit("OLD"), "o_orderdate": F.expr("o_orderdate - INTERVAL 1 DAY")}
    )
    fresh = current.filter("o_orderkey % 7 = 0").withColumns(
        {"o_orderkey": -F.col("o_orderkey") - 1, "o_orderstatus": F.lit("N")}
    )
    changes = newer.unionByName(older).unionByName(fresh)
    return upsert(current, changes, ["o_orderkey"], "o_orderdate")
