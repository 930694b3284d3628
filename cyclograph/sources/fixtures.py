"""The domain's landing tables, derived from the generic test tables.

The arithmetic is plain enough to be written identically in SQL (``workload.ctes``).
It plants the defects that the cleaning rules exist for: malformed ids and times,
positions outside the box, half positions, duplicate versions and re-deliveries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclograph.session import use_utc


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def _plus_seconds(moment: str, seconds: str) -> Column:
    return F.expr(f"CAST({moment} + make_dt_interval(0, 0, 0, {seconds}) AS TIMESTAMP)")


def landed_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as trips between 24 stations."""
    orders = table(spark, folder, "orders").withColumn("k", F.col("o_custkey") % 24)
    return orders.select(
        F.expr("CAST(o_orderkey AS STRING)").alias("ride_id"),
        F.expr("CASE WHEN o_orderstatus = 'F' THEN 'electric_bike' ELSE 'classic_bike' END").alias("rideable_type"),
        _plus_seconds("o_orderdate", "o_orderkey * 37 % 86400").alias("started_at"),
        _plus_seconds("o_orderdate", "o_orderkey * 37 % 86400 + 60 + o_orderkey % 5400").alias("ended_at"),
        F.expr(
            "CASE WHEN o_orderkey % 50 <> 0 THEN concat('Station ', k, CASE WHEN o_orderkey % 9 = 0 THEN ' *' ELSE '' END) END"
        ).alias("start_station_name"),
        F.expr("CASE WHEN o_orderkey % 50 <> 0 THEN CAST(k AS STRING) END").alias("start_station_id"),
        F.expr("concat('Station ', (k + 7) % 24)").alias("end_station_name"),
        F.expr("CAST((k + 7) % 24 AS STRING)").alias("end_station_id"),
        F.expr(
            "CASE WHEN o_orderkey % 61 = 0 THEN NULL WHEN o_orderkey % 67 = 0 THEN 0.0D"
            " WHEN o_orderkey % 5 = 0 THEN 41.88D + ((k * 37) % 97) / 2500.0D + 0.0001D"
            " ELSE 41.88D + ((k * 37) % 97) / 2500.0D END"
        ).alias("start_lat"),
        F.expr("CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE -87.65D + ((k * 53) % 89) / 2500.0D END").alias("start_lng"),
        F.expr("41.88D + (((k + 7) % 24 * 37) % 97) / 2500.0D").alias("end_lat"),
        F.expr("-87.65D + (((k + 7) % 24 * 53) % 89) / 2500.0D").alias("end_lng"),
        F.expr("CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'member' ELSE 'casual' END").alias("member_casual"),
        F.date_format("o_orderdate", "yyyyMM").alias("source_month"),
    )


def landed_incidents(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as incident records, several versions per key."""
    lines = table(spark, folder, "lineitem")
    return lines.select(
        F.expr(
            "CASE WHEN l_partkey % 211 = 0 THEN concat('X', l_orderkey * 10 + l_linenumber)"
            " ELSE CAST(l_orderkey * 10 + l_linenumber AS STRING) END"
        ).alias("unique_key"),
        F.expr("concat(lpad(CAST(l_partkey AS STRING), 12, '0'), lpad(CAST(l_suppkey AS STRING), 12, '0'))").alias("case_number"),
        _plus_seconds("l_shipdate", "(l_orderkey * 7919 + l_linenumber * 31) % 86400").alias("date"),
        F.expr("concat(' ', lower(l_returnflag), ' ')").alias("primary_type"),
        F.expr("CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_linestatus END").alias("description"),
        F.expr("CASE WHEN l_suppkey % 2 = 0 THEN 'STREET' ELSE 'PARK' END").alias("location_description"),
        F.expr("l_linenumber % 2 = 0").alias("arrest"),
        F.expr("l_suppkey % 3 = 0").alias("domestic"),
        F.expr("CASE WHEN l_partkey % 89 = 0 THEN 'unknown' ELSE CAST(l_suppkey % 78 AS STRING) END").alias("community_area"),
        F.expr("CAST(l_suppkey % 25 AS STRING)").alias("district"),
        F.expr("CAST(l_partkey % 50 AS STRING)").alias("ward"),
        F.expr(
            "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_partkey % 101 = 0 THEN 45.0D"
            " ELSE 41.88D + ((l_partkey * 7919) % 1000) / 25000.0D END"
        ).alias("latitude"),
        F.expr(
            "CASE WHEN l_linenumber = 7 OR l_partkey % 103 = 0 THEN NULL"
            " ELSE -87.65D + ((l_partkey * 104729 + l_suppkey * 31) % 1000) / 25000.0D END"
        ).alias("longitude"),
        F.year("l_shipdate").cast("bigint").alias("year"),
        F.col("l_shipdate").cast("timestamp").alias("updated_on"),
    )


def incident_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The same records as a raw download: everything a string, plus columns to drop."""
    landed = landed_incidents(spark, folder)
    text = {c: F.col(c).cast("string") for c in landed.columns}
    return landed.withColumns(text).withColumns(
        {
            "location": F.concat("latitude", F.lit(","), "longitude"),
            ":@computed_region_a": F.lit("1"),
            "arrest": F.expr("CASE WHEN ward = '7' THEN 'n/a' ELSE initcap(arrest) END"),
        }
    ).withColumnRenamed("unique_key", "id")


def area_seed(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as areas."""
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("int").alias("community_area_id"), F.col("s_name").alias("community_area_name")
    )


_STATUS_FIELDS = {
    "station_id": "CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(user_id AS STRING) END",
    "num_bikes_available": "CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(floor(value) AS INT) END",
    "num_bikes_disabled": "CAST(event_id % 3 AS INT)",
    "num_docks_available": "CAST(get_json_object(props, '$.k') AS INT)",
    "num_docks_disabled": "CAST(event_id % 2 AS INT)",
    "is_installed": "1",
    "is_renting": "CAST(event_id % 5 <> 0 AS INT)",
    "is_returning": "CAST(event_id % 7 <> 0 AS INT)",
    "last_reported": "unix_seconds(CAST(ts AS TIMESTAMP)) - CASE WHEN event_id % 11 = 0 THEN 7200 ELSE 0 END",
    "legacy_id": "concat('L', user_id)",
    "num_ebikes_available": "CAST(event_id % 13 AS INT)",
    "eightd_has_available_keys": "false",
    "num_scooters_available": "CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 6 AS INT) END",
    "num_scooters_unavailable": "CAST(NULL AS INT)",
}


def status_messages(events: DataFrame) -> DataFrame:
    """Events as topic records: key, JSON value, source coordinates. Works on streams, too."""
    payload = F.struct(*[F.expr(sql).alias(name) for name, sql in _STATUS_FIELDS.items()])
    return events.select(
        F.expr("CAST(user_id AS STRING)").alias("key"),
        F.expr("CASE WHEN event_id % 503 = 0 THEN '{broken' END").alias("broken"),
        F.to_json(payload).alias("json"),
        F.expr("CAST(event_id % 3 AS INT)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ).select(
        "key", F.coalesce("broken", "json").cast("binary").alias("value"), "partition", "offset", "timestamp"
    )


def raw_station_status(spark: SparkSession, folder: str) -> DataFrame:
    """What at-least-once delivery leaves behind: every seventh message arrives twice."""
    events = table(spark, folder, "events")
    fields = [F.expr(sql).alias(name) for name, sql in _STATUS_FIELDS.items()]
    first = events.select(
        *fields,
        F.expr("CAST(event_id % 3 AS INT)").alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
        F.expr("CAST(ts AS TIMESTAMP) + INTERVAL 5 SECONDS").alias("ingest_timestamp"),
    ).withColumn("last_reported", F.timestamp_seconds("last_reported"))
    again = first.filter("kafka_offset % 7 = 0").withColumns(
        {
            "ingest_timestamp": F.expr(
                "CASE WHEN kafka_offset % 21 = 0 THEN NULL ELSE ingest_timestamp + INTERVAL 60 SECONDS END"
            ),
            "num_bikes_disabled": F.lit(99),
        }
    )
    return first.unionByName(again)


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as task runs."""
    return table(spark, folder, "events").select(
        F.expr("concat('job_', user_id % 5)").alias("dag_id"),
        F.expr("concat('task_', user_id % 11)").alias("task_id"),
        F.expr("CAST(event_id AS STRING)").alias("run_id"),
        F.expr("CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END").alias("state"),
        F.col("ts").cast("timestamp").alias("start_date"),
        F.expr("CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, 0, CAST(floor(value) AS INT))").alias("end_date"),
    )
