"""Streaming queries (SRC6, SNK3, STR*): drained once, then read back from the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclograph.plans import staging
from cyclograph.session import new_folder
from cyclograph.sources import fixtures, sinks
from cyclograph.streaming import station_status as live
from cyclograph.workload.registry import Domain, register

PARSED = """SELECT CASE WHEN event_id % 503 <> 0 THEN s.station_id END AS station_id,
  CASE WHEN event_id % 503 <> 0 THEN s.num_bikes_available END AS num_bikes_available,
  CASE WHEN event_id % 503 <> 0 THEN s.num_docks_available END AS num_docks_available,
  CASE WHEN event_id % 503 <> 0 THEN s.is_renting END AS is_renting,
  CASE WHEN event_id % 503 <> 0 THEN s.num_scooters_available END AS num_scooters_available,
  CASE WHEN event_id % 503 <> 0 THEN s.reported_at END AS reported_at,
  s.kafka_partition, s.kafka_offset, s.kafka_timestamp
FROM events e JOIN first_status s ON e.event_id = s.kafka_offset"""

SHOWN = [
    "station_id",
    "num_bikes_available",
    "num_docks_available",
    "is_renting",
    "num_scooters_available",
    "reported_at",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
]


def _records(d: Domain) -> DataFrame:
    """Events as a stream of topic records. The pattern matches a file or a folder of files."""
    events = live.file_source(d.spark, f"{d.folder}/events.parque[t]", d.table("events").schema)
    return fixtures.status_messages(events)


def _drain(status: DataFrame, base: str) -> None:
    """Run the stream to its end."""
    live.start(status, sinks.BatchAppender(f"{base}/table"), f"{base}/offsets", once=True).awaitTermination()


def _drained(d: Domain, status: DataFrame, label: str) -> DataFrame:
    """Run the stream to its end; give back what the sink holds."""
    base = new_folder(d.spark, label)
    _drain(status, base)
    return _stored(d, f"{base}/table")


def _stored(d: Domain, path: str) -> DataFrame:
    return sinks.status_table(d.spark, path).read().drop("day", "batch_id")


@register("str1_src6_parse_messages", PARSED)
def parsed(d: Domain) -> DataFrame:
    rows = _drained(d, live.parse_messages(_records(d)), "status-parsed")
    return rows.withColumnRenamed("last_reported", "reported_at").select(*SHOWN)


@register(
    "str2_str6_fresh_status",
    f"""SELECT * FROM ({PARSED}) AS p
WHERE reported_at > kafka_timestamp - INTERVAL 3600 SECOND""",
)
def fresh(d: Domain) -> DataFrame:
    """The whole ingest: parse, drop stale reports, append, stage. Arrival time stands in
    for the clock, so that the outcome does not depend on today."""
    status = live.drop_stale(live.parse_messages(_records(d)), now=F.col("kafka_timestamp"))
    return staging.stage_station_status(_drained(d, status, "status-fresh")).select(*SHOWN)


@register(
    "str7_once_per_message",
    f"""SELECT * FROM ({PARSED}) AS p
WHERE reported_at > kafka_timestamp - INTERVAL 3600 SECOND""",
)
def deduplicated(d: Domain) -> DataFrame:
    """Every message is delivered twice; the watermark keeps the state bounded."""
    twice = _records(d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    status = live.drop_stale(live.parse_messages(twice), now=F.col("kafka_timestamp"))
    rows = _drained(d, live.once_per_message(status), "status-once")
    return rows.withColumnRenamed("last_reported", "reported_at").select(*SHOWN)


@register("snk3_str4_replayed_and_compacted", PARSED)
def replayed(d: Domain) -> DataFrame:
    """Two runs of a stream, the second after a restart; its last batch delivered again; then
    all days but the last compacted and old versions removed: each message is there once."""
    base = new_folder(d.spark, "status-replayed")
    messages = fixtures.status_messages(d.table("events"))
    for rows in _halves(messages):
        rows.write.mode("append").parquet(f"{base}/in")
        _drain(live.parse_messages(live.file_source(d.spark, f"{base}/in", messages.schema)), base)
    sinks.BatchAppender(f"{base}/table")(live.parse_messages(rows), 1)
    last = messages.agg(F.max(F.to_date("timestamp")).cast("string")).first()[0]
    sinks.compact(d.spark, f"{base}/table", last)
    sinks.status_table(d.spark, f"{base}/table").vacuum(1)
    return _stored(d, f"{base}/table").withColumnRenamed("last_reported", "reported_at").select(*SHOWN)


def _halves(messages: DataFrame) -> list[DataFrame]:
    return [messages.filter("offset % 2 = 0"), messages.filter("offset % 2 <> 0")]


@register(
    "str8_new_data_probe",
    """WITH fresh AS (SELECT e.event_id % 2 AS half FROM events e JOIN first_status s ON e.event_id = s.kafka_offset
  WHERE e.event_id % 503 <> 0 AND s.reported_at > s.kafka_timestamp - INTERVAL 3600 SECOND)
SELECT run, arrived, arrived > lag(arrived, 1, 0) OVER (ORDER BY run) AS has_new_data FROM (
  SELECT 1 AS run, count_if(half = 0) AS arrived FROM fresh
  UNION ALL SELECT 2, count_if(half = 0) FROM fresh
  UNION ALL SELECT 3, count(*) FROM fresh
  UNION ALL SELECT 4, count(*) FROM fresh)""",
    ints="run",
)
def probe(d: Domain) -> DataFrame:
    """Four runs of the ingest, each asked about afterwards as a new process would: the even
    messages; nothing; the odd ones; only messages so late that none is kept."""
    base = new_folder(d.spark, "status-probed")
    messages = fixtures.status_messages(d.table("events"))
    even, odd = _halves(messages)
    parts = [even, None, odd, messages]
    found, before = [], 0
    for run, rows in enumerate(parts, 1):
        if run == len(parts):
            rows = rows.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 10 YEARS"))
        if rows is not None:
            rows.write.mode("append").parquet(f"{base}/in")
        status = live.parse_messages(live.file_source(d.spark, f"{base}/in", messages.schema))
        _drain(live.drop_stale(status, now=F.col("kafka_timestamp")), base)
        arrived = sinks.arrived_rows(d.spark, f"{base}/table")
        found.append((run, arrived, live.has_new_data(d.spark, f"{base}/table", before)))
        before = arrived
    return d.spark.createDataFrame(found, "run int, arrived bigint, has_new_data boolean")
