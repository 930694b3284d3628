"""Live station status (STR1-STR8)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cyclograph.sources.landing import STATION_SCHEMA
from cyclograph.sources.sinks import arrived_rows

TRIGGER_INTERVAL = "60 seconds"
STALE_AFTER_SECONDS = 3600
FLAGS = ("is_installed", "is_renting", "is_returning")


def topic_source(spark: SparkSession, servers: str, topic: str, records_per_batch: int | None = None) -> DataFrame:
    """Topic records from the earliest offset. Needs the Kafka connector on the class path.

    Limit the records per batch when a large backlog has to be drained.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
    )
    if records_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", records_per_batch)
    return reader.load()


def file_source(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Landed Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def parse_messages(records: DataFrame, ingested: Column | None = None) -> DataFrame:
    """Topic records to typed rows with their source coordinates. Broken JSON yields NULLs."""
    parsed = records.select(
        F.from_json(F.col("value").cast("string"), STATION_SCHEMA).alias("s"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    typed = {
        **{flag: F.col(f"s.{flag}").cast("boolean") for flag in FLAGS},
        "last_reported": F.timestamp_seconds("s.last_reported"),
    }
    fields = [typed.get(f.name, F.col(f"s.{f.name}")).alias(f.name) for f in STATION_SCHEMA.fields]
    now = F.current_timestamp() if ingested is None else ingested
    return parsed.select(
        *fields, "kafka_partition", "kafka_offset", "kafka_timestamp", now.alias("ingest_timestamp")
    )


def drop_stale(status: DataFrame, now: Column | None = None, seconds: int = STALE_AFTER_SECONDS) -> DataFrame:
    """Stateless late-data rule: the report must be younger than ``seconds``."""
    current = F.current_timestamp() if now is None else now
    oldest = current - F.make_dt_interval(secs=F.lit(seconds))
    return status.filter(F.col("last_reported").isNotNull() & (F.col("last_reported") > oldest))


def once_per_message(status: DataFrame, delay: str = "1 hour", event_time: str = "last_reported") -> DataFrame:
    """Streaming counterpart of the staging rule: at-least-once delivery made exact.

    State is dropped once the watermark has passed, so it is bounded by the delay.
    """
    return status.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["kafka_partition", "kafka_offset"])


def start(
    status: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    once: bool = False,
    interval: str = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Append micro-batches through ``sink``; ``once`` drains what is there and stops.

    The checkpoint folder keeps the offsets: a restart continues where the last one ended.
    """
    writer = status.writeStream.foreachBatch(sink).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def has_new_data(spark: SparkSession, path: str, before: int) -> bool:
    """Whether rows came to the sink at ``path`` since it had ``before`` (of ``arrived_rows``).

    Rows that a batch read and dropped don't count. Any process may ask, also after a restart.
    """
    return arrived_rows(spark, path) > before
