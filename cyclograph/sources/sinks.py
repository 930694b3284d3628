"""Writing tables (SNK1-SNK6)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cyclograph.operators.dedup import upsert
from cyclograph.sources.versions import Manifest, VersionedTable, described, partition_of


def write_files(df: DataFrame, path: str, files: int | None = None) -> int:
    """Overwrite ``path``; returns the number of rows, observed while writing.

    The adaptive rebalance settles the number of files, unless ``files`` asks for one.
    """
    counted = Observation()
    observed = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    sized = observed.hint("rebalance") if files is None else observed.repartition(files)
    sized.write.mode("overwrite").parquet(path)
    return counted.get["rows"]


def verify_written(spark: SparkSession, path: str, expected: int) -> bool:
    """Row counts come from the Parquet footers."""
    return spark.read.parquet(path).count() == expected


def write_partitioned(df: DataFrame, path: str, partition: str, cluster: Sequence[str] = ()) -> None:
    """Partition directories with rows clustered inside each file.

    Rebalancing by the partition column gives few files per directory, and the adaptive
    planner splits a partition that holds an outsized share of the rows.
    """
    ready = df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)
    ready.write.mode("overwrite").partitionBy(partition).parquet(path)


def month_of(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def write_by_month(df: DataFrame, path: str, day: str, cluster: Sequence[str] = ()) -> None:
    """Month folders whose files are sorted by day, for tables that are read by day.

    A month has few files, whatever the number of days, and the statistics of their row groups
    let a reader skip the other days. ``day`` is a date or a timestamp.
    """
    column = f"{day}_month"
    ready = df.withColumn(column, month_of(day)).hint("rebalance", F.col(column)).sortWithinPartitions(column, day, *cluster)
    ready.write.mode("overwrite").partitionBy(column).parquet(path)


def read_by_month(spark: SparkSession, path: str, schema, day: str, first=None, last=None) -> DataFrame:
    """A table written by ``write_by_month``, whole or from day ``first`` to day ``last`` inclusive.

    The range is put on the months too, so that other folders aren't opened.
    """
    column = f"{day}_month"
    rows = spark.read.schema(schema.add(column, "string") if column not in schema.names else schema).parquet(path)
    if first is not None:
        start = F.lit(first).cast("date")
        rows = rows.filter((F.col(column) >= month_of(start)) & (F.col(day) >= start))
    if last is not None:
        end = F.lit(last).cast("date")
        rows = rows.filter((F.col(column) <= month_of(end)) & (F.col(day) < F.date_add(end, 1)))
    return rows.drop(column)


def replace_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Overwrite exactly the partitions that occur in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


COMPACTED = -1
_ARRIVED = "arrived"


def status_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, ["day", "batch_id"])


class BatchAppender:
    """``foreachBatch`` target: a folder for each day, and in it one for each micro-batch.

    The day comes from the rows (column ``moment``). A batch is one commit, tagged with its
    number, so a replayed batch takes its own earlier rows' place. An empty batch changes nothing.
    The ledger beside the folders counts the rows that arrived; ``arrived_rows`` reads it from any
    process. ``compact`` later turns each finished day into a few files.
    """

    def __init__(self, path: str, moment: str = "kafka_timestamp"):
        self.path, self.moment = path, moment

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        table, tag = status_table(batch.sparkSession, self.path), f"batch {batch_id}"
        placed = batch.withColumns({"day": F.to_date(self.moment), "batch_id": F.lit(batch_id).cast("bigint")})
        base = table.current()
        staged = table.stage(placed, tag)
        kept = {f: t for f, t in base.parts.items() if t != tag}
        arrived = base.notes.get(_ARRIVED, 0) + staged.rows - base.written.get(tag, 0)
        table.commit(base, kept, staged, notes=described(placed) | {_ARRIVED: arrived})


def arrived_rows(spark: SparkSession, path: str) -> int:
    """Rows that micro-batches have brought to the sink so far; replays don't count again. Only the
    ledger is read, so this holds for every process, and after restarts and compactions."""
    return status_table(spark, path).current().notes.get(_ARRIVED, 0)


def compact(spark: SparkSession, path: str, before: str) -> list[str]:
    """Merge the batches of each day earlier than ``before``; returns the days merged.

    No batch that could still be replayed may hold rows of such a day. The merged rows are written
    beside the table in one job and come in by one commit: a reader sees a day's old folders or
    its new one. A run that was cut short has changed nothing; ``VersionedTable.vacuum`` deletes
    what no recent version names.
    """
    table = status_table(spark, path)
    base = table.current()
    days: dict[str, set[str]] = {}
    for folder in base.parts:
        days.setdefault(folder.partition("/")[0], set()).add(partition_of(folder))
    merged = sorted(d for d, p in days.items() if d.removeprefix("day=") < before and p != {f"{d}/batch_id={COMPACTED}"})
    if merged:
        old = {f: t for f, t in base.parts.items() if f.partition("/")[0] in merged}
        rows = table.read(replace(base, parts=old)).withColumn("batch_id", F.lit(COMPACTED).cast("bigint"))
        staged = table.stage(rows, f"compacted {base.number + 1}")
        table.commit(base, {f: t for f, t in base.parts.items() if f not in old}, staged)
    return [day.removeprefix("day=") for day in merged]


RESULTS_JSON = (
    "struct<metadata: struct<invocation_id: string, generated_at: string>,"
    " results: array<struct<unique_id: string, status: string, failures: int, execution_time: double>>>"
)


def test_results(documents: DataFrame, body: str = "value", recorded_at: Column | None = None) -> DataFrame:
    """Test outcomes from run-result documents. Only ids ``test.<project>.<name...>.<hash>``
    count; shorter ids are kept as they are."""
    parsed = documents.select(F.from_json(body, RESULTS_JSON).alias("run")).filter(
        "run.metadata.invocation_id IS NOT NULL AND run.metadata.generated_at IS NOT NULL"
    )
    rows = parsed.select("run.metadata.*", F.inline("run.results")).filter("unique_id LIKE 'test.%'")
    parts = F.split("unique_id", r"\.")
    name = F.when(
        F.size(parts) > 3, F.array_join(F.slice(parts, F.lit(3), F.size(parts) - 3), ".")
    ).otherwise(F.col("unique_id"))
    return rows.select(
        "invocation_id",
        F.col("generated_at").try_cast("timestamp").alias("generated_at"),
        name.alias("test_name"),
        "status",
        "failures",
        "execution_time",
        (F.current_timestamp() if recorded_at is None else recorded_at).alias("recorded_at"),
    )


def results_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, ["recorded_day"])


def record_results(
    results: DataFrame, path: str, invocations: DataFrame | None = None, day: Column | str = "recorded_at"
) -> None:
    """Re-recording an invocation replaces its earlier rows. An invocation of ``invocations`` (a
    table of ids) that has no rows any more loses its earlier ones too.

    One folder for each load day. Earlier rows are found by a join; only the days that hold some
    are rewritten, and old and new rows change places in one commit.
    """
    table = results_table(results.sparkSession, path)
    base = table.current()
    placed = results.withColumn("recorded_day", F.to_date(day))
    staged = [table.stage(placed, f"recorded {base.number + 1}", ["invocation_id"])]
    notes, kept = described(placed), base.parts
    if kept:
        new = Manifest(0, dict.fromkeys(staged[0].folders, ""), notes=notes)
        ids = table.read(new).select("invocation_id")
        ids = (ids if invocations is None else ids.unionByName(invocations.select("invocation_id"))).distinct()
        old = table.read(base)
        touched = old.join(ids, "invocation_id", "left_semi").select("recorded_day").distinct()
        days = {f"recorded_day={'__HIVE_DEFAULT_PARTITION__' if r[0] is None else r[0]}" for r in touched.collect()}  # one a load day
        stale = {f: t for f, t in kept.items() if partition_of(f) in days}
        if stale:
            stays = table.read(replace(base, parts=stale)).join(ids, "invocation_id", "left_anti").select(*old.columns)
            staged.append(table.stage(stays, f"kept {base.number + 1}", ["invocation_id"]))
            kept = {f: t for f, t in kept.items() if f not in stale}
    table.commit(base, kept, *staged, notes=notes)


def upsert_partitions(
    spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], version: str, partition: str
) -> None:
    """Merge ``changes`` into a ``VersionedTable`` by ``partition``, rewriting only the partitions they touch.

    The merged partitions are written beside the old ones, which readers see until the commit and
    which a broken run leaves as they were. The partition column must be one of the keys: a row
    can then never move to another partition, and no partition ever becomes empty.
    """
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    table = VersionedTable(spark, path, [partition])
    base = table.current()
    current = table.read(base)
    touched = changes.select(partition).distinct()
    affected = current.join(touched, partition, "left_semi").select(*current.columns)
    merged = upsert(affected, changes.select(*current.columns), keys, version)
    table.replace(merged, base=base)
