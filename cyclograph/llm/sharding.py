"""Sharding by fixed virtual slots.

Records are hashed into SLOTS slots once and for all. The bytes of each slot are counted, and a
versioned map says which shard holds which slot; rebalancing edits the map, never the hash.
Everything is DataFrame functions; the fold over the slots runs on at most SLOTS rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cyclograph.llm.columns import others
from cyclograph.session import materialize, new_folder

SLOTS = 4096
TOLERANCE = 0.002
"""A slot stays where it is while its shard holds at most this much more than an even share."""


def slot_of(*keys: str, slots: int = SLOTS) -> Column:
    """Virtual slot of a record."""
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def sized(documents: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, none for null, plus 1), text_crc32 (null for null), virtual_slot.

    The slot comes from doc_id and text, so that rows of one id spread; repeated rows share a slot.
    """
    return documents.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
        slot_of("doc_id", "text").alias("virtual_slot"),
    )


def slot_sizes(records: DataFrame) -> DataFrame:
    """Bytes and rows of each slot that has any."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def assign(sizes: DataFrame, shards: int, old: DataFrame | None = None) -> DataFrame:
    """A slot-to-shard map (virtual_slot, bytes, rows, shard) of near equal bytes.

    The heaviest slot comes first. A slot of the ``old`` map stays in its shard while that has
    room; any other goes to the lightest shard. Without an old map, all slots are dealt out so.
    """
    old = old.select("virtual_slot", F.col("shard").alias("home")) if old is not None else None
    known = sizes.join(F.broadcast(old), "virtual_slot", "left") if old is not None else sizes.withColumn("home", F.lit(None).cast("int"))
    rows = known.agg(
        F.array_sort(
            F.collect_list(F.struct((-F.col("bytes")).alias("order"), "virtual_slot", "bytes", "rows", "home"))
        ).alias("slots"),
        (F.sum("bytes") * (1 + TOLERANCE) / shards).alias("room"),
    )

    def place(state: Column, slot: Column) -> Column:
        loads = state["loads"]
        lightest = (F.array_position(loads, F.array_min(loads)) - 1).cast("int")
        stays = slot["home"].isNotNull() & (F.get(loads, slot["home"]) + slot["bytes"] <= F.col("room"))
        shard = F.when(stays, slot["home"]).otherwise(lightest)
        return F.struct(
            F.transform(loads, lambda load, i: load + F.when(i == shard, slot["bytes"]).otherwise(F.lit(0).cast("bigint"))).alias("loads"),
            F.concat(state["shards"], F.array(shard)).alias("shards"),
        )

    start = F.struct(
        F.array_repeat(F.lit(0).cast("bigint"), shards).alias("loads"), F.array().cast("array<int>").alias("shards")
    )
    placed = rows.select("slots", F.aggregate("slots", start, place, lambda state: state["shards"]).alias("shards"))
    return placed.select(F.explode(F.arrays_zip("slots", "shards")).alias("x")).select(
        "x.slots.virtual_slot", "x.slots.bytes", "x.slots.rows", F.col("x.shards").alias("shard")
    )


def save_map(slot_map: DataFrame, folder: str, version: int) -> DataFrame:
    """Store a map as the given version; an existing version is never overwritten."""
    path = f"{folder}/version={version}"
    slot_map.coalesce(1).write.mode("errorifexists").parquet(path)
    return load_map(slot_map.sparkSession, folder, version)


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, bytes bigint, rows bigint, shard int").parquet(f"{folder}/version={version}")


def locate(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Add the shard of each record and its place in that shard, 0, 1, 2 and so on.

    A shard's records stand in the order of their slots; each slot is numbered in a task of its
    own, starting from the rows of the shard's earlier slots.
    """
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (
        records.withColumn("__nth", F.row_number().over(inside))
        .join(F.broadcast(starts), "virtual_slot")
        .withColumn("slot", F.col("__start") + F.col("__nth") - 1)
        .drop("__start", "__nth")
    )


def shard(documents: DataFrame, shards: int, folder: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, virtual_slot, shard and slot of every row.

    The map is stored as version 1 under ``folder`` (default: a new one in the shared folder). A
    null text is one byte in size and has no crc; rows with a null doc_id are placed by their text;
    an empty table gives an empty map.
    """
    records = materialize(sized(documents), "shard-sizes")
    slot_map = save_map(assign(slot_sizes(records), shards), folder or new_folder(documents.sparkSession, "slot-map"), 1)
    return locate(records, slot_map)


def with_shard(documents: DataFrame, shards: int) -> DataFrame:
    """All rows and columns of ``documents``, with their virtual_slot and shard; columns of these
    names, whatever their case, are replaced."""
    sizes = documents.select(
        slot_of("doc_id", "text").alias("virtual_slot"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
    )
    slot_map = save_map(assign(slot_sizes(sizes), shards), new_folder(documents.sparkSession, "slot-map"), 1)
    kept = others(documents, ("shard", "virtual_slot"))
    placed = documents.select(*kept, slot_of("doc_id", "text").alias("virtual_slot"))
    return placed.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot").select(*kept, "virtual_slot", "shard")
