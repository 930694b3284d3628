"""A corpus pipeline over ``documents``: language, near copies, benchmark passages, mix, shards.

Each stage takes (spark, documents, folder of the tables) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet in the shared folder and hands the stored rows to the next one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclograph.llm import decontamination, jaccard_join, language_id, mixing, sharding
from cyclograph.llm.columns import free_prefix, named
from cyclograph.llm.words import small_batches
from cyclograph.session import materialize

SHARDS = 8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language: its n-grams are as usual there, in the measure
    of the language's own texts. The posterior alone would call any text one of the languages."""
    kept_back = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(docs.filter(~kept_back & F.col("doc_id").isNotNull()))
    rows = docs.select(F.struct("*").alias("row"), "text")
    judged = language_id.predict(rows, model, into=("lang_pred", "score", "typical"))
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("typical") >= language_id.LEAST_TYPICAL)
    return judged.filter(known).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard_join.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontamination.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    prefix = free_prefix(docs)
    own = {c: prefix + c if c.lower() in ("size", *mixing.ADDED) else c for c in docs.columns}
    mixed = mixing.mix(docs.select(*[named(c).alias(name) for c, name in own.items()]).withColumn("size", mixing.count_words("text")))
    repeated = mixed.withColumn(prefix + "copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[named(name).alias(c) for c, name in own.items()])


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their virtual slot and shard."""
    return sharding.with_shard(docs, SHARDS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _in_small_batches(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    (stage.__name__, _in_small_batches(stage)) for stage in (language, near_copies, benchmark_passages, mix, shards)
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
