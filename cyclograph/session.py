"""Session helpers: time zone, shared work folder, column normalisation."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def use_utc(spark: SparkSession) -> SparkSession:
    """All dates in the model are UTC dates, whatever zone the session was started in."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Without that setting the session's
    warehouse holds one work folder per application, for that is shared storage too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/_work/{spark.sparkContext.applicationId}"


_FOLDERS: list[str] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; ``remove_folders`` deletes it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


def remove_folders(spark: SparkSession, since: int = 0) -> None:
    """Delete the folders handed out, but for the first ``since`` of them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while len(_FOLDERS) > since:
        path = jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        path.getFileSystem(conf).delete(path, True)


@contextlib.contextmanager
def work(spark: SparkSession):
    """Folders made inside belong to the block and are gone after it, so read results before its end."""
    before = len(_FOLDERS)
    try:
        yield
    finally:
        remove_folders(spark, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage in a way that survives executor loss."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock values without a zone, for hand-over to other tools."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
