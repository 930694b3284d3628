"""Tables whose readers follow a pointer: a partition is either old or new, never missing.

A write puts its rows into new folders, ``<partition>/table_version=<token>``, which nobody reads yet.
A small manifest then names the folders that make up the table, and replaces the one before in
a single rename that fails if another writer was first. Whatever is cut short before that rename
leaves the table as it was. The manifests are the commit ledger too: each says how many rows the
table holds and which batch brought them, so that any process can ask what is new.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEDGER = "_versions"
VERSION = "table_version"
KEPT_VERSIONS = 2
"""Manifests whose folders ``vacuum`` leaves, so that running readers end in peace."""


class LostRace(RuntimeError):
    """Another writer has made this version."""


@dataclass(frozen=True)
class Manifest:
    """``parts``: each live folder and the tag of the write that made it; ``written``: the rows that
    each of those writes brought."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)
    written: dict[str, int] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Staged:
    """Rows that lie beside a table and aren't part of it yet."""

    tag: str
    folders: list[str]
    rows: int


def partition_of(folder: str) -> str:
    """``day=2024-05-01`` of ``day=2024-05-01/table_version=ab12``."""
    return folder.rpartition("/")[0]


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partitions: Sequence[str] = ()):
        self.spark, self.path, self.partitions = spark, path.rstrip("/"), list(partitions)
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._fs.Path(f"{self.path}/{name}" if name else self.path)

    # --- the ledger ----------------------------------------------------------------

    def _numbers(self) -> list[int]:
        folder = self._at(LEDGER)
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def _load(self, number: int) -> Manifest:
        stream = self._files.open(self._at(f"{LEDGER}/{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(number, **json.loads(text))

    def current(self) -> Manifest:
        """The latest manifest; an empty one, number 0, for a table that was never written."""
        numbers = self._numbers()
        return self._load(numbers[-1]) if numbers else Manifest()

    def history(self) -> list[Manifest]:
        return [self._load(n) for n in self._numbers()]

    def _publish(self, manifest: Manifest) -> Manifest:
        text = json.dumps({"parts": manifest.parts, "written": manifest.written, "notes": manifest.notes})
        aside, place = self._at(f"{LEDGER}/.{uuid.uuid4().hex}"), self._at(f"{LEDGER}/{manifest.number:012d}.json")
        stream = self._files.create(aside, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        context = self._fs.FileContext.getFileContext(place.toUri(), self._conf)
        rename = getattr(self._fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(context.makeQualified(aside), context.makeQualified(place), options)
        except Exception as error:
            self._files.delete(aside, False)
            if self._files.exists(place):
                raise LostRace(f"{self.path}: version {manifest.number} is another writer's") from error
            raise
        return manifest

    # --- writing -------------------------------------------------------------------

    def stage(self, df: DataFrame, tag: str, cluster: Sequence[str] = (), placed: bool = False) -> Staged:
        """Write rows beside the table. Few files a partition; sorted by ``cluster`` inside each.

        ``placed``: the rows already lie by partition, as those read from such a table do, so they
        aren't shuffled once more.
        """
        token = uuid.uuid4().hex[:16]
        counted = Observation()
        rows = df.observe(counted, F.count(F.lit(1)).alias("rows")).withColumn(VERSION, F.lit(token))
        if not placed:
            rows = rows.hint("rebalance", *[F.col(p) for p in self.partitions])
        if self.partitions or cluster:
            rows = rows.sortWithinPartitions(*self.partitions, *cluster)
        rows.write.mode("append").partitionBy(*self.partitions, VERSION).parquet(self.path)
        pattern = "/".join([*["*"] * len(self.partitions), f"{VERSION}={token}"])
        found = self._files.globStatus(self._at(pattern)) or []
        root = self._files.makeQualified(self._at("")).toUri().getPath().rstrip("/") + "/"
        folders = sorted(s.getPath().toUri().getPath().removeprefix(root) for s in found)
        # A plan that is empty from the start reports no count.
        return Staged(tag, folders, counted.get["rows"] if folders else 0)

    def commit(self, base: Manifest, kept: dict[str, str], *staged: Staged, notes: dict | None = None) -> Manifest:
        """From now on the table consists of the folders ``kept`` and the ``staged`` ones, unless
        another writer came after ``base``: then LostRace is raised."""
        parts = kept | {f: s.tag for s in staged for f in s.folders}
        rows = base.written | {s.tag: s.rows for s in staged}
        live = set(parts.values())
        written = {t: n for t, n in rows.items() if t in live}
        return self._publish(Manifest(base.number + 1, parts, written, base.notes | (notes or {})))

    def append(self, df: DataFrame, tag: str, cluster: Sequence[str] = (), notes: dict | None = None) -> Manifest:
        """Add rows; those that an earlier write of the same tag brought give way to them."""
        base = self.current()
        kept = {f: t for f, t in base.parts.items() if t != tag}
        return self.commit(base, kept, self.stage(df, tag, cluster), notes=described(df) | (notes or {}))

    def overwrite(
        self, df: DataFrame, cluster: Sequence[str] = (), notes: dict | None = None, placed: bool = False
    ) -> Manifest:
        """The rows become the whole table."""
        base = self.current()
        staged = self.stage(df, f"write {base.number + 1}", cluster, placed)
        return self.commit(base, {}, staged, notes=described(df) | (notes or {}))

    def replace(
        self,
        df: DataFrame,
        emptied: Iterable[str] = (),
        cluster: Sequence[str] = (),
        notes: dict | None = None,
        base: Manifest | None = None,
        placed: bool = False,
    ) -> Manifest:
        """The partitions that occur in ``df`` become its rows; those named in ``emptied`` go.

        A partition is named by its folder, such as ``day=2024-05-01``. Rows made from what the
        table held give the manifest they were read by as ``base``: if another writer came in
        between, LostRace is raised instead of losing that writer's rows.
        """
        base = base or self.current()
        staged = self.stage(df, f"write {base.number + 1}", cluster, placed)
        gone = {partition_of(f) for f in staged.folders} | set(emptied)
        kept = {f: t for f, t in base.parts.items() if partition_of(f) not in gone}
        return self.commit(base, kept, staged, notes=described(df) | (notes or {}))

    def note(self, **notes) -> Manifest:
        """A commit that changes nothing but the notes."""
        base = self.current()
        return self.commit(base, base.parts, notes=notes)

    # --- reading -------------------------------------------------------------------

    def read(self, manifest: Manifest | None = None) -> DataFrame:
        """The table as one manifest has it, by default the latest. Later writes don't change the rows."""
        manifest = manifest or self.current()
        if "schema" not in manifest.notes:
            raise ValueError(f"{self.path} was never written")
        schema = T.StructType.fromJson(manifest.notes["schema"])
        if not manifest.parts:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())])
        reader = self.spark.read.schema(stored).option("basePath", self.path)
        rows = reader.parquet(*[f"{self.path}/{f}" for f in manifest.parts])
        return rows.select(*[F.col(f"`{f.name}`") for f in schema.fields])

    # --- cleaning ------------------------------------------------------------------

    def vacuum(self, keep: int = KEPT_VERSIONS) -> list[str]:
        """Delete the folders that only older manifests name, then those manifests; returns the folders.

        Folders of writes under way, which no manifest names, stay.
        """
        manifests = self.history()
        old, kept = manifests[:-keep], manifests[-keep:]
        live = {f for m in kept for f in m.parts}
        dead = sorted({f for m in old for f in m.parts} - live)
        for folder in dead:
            self._files.delete(self._at(folder), True)
        for manifest in old:
            self._files.delete(self._at(f"{LEDGER}/{manifest.number:012d}.json"), False)
        return dead


def described(df: DataFrame) -> dict:
    """What a reader must know of the rows."""
    return {"schema": json.loads(df.schema.json())}
