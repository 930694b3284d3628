"""URL rules as a sorted digest array.

The rules become one file: 64-bit xxhash keys in order, then the rules' own strings, and before
them the keys of the rules' hosts, each with the lengths of the paths that its rules have. Executors
get the file through Spark's file distribution and map it into memory. The hosts of a batch of URLs
are probed by binary search over the mapped host keys, then the paths under known hosts over the
rules' keys, and every hit is confirmed by its stored string. Mapping reads no rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cyclograph.llm.columns import free_name, named, others
from cyclograph.session import new_folder

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
MAX_FILE_BYTES = 1 << 30
"""An index above this size is refused: every executor holds a copy."""
_SLICE = 8 << 20
"""Bytes that the driver hands to the file at once."""


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1), CAPITALS, SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


def index_bytes(rules: Iterable[tuple[str, str]], key=_key) -> bytes:
    """The index of (rule, verdict) pairs. A rule given twice with both verdicts blocks."""
    verdicts: dict[str, str] = {}
    for rule, verdict in rules:
        if "/" not in rule or verdict not in (ALLOW, BLOCK):
            raise ValueError(f"not a rule: {rule!r} {verdict!r}")
        verdicts[rule] = BLOCK if BLOCK in (verdict, verdicts.get(rule)) else ALLOW
    order = sorted(verdicts, key=lambda r: (key(r), r))
    strings = [r.encode() for r in order]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.uint64)
    keys = np.array([key(r) for r in order], np.uint64)
    blocked = np.array([verdicts[r] == BLOCK for r in order], np.uint8)
    of_host: dict[int, set[int]] = {}
    labels = set()
    for rule in verdicts:
        host = rule.partition("/")[0]
        of_host.setdefault(key(host), set()).add(len(rule) - len(host))
        labels.add(host.count(".") + 1)
    hosts = sorted(of_host)
    lengths = [sorted(of_host[h]) for h in hosts]
    ends = np.cumsum([0, *map(len, lengths)])
    numbers = [
        np.array([len(order), len(hosts), ends[-1], len(labels)]),
        np.array(sorted(labels)),
        np.array(hosts, np.uint64),
        ends,
        np.array([n for some in lengths for n in some]),
        keys,
        offsets,
    ]
    return b"".join(a.astype(np.uint64).tobytes() for a in numbers) + blocked.tobytes() + b"".join(strings)


class Hit(NamedTuple):
    rule: str
    verdict: str


class DigestArray:
    """A mapped index file."""

    def __init__(self, path: str, key=_key):
        data = np.memmap(path, np.uint8, "r")
        n, n_hosts, n_lengths, n_labels = data[:32].view(np.uint64).tolist()
        self.key, at = key, 32

        def part(size: int) -> np.ndarray:
            nonlocal at
            at += 8 * size
            return data[at - 8 * size : at].view(np.uint64)

        self.labels = part(n_labels).tolist()
        self.hosts, self.ends, self.lengths = part(n_hosts), part(n_hosts + 1), part(n_lengths)
        self.keys, self.offsets = part(n), part(n + 1)
        self.blocked, self.strings = data[at : at + n], data[at + n :]

    def rule(self, i: int) -> str:
        return self.strings[int(self.offsets[i]) : int(self.offsets[i + 1])].tobytes().decode()

    def _keys_of(self, texts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.key, texts), np.uint64, len(texts))

    def known_hosts(self, hosts: list[str]) -> dict[str, list[tuple[str, list[int]]]]:
        """Of each host that rules may fit: its suffixes that rules have, with the lengths of those
        rules' paths. Hosts whose keys collide share their lengths, which the strings put right."""
        suffixes, owners = [], []
        for host in dict.fromkeys(hosts):
            parts = host.rsplit(".", self.labels[-1])
            for n in self.labels:
                if n <= len(parts):
                    suffixes.append(".".join(parts[-n:]))
                    owners.append(host)
        wanted = self._keys_of(suffixes)
        at = np.minimum(np.searchsorted(self.hosts, wanted), len(self.hosts) - 1)
        known: dict[str, list[tuple[str, list[int]]]] = {}
        for j in np.flatnonzero(self.hosts[at] == wanted).tolist():
            lengths = self.lengths[int(self.ends[at[j]]) : int(self.ends[at[j] + 1])].tolist()
            known.setdefault(owners[j], []).append((suffixes[j], lengths))
        return known

    def longest(self, hosts: list[str], paths: list[str]) -> list[Hit | None]:
        """The longest rule that fits each URL; among equally long ones the first in order."""
        known = self.known_hosts(hosts) if self.labels else {}
        texts, owners = [], []
        for i, (host, path) in enumerate(zip(hosts, paths)):
            for suffix, lengths in known.get(host, ()):
                for n in lengths:
                    if n <= len(path):
                        texts.append(suffix + path[:n])
                        owners.append(i)
        best: list[Hit | None] = [None] * len(hosts)
        if not texts:
            return best
        wanted = self._keys_of(texts)
        left, right = np.searchsorted(self.keys, wanted), np.searchsorted(self.keys, wanted, "right")
        for j in np.flatnonzero(right > left):
            for i in range(left[j], right[j]):
                if (rule := self.rule(i)) == texts[j]:
                    old = best[owners[j]]
                    if old is None or (-len(rule), rule) < (-len(old.rule), old.rule):
                        best[owners[j]] = Hit(rule, BLOCK if self.blocked[i] else ALLOW)
        return best


def publish(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> str:
    """Write the index once to the shared folder and offer it to the executors; its file name.

    The file goes with the other work folders (``session.remove_folders``).
    """
    data = index_bytes(rules)
    if len(data) > MAX_FILE_BYTES:
        raise ValueError("the rules exceed MAX_FILE_BYTES")
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{new_folder(spark, 'url-rules')}/{name}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = files.create(path)
    try:
        for at in range(0, len(data), _SLICE):
            stream.write(data[at : at + _SLICE])
    finally:
        stream.close()
    spark.sparkContext.addFile(files.makeQualified(path).toString())
    return name


_MAPPED: dict[str, DigestArray] = {}


def _mapped(path: str) -> DigestArray:
    if path not in _MAPPED:
        _MAPPED[path] = DigestArray(path)
    return _MAPPED[path]


def judge(df: DataFrame, rules: Iterable[tuple[str, str]], url: str = "url", otherwise: str = ALLOW) -> DataFrame:
    """Add host, path, rule and verdict to every row.

    A rule (host and start of the path, like ``net/`` or ``example.net/en/``) fits its host and
    all subdomains; the longest one decides. Without one, rule is null and the verdict is
    ``otherwise``. A null URL or one without ``://`` has an empty host and path, so no rule fits.
    All rows stay, as do other columns not named like the new ones in any case.
    """
    name = publish(df.sparkSession, rules)

    @arrow_udf("struct<rule: string, verdict: string>")
    def found(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        hits = _mapped(SparkFiles.get(name)).longest(hosts.to_pylist(), paths.to_pylist())
        return pa.array(
            [{"rule": h and h.rule, "verdict": h.verdict if h else otherwise} for h in hits],
            pa.struct([("rule", pa.string()), ("verdict", pa.string())]),
        )

    new = ("host", "path", "rule", "verdict")
    kept, hit = others(df, new), free_name(df, "hit")
    parts = df.select(*kept, host_of(named(url)).alias("host"), path_of(named(url)).alias("path"))
    return parts.withColumn(hit, found("host", "path")).select(
        *kept, "host", "path", *[named(hit)[name].alias(name) for name in ("rule", "verdict")]
    )
