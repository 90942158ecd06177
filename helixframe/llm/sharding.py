"""Sharding by size-tiered compaction, in DataFrame functions only.

A store is a folder of immutable Parquet shards and a chain of manifests.  Arrivals are
appended as runs of small shards.  Compaction puts runs into tiers by size (each tier
``fanout`` times the one before) and merges ``fanout`` runs of a tier into one run of
shards of about the target size, until no tier has that many runs below the target.
Every change is one new manifest: a JSON file written aside and moved to its versioned
name, which fails if another writer has taken that version, so readers see either the
old or the new set of shards.  Replaced shards stay readable until ``vacuum``.

The driver handles shards' names and sizes only; merging reads whole small shards into
few tasks without a shuffle.

Defined results for unusual input: nulls, empty and long texts and repeated rows are
stored as they are; an empty arrival adds no run; a store without runs reads as an empty
table; batches are told apart by a column that is not stored, with a name that no
other column has (a null batch is one).
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helixframe.runtime import fresh


class Conflict(Exception):
    """Another writer committed this version first."""


@dataclass(frozen=True)
class Run:
    """Shards that were written together."""

    name: str
    files: tuple[tuple[str, int], ...]

    @property
    def bytes(self) -> int:
        return sum(n for _, n in self.files)


class ShardStore:
    """Shards with one schema under ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _list(self, name: str) -> list:
        where = self._path(name)
        return list(self._fs.listStatus(where)) if self._fs.exists(where) else []

    # Manifests

    def version(self) -> int:
        """The newest committed version; 0 where nothing is committed."""
        names = [x.getPath().getName() for x in self._list("manifest")]
        return max((int(x[1:-5]) for x in names if x.startswith("v") and x.endswith(".json")), default=0)

    def runs(self, version: int | None = None) -> list[Run]:
        version = self.version() if version is None else version
        if not version:
            return []
        stream = self._fs.open(self._path(f"manifest/v{version:08d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Run(x["name"], tuple(map(tuple, x["files"]))) for x in json.loads(text)["runs"]]

    def commit(self, runs: list[Run], after: int) -> int:
        """Make ``runs`` version ``after`` + 1; Conflict if that version exists."""
        self._fs.mkdirs(self._path("manifest"))
        aside, final = self._path(f"manifest/.{uuid.uuid4().hex}"), self._path(f"manifest/v{after + 1:08d}.json")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps({"version": after + 1, "runs": [{"name": r.name, "files": r.files} for r in runs]}).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        plain = self.spark.sparkContext._gateway.new_array(getattr(self._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(aside, final, plain)
        except Exception as e:
            self._fs.delete(aside, False)
            if self._fs.exists(final):
                raise Conflict(f"version {after + 1} exists") from e
            raise
        return after + 1

    # Arrivals

    def append(self, arrivals: DataFrame, batch: Column | None = None) -> list[int]:
        """Store ``arrivals`` as one run for each value of ``batch``, each committed as its own version."""
        base = f"data/{uuid.uuid4().hex}"
        name = fresh(arrivals, "batch")
        arrivals.select("*", (F.lit(0) if batch is None else batch).alias(name)).write.partitionBy(name).parquet(f"{self.root}/{base}")
        done = []
        for part in sorted(x.getPath().getName() for x in self._list(base) if x.isDirectory()):
            if run := self._run(f"{base}/{part}"):
                version = self.version()
                done.append(self.commit([*self.runs(version), run], version))
        return done

    def _run(self, name: str) -> Run | None:
        found = [(f"{name}/{x.getPath().getName()}", x.getLen()) for x in self._list(name) if x.getPath().getName().startswith("part-")]
        return Run(name, tuple(sorted(found))) if found else None

    # Compaction

    def compact(self, target: int = 256 << 20, fanout: int = 4, least: int = 1 << 20) -> int:
        """Merge until no tier below ``target`` bytes holds ``fanout`` runs; the version then."""
        while group := self._crowded(self.runs(), target, fanout, least):
            version = self.version()
            files = [f"{self.root}/{f}" for r in group for f, _ in r.files]
            name = f"data/{uuid.uuid4().hex}"
            count = max(1, round(sum(r.bytes for r in group) / target))
            self.spark.read.schema(self.schema).parquet(*files).coalesce(count).write.parquet(f"{self.root}/{name}")
            rest = [r for r in self.runs(version) if r not in group]
            self.commit([*rest, self._run(name)], version)
        return self.version()

    @staticmethod
    def _crowded(runs: list[Run], target: int, fanout: int, least: int) -> list[Run]:
        tiers: dict[int, list[Run]] = {}
        for r in runs:
            # A run whose shards have the target size already has nothing to gain.
            if r.bytes / len(r.files) < target / 2:
                tiers.setdefault(math.floor(math.log(max(1, r.bytes / least), fanout)), []).append(r)
        return next((x[:fanout] for _, x in sorted(tiers.items()) if len(x) >= fanout), [])

    def vacuum(self, older_than: float = 86_400) -> None:
        """Delete the data of runs that the newest version no longer holds.

        Younger data than ``older_than`` seconds stay: they may be of a writer that has yet to commit them.
        """
        live, last = {r.name for r in self.runs()}, 1000 * (time.time() - older_than)
        for top in self._list("data"):
            base = f"data/{top.getPath().getName()}"
            parts = [x for x in self._list(base) if x.isDirectory()]
            for x in parts or [top]:
                name = f"{base}/{x.getPath().getName()}" if parts else base
                if name not in live and x.getModificationTime() <= last:
                    self._fs.delete(self._path(name), True)

    def read(self, version: int | None = None) -> DataFrame:
        files = [f"{self.root}/{f}" for r in self.runs(version) for f, _ in r.files]
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)
