"""A ledger store that stays cheap to read: runs of last writes, merged by size tiers, named by a manifest that is swapped whole.

Each epoch is a run. TIER runs of one level are merged to one of the next, so a
read touches at most (TIER - 1) runs for each level, and the levels are as many as
the logarithm of the epochs. Nothing is ever changed in place: a run is written
first, then a manifest that names it; a crash between both leaves files that no
manifest names, and the next try writes them again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

TIER = 4


class Overtaken(RuntimeError):
    """Another writer has published this version of the manifest; nothing of it was changed."""


@dataclass(frozen=True)
class Manifest:
    """version, the runs as (name, level, first epoch, last epoch), and the last epoch that is in them."""

    version: int = 0
    runs: list = field(default_factory=list)
    last: int = -1


class TieredStore:
    """Last writes by key of a stream's epochs under a path that all executors share; the schema has no column `_epoch`."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: str, tier: int = TIER):
        self.spark, self.path, self.keys, self.order, self.tier = spark, path.rstrip("/"), list(keys), order, tier
        self.names = schema.fieldNames()
        self.schema = StructType([*schema.fields, StructField("_epoch", LongType())])

    def _hadoop(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def manifest(self) -> Manifest:
        """The newest manifest that is whole; one that a crash has torn is passed over."""
        files, at = self._hadoop(f"{self.path}/manifests")
        if not files.exists(at):
            return Manifest()
        for name in sorted((s.getPath().getName() for s in files.listStatus(at)), reverse=True):
            text = "".join(r.value for r in self.spark.read.text(f"{self.path}/manifests/{name}", wholetext=True).collect())
            try:
                return Manifest(**json.loads(text))
            except (ValueError, TypeError):
                continue
        return Manifest()

    def _publish(self, manifest: Manifest) -> Manifest:
        files, at = self._hadoop(f"{self.path}/manifests/{manifest.version:012d}.json")
        try:
            out = files.create(at, False)
        except Exception as e:  # the JVM's: the file is there
            raise Overtaken(f"version {manifest.version} is taken") from e
        out.write(bytearray(json.dumps(manifest.__dict__).encode()))
        out.close()
        return manifest

    def _write(self, rows: DataFrame, name: str) -> None:
        one = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*self.names, "_epoch"), F.struct("_epoch", self.order)).alias("_r")).select("_r.*")
        one.write.mode("overwrite").parquet(f"{self.path}/runs/{name}")

    def read(self, runs: Sequence) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/runs/{r[0]}" for r in runs))

    def append(self, batch: DataFrame, epoch: int) -> Manifest:
        """An epoch's last write of each key as a run; an epoch that is in already, replayed after a restart, changes nothing. As foreachBatch's writer."""
        now = self.manifest()
        if epoch <= now.last:
            return now
        name = f"0-{epoch}-{epoch}"
        self._write(batch.withColumn("_epoch", F.lit(epoch).cast("long")), name)
        return self.compact(self._publish(Manifest(now.version + 1, [*now.runs, [name, 0, epoch, epoch]], epoch)))

    def compact(self, now: Manifest | None = None) -> Manifest:
        """Merges until no level holds TIER runs; reads and writes the runs it merges only."""
        now = now or self.manifest()
        while True:
            levels = sorted({r[1] for r in now.runs})
            level = next((lv for lv in levels if sum(r[1] == lv for r in now.runs) >= self.tier), None)
            if level is None:
                return now
            old = sorted((r for r in now.runs if r[1] == level), key=lambda r: r[2])[: self.tier]
            name = f"{level + 1}-{old[0][2]}-{old[-1][3]}"
            self._write(self.read(old), name)
            rest = [r for r in now.runs if r not in old]
            now = self._publish(Manifest(now.version + 1, [*rest, [name, level + 1, old[0][2], old[-1][3]]], now.last))

    def latest(self) -> DataFrame:
        """Of each key the row of its last epoch, and of one epoch the greatest by the order."""
        rows = self.read(self.manifest().runs)
        return rows.groupBy(*self.keys).agg(F.max_by(F.struct(*self.names), F.struct("_epoch", self.order)).alias("_r")).select("_r.*")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes runs that none of the last `keep` manifests names, and older manifests; readers of those must be done. Returns the runs' names."""
        files, at = self._hadoop(f"{self.path}/manifests")
        names = sorted((s.getPath().getName() for s in files.listStatus(at)), reverse=True) if files.exists(at) else []
        held = set()
        for name in names[:keep]:
            text = "".join(r.value for r in self.spark.read.text(f"{self.path}/manifests/{name}", wholetext=True).collect())
            try:
                held |= {r[0] for r in json.loads(text)["runs"]}
            except (ValueError, TypeError, KeyError):
                return []
        for name in names[keep:]:
            files.delete(self._hadoop(f"{self.path}/manifests/{name}")[1], False)
        runs, top = self._hadoop(f"{self.path}/runs")
        gone = [s.getPath() for s in runs.listStatus(top) if s.getPath().getName() not in held] if runs.exists(top) else []
        for old in gone:
            runs.delete(old, True)
        return sorted(p.getName() for p in gone)
