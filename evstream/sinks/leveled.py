"""A key-value table of immutable runs in levels, named by manifests that are switched in one step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from evstream.operators.running import latest_per_key

BATCH = "batch_id"
FAN_IN = 4


@dataclass(frozen=True)
class Run:
    """A folder with one row per key: the last of the batches ``first`` to ``last``."""

    name: str
    level: int
    first: int
    last: int


class LeveledTable:
    """A map from key to its latest value, written batch by batch.

    A batch becomes a run of level 0. ``fan_in`` runs of a level are merged by key into one of the
    next level, so a row is rewritten once a level and a merge reads no more than the runs it joins.
    Runs are never changed: a version is a manifest that names its runs, and the highest version
    counts. Readers keep the version they started with until :meth:`clean` removes its runs.
    One writer at a time; another's version of the same number makes the later one fail.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], fan_in: int = FAN_IN):
        self.spark, self.path, self.keys, self.fan_in = spark, path.rstrip("/"), list(keys), fan_in
        self._root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def versions(self) -> list[int]:
        at = self._at("_versions")
        if not self._files.exists(at):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(at)]
        return sorted(int(n) for n in names if n.isdigit())

    def runs(self, version: int | None = None) -> list[Run]:
        """The runs of a version, of the highest one if none is named."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return []
        text = self.spark.read.text(f"{self.path}/_versions/{version:09d}", wholetext=True).first()[0]
        return [Run(**r) for r in json.loads(text)]

    def _switch(self, runs: list[Run]) -> int:
        number = max(self.versions(), default=0) + 1
        held, final = self._at(f"_versions/_{uuid.uuid4().hex}"), self._at(f"_versions/{number:09d}")
        out = self._files.create(held, True)
        out.write(bytearray(json.dumps([asdict(r) for r in runs]).encode()))
        out.close()
        if self._files.exists(final) or not self._files.rename(held, final):
            raise RuntimeError(f"version {number} of {self.path} was written by another")
        return number

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> Run:
        run = Run(uuid.uuid4().hex, level, first, last)
        rows.write.parquet(f"{self.path}/runs/{run.name}")
        return run

    def _read(self, runs: Sequence[Run], schema: T.StructType) -> DataFrame:
        held = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        if not runs:
            return self.spark.createDataFrame([], held)
        return self.spark.read.schema(held).parquet(*[f"{self.path}/runs/{r.name}" for r in runs])

    def write_batch(self, df: DataFrame, batch_id: int, order: Sequence[str] = ()) -> None:
        """Add a batch, reduced to the last row per key by ``order`` first. A batch that comes again
        replaces itself; once it was merged, it is left as it is."""
        held = self.runs()
        if any(r.level > 0 and r.first <= batch_id <= r.last for r in held):
            return
        rows = latest_per_key(df, self.keys, order) if order else df
        run = self._write(rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")), 0, batch_id, batch_id)
        self._switch([*[r for r in held if (r.level, r.first) != (0, batch_id)], run])

    def snapshot(self, schema: T.StructType, version: int | None = None) -> DataFrame:
        """The latest row of every key in a version."""
        return latest_per_key(self._read(self.runs(version), schema), self.keys, [BATCH]).drop(BATCH)

    def compact(self, schema: T.StructType) -> list[Run]:
        """Merge the oldest ``fan_in`` runs of each level that has as many beside the newest batch,
        which may come again. Returns the runs made, each put in place by a version of its own."""
        made = []
        while True:
            held = self.runs()
            newest = max((r.last for r in held), default=None)
            by_level: dict[int, list[Run]] = {}
            for r in sorted(held, key=lambda r: r.first):
                if not (r.level == 0 and r.last == newest):
                    by_level.setdefault(r.level, []).append(r)
            full = min((level for level, runs in by_level.items() if len(runs) >= self.fan_in), default=None)
            if full is None:
                return made
            old = by_level[full][:self.fan_in]
            rows = latest_per_key(self._read(old, schema), self.keys, [BATCH])
            run = self._write(rows, full + 1, old[0].first, old[-1].last)
            self._switch([*[r for r in held if r not in old], run])
            made.append(run)

    def clean(self, keep: int = 2) -> None:
        """Remove all versions but the last ``keep`` and the runs that none of these names."""
        versions = self.versions()
        kept = versions[-keep:]
        named = {r.name for v in kept for r in self.runs(v)}
        for v in versions[:-keep]:
            self._files.delete(self._at(f"_versions/{v:09d}"), False)
        at = self._at("runs")
        for status in self._files.listStatus(at) if self._files.exists(at) else []:
            if status.getPath().getName() not in named:
                self._files.delete(status.getPath(), True)
