"""Tables that grow by micro-batches and are read through a manifest.

A batch is written as a run, with a folder for each day if the table has days. A manifest is a small
file that lists the runs a table is made of; publishing one more version of it is what makes a batch
part of the table, whole and once. Readers list the folders of the newest version and no others, so
what they list does not depend on how many batches there have been:

- FANOUT runs of a day and level are merged to one run of the next level, so a day has at most
  FANOUT - 1 runs of each level and a row is written again once per level;
- a day that is closed becomes a single run, and is then left alone.

Merging runs beside readers and is published like a batch. Runs that are no longer listed are deleted
KEPT versions later, when nobody reads by an old manifest any more.

One stream writes a table, and merges it. Its batches are numbered upwards; one that was published
already is not written again.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from clickweave.sources import files, sinks

FANOUT = 8
# Versions of the manifest that are kept; a reader has that many batches of time.
KEPT = 24

Merge = Callable[[DataFrame], DataFrame]


def append(rows: DataFrame) -> DataFrame:
    """All rows of all batches."""
    return rows.drop("batch_id")


def distinct(rows: DataFrame) -> DataFrame:
    return append(rows).distinct()


def latest(*keys: str) -> Merge:
    """Per key the values of its newest batch."""
    return lambda rows: sinks.latest(rows, keys)


def summed(*keys: str) -> Merge:
    """Per key the sum over all batches."""
    return lambda rows: sinks.summed(rows, keys)


@dataclass(frozen=True)
class Run:
    """A folder of rows of the batches `first` to `last`; of one day, if the table has days."""

    folder: str
    day: str | None
    level: int
    first: int
    last: int


@dataclass(frozen=True)
class Manifest:
    version: int = -1
    # The last batch published, and what its writer noted.
    batch: int = -1
    note: dict = field(default_factory=dict)
    runs: tuple[Run, ...] = ()

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Manifest:
        content = json.loads(text)
        return Manifest(**{**content, "runs": tuple(Run(**r) for r in content["runs"])})


@dataclass(frozen=True)
class BatchTable:
    """The table below `path`; `day` names its column of days, `merge` makes runs one state."""

    spark: SparkSession
    path: str
    schema: str
    merge: Merge = append
    day: str | None = None
    # Whether a batch takes the place of all earlier rows of its days (of all rows, without days).
    replaces: bool = False

    # Reading.

    def manifest(self) -> Manifest:
        versions = [n for n in files.names(self.spark, self._manifests) if n.endswith(".json")]
        if not versions:
            return Manifest()
        return Manifest.from_json(files.read_text(self.spark, f"{self._manifests}/{versions[-1]}"))

    def read(self, manifest: Manifest | None = None) -> DataFrame:
        """The table as it is now, or as a manifest has it."""
        return self.merge(self._rows((manifest or self.manifest()).runs))

    def written(self, batch_id: int) -> DataFrame:
        """What the last batch wrote, as it wrote it; no rows if it had none.

        A second output is read back from the first, as running a stateful plan twice would update
        its state twice.
        """
        return append(self._rows(self._runs_of(self._batch_folder(batch_id), 0, batch_id, batch_id)))

    def _rows(self, runs) -> DataFrame:
        schema = f"{self.schema}, run STRING, batch_id BIGINT"
        if not runs:
            return self.spark.createDataFrame([], schema).drop("run")
        return (self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
                .parquet(*[f"{self.path}/data/{run.folder}" for run in runs]).drop("run"))

    # Writing.

    def commit(self, rows: DataFrame, batch_id: int, note: Callable[[], dict] | None = None) -> bool:
        """Write the rows of a batch and publish it; False if it was published before.

        `note` is called between writing and publishing; what it returns is kept in the manifest.
        """
        before = self.manifest()
        if batch_id <= before.batch:
            return False
        folder = self._batch_folder(batch_id)
        self._write(rows, folder)
        new = self._runs_of(folder, 0, batch_id, batch_id)
        days = {run.day for run in new}
        kept = [run for run in before.runs if not (self.replaces and run.day in days)]
        self._publish(Manifest(before.version + 1, batch_id, note() if note else before.note,
                               (*kept, *new)))
        return True

    def compact(self, closed: Callable[[str], bool] = lambda day: False) -> None:
        """Merge the runs that are due; `closed` tells whether a day will get no more rows."""
        if self.replaces:
            return
        now = self.manifest()
        by_day: dict[str | None, list[Run]] = defaultdict(list)
        for run in now.runs:
            by_day[run.day].append(run)
        # Runs to merge, by the level and last batch of what they become: days alike go in one job.
        due: dict[tuple[int, int], list[Run]] = defaultdict(list)
        for day, runs in by_day.items():
            if day is not None and closed(day) and len(runs) > 1:
                due[1 + max(run.level for run in runs), max(run.last for run in runs)] += runs
                continue
            by_level: dict[int, list[Run]] = defaultdict(list)
            for run in runs:
                by_level[run.level].append(run)
            level = next((n for n, own in sorted(by_level.items()) if len(own) >= FANOUT), None)
            if level is not None:
                due[level + 1, max(run.last for run in by_level[level])] += by_level[level]
        if not due:
            return
        merged: list[Run] = []
        for (level, last), runs in due.items():
            folder = f"run=merged-{now.version + 1}-{level}-{last}/batch_id={last}"
            self._write(self.merge(self._rows(runs)), folder)
            merged += self._runs_of(folder, level, min(run.first for run in runs), last)
        gone = {run.folder for runs in due.values() for run in runs}
        kept = [run for run in now.runs if run.folder not in gone]
        self._publish(Manifest(now.version + 1, now.batch, now.note, (*kept, *merged)))

    @property
    def _manifests(self) -> str:
        return f"{self.path}/manifests"

    @staticmethod
    def _batch_folder(batch_id: int) -> str:
        return f"run=batch-{batch_id}/batch_id={batch_id}"

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Rebalanced: neither a small file of every task nor a large one of a day."""
        days = [self.day] if self.day else []
        (rows.hint("rebalance", *days).write.mode("overwrite").partitionBy(*days)
         .parquet(f"{self.path}/data/{folder}"))

    def _runs_of(self, folder: str, level: int, first: int, last: int) -> list[Run]:
        """The runs of a folder that was written as a whole."""
        found = files.names(self.spark, f"{self.path}/data/{folder}")
        if self.day is None:
            some = any(name.startswith("part-") for name in found)
            return [Run(folder, None, level, first, last)] if some else []
        return [Run(f"{folder}/{name}", name.split("=", 1)[1], level, first, last)
                for name in found if name.startswith(f"{self.day}=")]

    def _publish(self, manifest: Manifest) -> None:
        files.write_text(self.spark, self._version(manifest.version), manifest.to_json())
        old = manifest.version - KEPT
        if old >= 0 and files.exists(self.spark, self._version(old)):
            self._forget(old)

    def _version(self, version: int) -> str:
        return f"{self._manifests}/{version:015d}.json"

    def _forget(self, version: int) -> None:
        """Delete a version of the manifest and the runs that only it and earlier ones list."""
        old, following = (Manifest.from_json(files.read_text(self.spark, self._version(v)))
                          for v in (version, version + 1))
        for folder in sorted({r.folder for r in old.runs} - {r.folder for r in following.runs}):
            files.delete(self.spark, f"{self.path}/data/{folder}")
            # Its other days may be listed still.
            run, batch = folder.split("/")[:2]
            left = files.names(self.spark, f"{self.path}/data/{run}/{batch}")
            if not any(name.startswith(("part-", f"{self.day}=")) for name in left):
                files.delete(self.spark, f"{self.path}/data/{run}")
        files.delete(self.spark, self._version(version))

