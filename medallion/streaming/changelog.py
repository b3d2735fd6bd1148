"""A table kept as a snapshot plus a log of micro-batches.

Parquet has no MERGE, and rewriting a table per micro-batch costs the whole table each time. Here a
batch costs its own size: it is written to its own directory, readers put the newest version per key
on top of the last snapshot, and `compact` makes a new snapshot now and then. Applying a batch twice
changes nothing (the newest version wins either way), so retries and restarts need no bookkeeping.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.upsert import latest, upsert, upsert_by_full_join, upsert_by_union
from medallion.sinks.bucketed import bucketed_table, write_bucketed
from medallion.sinks.writers import (
    child_directories,
    committed,
    remove_directory,
    write_batch,
)


@dataclass(frozen=True)
class ChangeLog:
    """`seq` orders the versions of a key; `keys` are never NULL.

    With `buckets` (at least the session's shuffle partitions) snapshots are bucketed by key: reading
    the current table and compacting then shuffle the log only, never the snapshot.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    seq: list[str]
    buckets: int | None = None

    @property
    def _log(self) -> str:
        return f"{self.path}/log"

    def _versions(self) -> list[int]:
        """Versions of finished snapshots, oldest first."""
        found = child_directories(self.spark, f"{self.path}/snapshot").items()
        return sorted(int(name.split("=")[1]) for name, path in found if committed(self.spark, path))

    def _batches(self) -> list[str]:
        found = child_directories(self.spark, self._log).values()
        return sorted(p for p in found if committed(self.spark, p))

    def _snapshot_path(self, version: int) -> str:
        return f"{self.path}/snapshot/v={version}"

    def _snapshot_table(self, version: int) -> str:
        place = hashlib.sha256(self.path.encode()).hexdigest()[:16]
        return f"snapshot_{place}_v{version}"

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _snapshot(self, version: int) -> DataFrame:
        path = self._snapshot_path(version)
        if self.buckets is None:
            return self._read([path])
        table = self._snapshot_table(version)
        return bucketed_table(self.spark, table, path, self.schema, self.keys, self.buckets)

    def _write_snapshot(self, df: DataFrame, clustered: bool) -> None:
        versions = self._versions()
        version = versions[-1] + 1 if versions else 0
        path = self._snapshot_path(version)
        if self.buckets is None:
            df.write.mode("overwrite").parquet(path)
        else:
            table = self._snapshot_table(version)
            write_bucketed(df, table, path, self.keys, self.buckets, clustered)

    def seed(self, df: DataFrame) -> None:
        """Start from a full load, reduced to its newest version per key: rows may repeat keys there."""
        rows = latest(df.select(*self.schema.names), self.keys, self.seq)
        self._write_snapshot(rows, clustered=False)

    def append(self, df: DataFrame, batch_id: int) -> int:
        """Log a batch, reduced to its newest version per key. Returns how many rows that left.

        They are counted as they are written, by the tasks of the last stage, each of which counts once.
        """
        rows = latest(df.select(*self.schema.names), self.keys, self.seq)
        logged = Observation()
        write_batch(rows.observe(logged, F.count(F.lit(1)).alias("n")), self._log, batch_id)
        return logged.get["n"]

    def current(self) -> DataFrame:
        """The table now: one row per key."""
        versions, batches = self._versions(), self._batches()
        if not versions:
            return latest(self._read(batches), self.keys, self.seq)
        snapshot = self._snapshot(versions[-1])
        if not batches:
            return snapshot
        # One form whatever the log's size: the planner broadcasts the updates' keys if they are few.
        apply = upsert if self.buckets is None else upsert_by_full_join
        return apply(snapshot, self._read(batches), self.keys, self.seq)

    def changed(self) -> DataFrame:
        """Rows of all keys in the log: as they are in the last snapshot, and every version logged since."""
        versions, batches = self._versions(), self._batches()
        logged = self._read(batches)
        if not versions or not batches:
            return logged
        keys = logged.select(*self.keys).distinct()
        before = self._snapshot(versions[-1]).join(keys, self.keys, "left_semi")
        return before.select(*self.schema.names).unionByName(logged)

    def newest_snapshot(self) -> str:
        """Directory of the newest finished snapshot; of an empty one, if there is none yet."""
        if not self._versions():
            self.seed(self._read([]))
        return self._snapshot_path(self._versions()[-1])

    def compact(self) -> None:
        """Fold the log into a new snapshot, then drop the batches folded.

        Should the job die in between, the batches are still there and applying them again changes
        nothing. Older snapshots stay until `vacuum`, for readers that started before.
        """
        batches = self._batches()
        if batches:
            merged_in_buckets = self.buckets is not None and bool(self._versions())
            self._write_snapshot(self.current(), clustered=merged_in_buckets)
            for path in batches:
                remove_directory(self.spark, path)

    def vacuum(self) -> None:
        """Drop all snapshots but the newest."""
        for version in self._versions()[:-1]:
            if self.buckets is not None:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._snapshot_table(version)}")
            remove_directory(self.spark, self._snapshot_path(version))
