"""Tables in parts that are replaced part by part, all in one step for readers.

Parquet directories have no transactions. Here a version is a manifest, a list of the directory that holds each
part; a write adds directories and then a manifest, whose completion mark is the step. Readers take the newest
complete manifest, and those that started before keep the directories of theirs until `vacuum`.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sinks.writers import child_directories, committed, rebalanced, remove_directory

PART = "part"
MANIFEST = "part bigint, version int"


@dataclass(frozen=True)
class KeyRanges:
    """Parts of `width` consecutive numbers of a key.

    Keys that grow with time keep what changes together, and old parts alone.
    """

    key: str
    width: int

    def of(self, key: str | None = None) -> Column:
        return F.floor(F.col(f"`{key or self.key}`") / F.lit(self.width)).cast("long")

    @staticmethod
    def _runs(parts: Iterable[int]) -> list[list[int]]:
        ordered = sorted(set(parts))
        runs = [[p, p] for p in ordered[:1]]
        for p in ordered[1:]:
            if p == runs[-1][1] + 1:
                runs[-1][1] = p
            else:
                runs.append([p, p])
        return runs

    def within(self, parts: Iterable[int], key: str | None = None, most: int = 64) -> Column:
        """A condition that all keys of the parts meet, as few ranges, which scans can skip files and groups by.

        Beyond `most` ranges the smallest gaps are closed, so it may hold for keys of other parts too.
        """
        runs = self._runs(parts)
        while len(runs) > most:
            at = min(range(1, len(runs)), key=lambda k: runs[k][0] - runs[k - 1][1])
            runs[at - 1 : at + 1] = [[runs[at - 1][0], runs[at][1]]]
        column, found = F.col(f"`{key or self.key}`"), F.lit(False)
        for low, high in runs:
            found = found | ((column >= low * self.width) & (column < (high + 1) * self.width))
        return found

    def exactly(self, parts: Iterable[int], key: str | None = None, most: int = 64) -> Column:
        """`within`, for keys of these parts only."""
        found = self.within(parts, key, most)
        if len(self._runs(parts)) <= most:
            return found
        return found & self.of(key).isin(sorted(set(parts)))


@dataclass(frozen=True)
class PartedTable:
    """One writer at a time. `schema` is that of the rows; where a part has no rows it has no directory."""

    spark: SparkSession
    path: str
    schema: T.StructType
    ranges: KeyRanges

    def _versions(self) -> list[int]:
        found = child_directories(self.spark, f"{self.path}/manifest").items()
        return sorted(int(name.split("=")[1]) for name, path in found if committed(self.spark, path))

    def _manifest(self, version: int) -> str:
        return f"{self.path}/manifest/v={version}"

    def _data(self, version: int) -> str:
        return f"{self.path}/data/v={version}"

    def live(self) -> dict[int, int]:
        """The version whose directory holds each part now. As many entries as there are parts."""
        versions = self._versions()
        if not versions:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(self._manifest(versions[-1])).collect()
        return {r.part: r.version for r in rows}

    def read(self, parts: Iterable[int] | None = None) -> DataFrame:
        """The rows now, of all parts or of some; directories of other parts aren't listed."""
        live = self.live()
        wanted = live if parts is None else {p: live[p] for p in set(parts) if p in live}
        paths = [f"{self._data(version)}/{PART}={part}" for part, version in sorted(wanted.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def replace(self, rows: DataFrame, parts: Iterable[int] | None = None, placed: str | None = None) -> int:
        """Put `rows` in place of the parts, or of the whole table; returns the version. Other parts aren't touched.

        `rows` may read the table itself: what they read isn't removed. A write that died before its manifest is
        written over by the next. `placed` is a column with each row's part, by which the rows are laid out already.
        """
        versions = self._versions()
        version = versions[-1] + 1 if versions else 0
        before = {} if parts is None else {p: v for p, v in self.live().items() if p not in set(parts)}
        part = F.col(placed) if placed else self.ranges.of()
        rows = rows.select(*[f"`{n}`" for n in self.schema.names], part.alias(PART))
        rows = rows if placed else rebalanced(rows, PART)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PART).parquet(
            self._data(version)
        )
        written = [int(n.split("=")[1]) for n in child_directories(self.spark, self._data(version))]
        entries = [*before.items(), *((p, version) for p in written)]
        manifest = self.spark.createDataFrame(entries, MANIFEST).coalesce(1)
        manifest.write.mode("overwrite").parquet(self._manifest(version))
        return version

    def vacuum(self) -> None:
        """Remove older manifests, and directories that the newest doesn't name."""
        versions, live = self._versions(), self.live()
        for version in versions[:-1]:
            remove_directory(self.spark, self._manifest(version))
        for name, path in child_directories(self.spark, f"{self.path}/data").items():
            version = int(name.split("=")[1])
            for part, directory in child_directories(self.spark, path).items():
                if part.startswith(f"{PART}=") and live.get(int(part.split("=")[1])) != version:
                    remove_directory(self.spark, directory)
            if version not in live.values():
                remove_directory(self.spark, path)
