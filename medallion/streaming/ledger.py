"""Which files finished batches have taken.

A checkpoint knows that too, but it can be lost or started anew, and then delivers every file again under batch
numbers from 0 on. The ledger lives with the tables: an entry is written when all writes of a batch are, files it
names are taken no more, and it numbers the batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from medallion.sinks.writers import child_directories, committed, remove_directory

ENTRIES = "file_path string, modified timestamp, batch bigint"


@dataclass(frozen=True)
class FileLedger:
    """Entries of each finished batch in `<path>/batch=<n>`, those of folded ones in `<path>/upto=<n>`.

    A file is known by path and modification time, so one that is replaced in place counts as new. One writer at a
    time, as for any checkpoint.
    """

    spark: SparkSession
    path: str

    def _numbers(self, kind: str) -> list[int]:
        found = child_directories(self.spark, self.path).items()
        return sorted(
            int(name.split("=")[1])
            for name, path in found
            if name.startswith(f"{kind}=") and committed(self.spark, path)
        )

    def _folded(self) -> int:
        """The last batch folded; -1 if none is."""
        return max(self._numbers("upto"), default=-1)

    def _directory(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}={number}"

    def batches(self) -> list[int]:
        """Numbers of finished batches that aren't folded."""
        folded = self._folded()
        return [n for n in self._numbers("batch") if n > folded]

    def next_batch(self) -> int:
        """The number of the next batch. One that died unfinished had the same, so its directories are replaced."""
        return max([self._folded(), *self._numbers("batch")]) + 1

    def entries(self) -> DataFrame:
        """(file_path, modified, batch) of every file that finished batches have taken."""
        folded = self._folded()
        paths = [self._directory("upto", folded)] if folded >= 0 else []
        paths += [self._directory("batch", n) for n in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], ENTRIES)
        return self.spark.read.schema(ENTRIES).parquet(*paths)

    def fresh(self, files: DataFrame) -> DataFrame:
        """Distinct (file_path, modified) of `files` that no finished batch has taken."""
        own = ["file_path", "modified"]
        return files.select(*own).distinct().join(self.entries().select(*own), own, "left_anti")

    def commit(self, batch: int, files: list[tuple]) -> None:
        """Enter the files of a batch, whose other writes are finished. Its list fits the driver, where streams plan."""
        rows = [(path, modified, batch) for path, modified in files]
        entries = self.spark.createDataFrame(rows, ENTRIES).coalesce(1)
        entries.write.mode("overwrite").parquet(self._directory("batch", batch))

    def fold(self) -> None:
        """Put the entries of all finished batches in one directory, so that a start lists few.

        Should the job die in between, the batches are still there; what is folded already isn't read twice.
        """
        batches, before = self.batches(), self._numbers("upto")
        if not batches:
            return
        self.entries().write.mode("overwrite").parquet(self._directory("upto", batches[-1]))
        for number in self._numbers("batch"):
            if number <= batches[-1]:
                remove_directory(self.spark, self._directory("batch", number))
        for number in before:
            remove_directory(self.spark, self._directory("upto", number))
