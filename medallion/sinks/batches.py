"""A layer written batch by batch, whose many small directories are packed into few large files.

Each micro-batch has its own directory, and every read lists them all. `pack` writes the rows of all finished batches
anew, in files of the advisory size, under a hidden directory that names the last batch in it; its completion mark is
the one step that makes it count. Readers take the newest complete pack and the batches after it; those that
started before keep their directories until `vacuum`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sinks.writers import batch_path, child_directories, committed, rebalanced, remove_directory

BATCH = "batch_id"


@dataclass(frozen=True)
class BatchLayer:
    """Batches of `write_batch` at `path`. Batches up to the last packed one are final: a file ledger numbers them so.

    `partitions` are the directories below a batch, `schema` the rows', partitions included. Without it the newest
    batch's files tell it, so layers with partitions, whose batches can be without a file, need it.
    """

    spark: SparkSession
    path: str
    schema: T.StructType | None = None
    partitions: tuple[str, ...] = ()

    def _numbers(self, path: str, kind: str) -> list[int]:
        found = child_directories(self.spark, path).items()
        return sorted(
            int(name.split("=")[1])
            for name, place in found
            if name.startswith(f"{kind}=") and committed(self.spark, place)
        )

    def _packs(self) -> list[int]:
        return self._numbers(f"{self.path}/_packed", "upto")

    def _pack(self, upto: int) -> str:
        return f"{self.path}/_packed/upto={upto}"

    def batches(self) -> list[int]:
        """Finished batches after the newest pack."""
        packed = max(self._packs(), default=-1)
        return [n for n in self._numbers(self.path, BATCH) if n > packed]

    def _rows(self) -> T.StructType:
        if self.schema is not None:
            return self.schema
        batches, packs = self.batches(), self._packs()
        newest = batch_path(self.path, batches[-1]) if batches else self._pack(packs[-1])
        found = self.spark.read.parquet(newest).schema
        return T.StructType([f for f in found.fields if f.name != BATCH])

    def read(self) -> DataFrame:
        """Rows of all finished batches, with their `batch_id`. A layer without batches has no rows."""
        batches, packs = self.batches(), self._packs()
        if not batches and not packs:
            fields = self.schema.fields if self.schema else []
            return self.spark.createDataFrame([], T.StructType([*fields, T.StructField(BATCH, T.IntegerType())]))
        schema = T.StructType([*self._rows().fields, T.StructField(BATCH, T.IntegerType())])
        parts = []
        if packs:
            parts.append(self.spark.read.schema(schema).parquet(self._pack(packs[-1])))
        if batches:
            paths = [batch_path(self.path, n) for n in batches]
            parts.append(self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths))
        names = [F.col(f"`{f.name}`") for f in schema.fields]
        out = parts[0].select(*names)
        return out.unionByName(parts[1].select(*names)) if len(parts) > 1 else out

    def pack(self) -> int | None:
        """Put all finished batches in one pack; returns the last batch in it, None if there is nothing new.

        Should the job die in between, nothing has changed; the next one writes over what it left.
        """
        batches = self.batches()
        if not batches:
            return None
        rows = rebalanced(self.read(), *(self.partitions or (BATCH,)))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            *self.partitions
        ).parquet(self._pack(batches[-1]))
        return batches[-1]

    def vacuum(self) -> None:
        """Remove packs but the newest, and the batches in that."""
        packs = self._packs()
        if not packs:
            return
        for upto in packs[:-1]:
            remove_directory(self.spark, self._pack(upto))
        for n in self._numbers(self.path, BATCH):
            if n <= packs[-1]:
                remove_directory(self.spark, batch_path(self.path, n))
