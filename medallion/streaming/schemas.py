"""The schemas that a stream's files have had."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medallion.sinks.writers import child_directories, committed

HISTORY = "version int, batch bigint, ordinal int, column_name string, data_type string, status string"


def schema_changes(actual: T.StructType, declared: T.StructType) -> list[tuple[str, str | None, str]]:
    """(column, type, status) with status ok, retyped, lost or new: what the files have, then what they lack."""
    kinds = {f.name: f.dataType for f in declared.fields}
    rows = []
    for field in actual.fields:
        status = "new" if field.name not in kinds else "ok" if field.dataType == kinds[field.name] else "retyped"
        rows.append((field.name, field.dataType.simpleString(), status))
    return rows + [(name, None, "lost") for name in kinds if name not in actual.names]


@dataclass(frozen=True)
class SchemaLog:
    """Versions of the schema of arriving files, one directory each. A version that was seen before isn't new."""

    spark: SparkSession
    path: str
    declared: T.StructType

    def history(self) -> DataFrame:
        """(version, batch, ordinal, column_name, data_type, status) of all versions; `batch` is where it came first."""
        found = child_directories(self.spark, self.path).values()
        paths = [p for p in found if committed(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], HISTORY)
        return self.spark.read.schema(HISTORY).parquet(*paths)

    def record(self, batch: int, schemas: list[T.StructType]) -> list[T.StructType]:
        """Add the schemas that no version has, and return them. As many rows as there are columns."""
        versions: dict[int, list] = {}
        for row in self.history().orderBy("version", "ordinal").collect():
            versions.setdefault(row.version, []).append((row.column_name, row.data_type, row.status))
        known, added = [v for v in versions.values()], []
        for schema in schemas:
            rows = schema_changes(schema, self.declared)
            if rows in known:
                continue
            known.append(rows)
            added.append(schema)
            version = len(known) - 1
            frame = self.spark.createDataFrame(
                [(version, batch, place, *row) for place, row in enumerate(rows)], HISTORY
            )
            frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/v={version}")
        return added
