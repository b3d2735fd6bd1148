"""The data dictionary: one row per column of every source table.

The dictionary is metadata (as many rows as there are columns), so it is read with Spark once and
kept on the driver; everything that checks data is built from it as Column expressions.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header of the dictionary file, and the source types with a meaning of their own.
DICTIONARY_COLUMNS = [
    "TABLE_NAME", "COLUMN_NAME", "ORDINAL_POSITION", "IS_NULLABLE", "DATA_TYPE", "PRIMARY_KEY", "dataType",
]
DATE_SOURCE_TYPES = ("date", "datetime2")
FLAG_SOURCE_TYPE = "bit"

DICTIONARY_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in DICTIONARY_COLUMNS])


@dataclass(frozen=True)
class ColumnSpec:
    table: str
    name: str
    ordinal: int
    nullable: bool
    source_type: str
    primary_key: bool
    declared_type: str

    @property
    def is_date(self) -> bool:
        return self.source_type in DATE_SOURCE_TYPES

    @property
    def is_flag(self) -> bool:
        return self.source_type == FLAG_SOURCE_TYPE


class DataDictionary:
    def __init__(self, specs: Iterable[ColumnSpec]):
        self._tables: dict[str, list[ColumnSpec]] = {}
        for spec in specs:
            self._tables.setdefault(spec.table, []).append(spec)
        for columns in self._tables.values():
            columns.sort(key=lambda c: c.ordinal)

    @classmethod
    def from_frame(cls, df: DataFrame) -> DataDictionary:
        ordered = df.select(*DICTIONARY_COLUMNS).orderBy(
            "TABLE_NAME", F.col("ORDINAL_POSITION").cast("int")
        )
        return cls(
            ColumnSpec(r[0], r[1], int(r[2]), r[3] == "YES", r[4], r[5] == "YES", r[6])
            for r in ordered.collect()
        )

    @classmethod
    def from_csv(cls, spark: SparkSession, path: str) -> DataDictionary:
        return cls.from_frame(spark.read.schema(DICTIONARY_SCHEMA).option("header", True).csv(path))

    @classmethod
    def from_rows(cls, rows: Iterable[tuple]) -> DataDictionary:
        """Rows of (table, column, ordinal, nullable, source type, primary key, declared type)."""
        return cls(ColumnSpec(*row) for row in rows)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        yes_no = {True: "YES", False: "NO"}
        rows = [
            (c.table, c.name, str(c.ordinal), yes_no[c.nullable], c.source_type, yes_no[c.primary_key],
             c.declared_type)
            for table in self.tables()
            for c in self.columns(table)
        ]
        return spark.createDataFrame(rows, DICTIONARY_SCHEMA)

    def tables(self) -> list[str]:
        return sorted(self._tables)

    def columns(self, table: str) -> list[ColumnSpec]:
        """Columns by ordinal position; ordinals may have gaps."""
        if table not in self._tables:
            raise KeyError(f"table {table!r} is not in the data dictionary")
        return self._tables[table]

    def names(self, table: str) -> list[str]:
        return [c.name for c in self.columns(table)]

    def schema(self, table: str, typed_dates: bool = False) -> T.StructType:
        """Declared schema. `typed_dates` gives the clean layer's type of date columns."""
        ddl = ", ".join(
            f"`{c.name}` {'timestamp_ntz' if typed_dates and c.is_date else c.declared_type}"
            for c in self.columns(table)
        )
        return T.StructType.fromDDL(ddl)

    def primary_keys(self, table: str) -> list[str]:
        return [c.name for c in self.columns(table) if c.primary_key]

    def not_null(self, table: str, include_flags: bool = False) -> list[str]:
        return [
            c.name for c in self.columns(table) if not c.nullable and (include_flags or not c.is_flag)
        ]

    def dates(self, table: str) -> list[str]:
        return [c.name for c in self.columns(table) if c.is_date]
