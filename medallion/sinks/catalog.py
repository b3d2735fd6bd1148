"""Catalog registration of written tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from medallion.sinks.writers import child_directories


def _name(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)}{where}")


def register_table(spark: SparkSession, database: str, table: str, path: str) -> None:
    """Table over existing files, with the columns and partitions present there now.

    An entry of the same name is replaced, since its files may have been written anew with other
    columns; that leaves the files alone, as the table is external.
    """
    name = _name(database, table)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.refreshByPath(path)
    spark.sql(f"CREATE TABLE {name} USING PARQUET LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {name}")


def register_gold(spark: SparkSession, database: str, gold_path: str) -> list[str]:
    """Every directory below `gold_path` as table `<name>_gold`."""
    names = []
    for name, path in sorted(child_directories(spark, gold_path).items()):
        register_table(spark, database, f"{name}_gold", path)
        names.append(f"{name}_gold")
    return names
