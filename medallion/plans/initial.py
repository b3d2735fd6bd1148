"""Full load: source to bronze, bronze to silver with quarantine."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from medallion.dictionary import DataDictionary
from medallion.operators.header import IGNORED_COLUMNS, PARTITION_COLUMN, header_matches
from medallion.operators.keys import split_by_key
from medallion.operators.quality import split
from medallion.operators.rules import rules_for
from medallion.operators.standardize import conform, standardize_dates
from medallion.session import run_parallel
from medallion.sinks.catalog import create_database, register_table
from medallion.sinks.writers import write_errors, write_full


@dataclass(frozen=True)
class Layers:
    """Directories of one source system."""

    root: str

    def bronze(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def errors(self, table: str) -> str:
        return f"{self.root}/error/{table}"

    def gold(self, name: str = "") -> str:
        return f"{self.root}/gold/{name}".rstrip("/")


def ingest(df: DataFrame, layers: Layers, table: str, as_of: date) -> None:
    write_full(df.drop(*IGNORED_COLUMNS), layers.bronze(table), as_of)


def ingest_all(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    tables: Iterable[str],
    layers: Layers,
    as_of: date,
    parallel: int = 4,
) -> None:
    """Every table of a source system to bronze."""
    run_parallel(spark, lambda t: ingest(read(t), layers, t, as_of), tables, parallel)


def load_silver(
    spark: SparkSession,
    layers: Layers,
    dictionary: DataDictionary,
    table: str,
    as_of: date,
    strict_header: bool = False,
    match: str = "contains",
    render_dates: bool = False,
    cache: StorageLevel | None = None,
    unique_keys: bool = False,
) -> bool:
    """Bronze to silver: header check, all rules in one plan, good rows and error records written.

    The two writes read bronze once each. That is a second columnar scan, against keeping the whole
    table on executor disks; pass `cache` where the input is small or costly to read. With `unique_keys` rows
    that share their primary key with another good row, or lack it, are quarantined too; otherwise such
    duplicates stay. Returns whether the header matched.
    """
    bronze = spark.read.parquet(layers.bronze(table))
    matched = header_matches(bronze, dictionary, table, strict_header)
    rows = bronze.drop(PARTITION_COLUMN)
    if cache is not None:
        rows = rows.persist(cache)
    try:
        good, errors = split(rows, rules_for(rows, dictionary, table, match))
        if unique_keys:
            good, repeated = split_by_key(good, dictionary.primary_keys(table))
            errors = errors.unionByName(repeated)
        write_errors(errors, layers.errors(table), as_of)
        if render_dates:
            clean = standardize_dates(good, dictionary.dates(table), render=True)
        else:
            clean = conform(good, dictionary, table)
        write_full(clean, layers.silver(table), as_of)
    finally:
        if cache is not None:
            rows.unpersist()
    return matched


def register_layers(
    spark: SparkSession, database: str, layers: Layers, tables: Iterable[str], location: str | None = None
) -> None:
    """Silver as `<database>.<table>_silver`, quarantine as `error_<database>.<table>`."""
    create_database(spark, database, location)
    create_database(spark, f"error_{database}", f"{location}_error" if location else None)
    for table in tables:
        register_table(spark, database, f"{table}_silver", layers.silver(table))
        register_table(spark, f"error_{database}", table, layers.errors(table))
