"""Headers and their lines stored together: bucketed by the header's key, so that joining them shuffles neither.

A bucket is read by one task, so a header with very many lines would be one task's work. Such headers are stored apart,
with their lines in plain files that many tasks read; a fact is made of both.
"""

from __future__ import annotations

import hashlib
from collections import ChainMap
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.plans.gold import Tables, build
from medallion.session import workspace
from medallion.sinks.bucketed import bucketed_table, write_bucketed

#: Header and line tables of the facts, and the column that joins them.
TOGETHER: dict[str, dict[str, str]] = {
    "OrderID": {"header": "Orders", "lines": "OrderLines"},
    "PurchaseOrderID": {"header": "PurchaseOrders", "lines": "PurchaseOrderLines"},
    "InvoiceID": {"header": "Invoices", "lines": "InvoiceLines"},
}
#: Which of them a fact joins.
FACT_KEYS = {"Movement": "OrderID", "Order": "PurchaseOrderID", "Purchase": "PurchaseOrderID", "Sales": "InvoiceID"}


def hot_keys(lines: DataFrame, key: str, most: int) -> DataFrame:
    """Keys with more than `most` lines, counted in every task first; there are at most lines / most of them."""
    counted = lines.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > most).select(key)


@dataclass(frozen=True)
class StoredTogether:
    """One pair of header and lines at `path`, in `buckets` (at least the session's shuffle partitions)."""

    spark: SparkSession
    path: str
    key: str
    buckets: int
    most: int = 1_000_000

    @property
    def pair(self) -> dict[str, str]:
        return TOGETHER[self.key]

    def _table(self, table: str) -> str:
        place = hashlib.sha256(self.path.encode()).hexdigest()[:16]
        return f"together_{place}_{table}".lower()

    def write(self, tables: Tables) -> None:
        """Both tables from the clean ones. The keys with many lines are stored first, so both go by the same list."""
        kept = workspace(self.spark, "hot")
        hot_keys(tables[self.pair["lines"]], self.key, self.most).write.parquet(kept)
        hot = self.spark.read.parquet(kept)
        for table in self.pair.values():
            rows = tables[table]
            cold = rows.join(hot, self.key, "left_anti").select(*rows.columns)
            write_bucketed(cold, self._table(table), f"{self.path}/{table}/cold", [self.key], self.buckets)
            rows.join(hot, self.key, "left_semi").select(*rows.columns).write.mode("overwrite").parquet(
                f"{self.path}/{table}/hot"
            )

    def _read(self, table: str) -> tuple[DataFrame, DataFrame]:
        hot = self.spark.read.parquet(f"{self.path}/{table}/hot")
        cold = bucketed_table(
            self.spark, self._table(table), f"{self.path}/{table}/cold", hot.schema, [self.key], self.buckets
        )
        return cold, hot

    def parts(self, tables: Tables) -> tuple[Mapping[str, DataFrame], Mapping[str, DataFrame]]:
        """The tables with this pair's cold rows, and with its hot ones."""
        cold, hot = zip(*(self._read(table) for table in self.pair.values()))
        names = list(self.pair.values())
        return ChainMap(dict(zip(names, cold)), tables), ChainMap(dict(zip(names, hot)), tables)


def build_together(name: str, tables: Tables, stored: StoredTogether) -> DataFrame:
    """A gold fact from headers and lines that are stored together.

    Lines in buckets meet their headers where they lie. Those of hot headers are few headers' many lines: the
    headers are broadcast by size, or the join's skewed partitions are split.
    """
    if FACT_KEYS[name] != stored.key:
        raise ValueError(f"{name} joins by {FACT_KEYS[name]}, not {stored.key}")
    cold, hot = stored.parts(tables)
    return build(name, cold).unionByName(build(name, hot))
