"""Gold facts kept up with changes of the clean tables, instead of built anew.

A fact row belongs to an owner: its header (order, invoice, ...) or its transaction. Changed rows of headers, lines
and dimensions lead to the owners whose rows may differ now. Those owners' rows are computed from the clean tables
by the fact's own plan, and put in place of the old ones in the parts of the fact that hold them. A part with many
such owners is computed anew as a whole, without a look at its old rows. Other parts are neither read nor written.
"""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.plans.gold import PLACE, Tables, build
from medallion.session import setting, workspace
from medallion.sinks.parted import KeyRanges, PartedTable
from medallion.sinks.writers import rebalanced
from medallion.streaming.incremental import IncrementalLoad

OWNER = "_owner"
#: A part is computed anew if one in so many of the owners it has room for may differ: to tell its other rows
#: apart, all of them would be shuffled and sorted once more.
ANEW = 100
#: Parts of more lines than this are joined by owner, where adaptive execution splits what is skewed.
MOST_LINES = 1_000_000


@dataclass(frozen=True)
class Route:
    """From changed rows of a table to owners.

    Without `through` the row names its owner in `column`. Otherwise `column` is the table's key, and rows of the
    table `through` that refer to it by `reference` name their owner in `owner`.
    """

    table: str
    column: str
    through: str | None = None
    reference: str | None = None
    owner: str | None = None


@dataclass(frozen=True)
class FactSpec:
    """`gold` is the fact's name in the registry, `only` a filter if this is but a part of it.

    `owner` is the fact's column of that name; `owned` are the clean tables with a row or more for each owner, and
    their column that names it.
    """

    gold: str
    owner: str
    owned: Mapping[str, str]
    routes: tuple[Route, ...]
    only: str | None = None

    def plan(self, tables: Tables) -> DataFrame:
        rows = build(self.gold, tables)
        return rows.where(self.only) if self.only else rows


def _own(owned: Mapping[str, str]) -> tuple[Route, ...]:
    return tuple(Route(table, column) for table, column in owned.items())


_ORDER = {"Orders": "OrderID", "OrderLines": "OrderID"}
_PURCHASE = {"PurchaseOrders": "PurchaseOrderID", "PurchaseOrderLines": "PurchaseOrderID"}
_INVOICE = {"Invoices": "InvoiceID", "InvoiceLines": "InvoiceID"}
_RECEIVED, _PAID = {"CustomerTransactions": "CustomerTransactionID"}, {"SupplierTransactions": "SupplierTransactionID"}
_MOVED = {"StockItemTransactions": "StockItemTransactionID"}

FACTS: dict[str, FactSpec] = {
    "Movement": FactSpec("Movement", "OrderID", _ORDER, (
        *_own(_ORDER),
        Route("Customers", "CustomerID", "Orders", "CustomerID", "OrderID"),
        Route("PackageTypes", "PackageTypeID", "OrderLines", "PackageTypeID", "OrderID"),
    )),
    "Purchase": FactSpec("Purchase", "PurchaseOrderID", _PURCHASE, (
        *_own(_PURCHASE),
        Route("StockItems", "StockItemID", "PurchaseOrderLines", "StockItemID", "PurchaseOrderID"),
        Route("PackageTypes", "PackageTypeID", "PurchaseOrderLines", "PackageTypeID", "PurchaseOrderID"),
    )),
    "Sales": FactSpec("Sales", "InvoiceID", _INVOICE, (
        *_own(_INVOICE),
        Route("Customers", "CustomerID", "Invoices", "CustomerID", "InvoiceID"),
        Route("Customers", "CustomerID", "Invoices", "BillToCustomerID", "InvoiceID"),
        Route("StockItems", "StockItemID", "InvoiceLines", "StockItemID", "InvoiceID"),
        Route("PackageTypes", "PackageTypeID", "InvoiceLines", "PackageTypeID", "InvoiceID"),
    )),
    "CustomerTransactions": FactSpec("Transactions", "CustomerTransactionID", _RECEIVED, (
        *_own(_RECEIVED),
        Route("Invoices", "InvoiceID", "CustomerTransactions", "InvoiceID", "CustomerTransactionID"),
    ), "CustomerTransactionID is not null"),
    "SupplierTransactions": FactSpec(
        "Transactions", "SupplierTransactionID", _PAID, _own(_PAID), "SupplierTransactionID is not null"
    ),
    "StockMovement": FactSpec("StockMovement", "StockItemTransactionID", _MOVED, _own(_MOVED)),
}


def affected_owners(spec: FactSpec, tables: Tables, changed: Mapping[str, DataFrame]) -> DataFrame:
    """Owners whose rows may differ: distinct `_owner`, reduced in every task before the shuffle.

    `changed` holds for each changed table its changed rows, at least the columns of its routes: the rows as they
    are now, and for tables that name owners also as they were, in case a row has moved to another owner.
    """
    found = []
    for route in spec.routes:
        if route.table not in changed:
            continue
        keys = changed[route.table].select(F.col(route.column).alias(OWNER)).where(f"{OWNER} is not null")
        if route.through:
            refers = tables[route.through].select(
                F.col(route.reference).alias("_refers"), F.col(route.owner).alias("_its")
            )
            keys = refers.join(keys.distinct(), F.col("_refers") == F.col(OWNER), "left_semi")
            keys = keys.select(F.col("_its").alias(OWNER))
        found.append(keys.select(F.col(OWNER).cast("long").alias(OWNER)))
    if not found:
        return tables[next(iter(spec.owned))].sparkSession.createDataFrame([], f"{OWNER} long")
    return reduce(DataFrame.unionByName, found).distinct()


@dataclass(frozen=True)
class MaintainedFact:
    """A gold fact in parts of `width` consecutive owners at `path`."""

    spark: SparkSession
    name: str
    path: str
    width: int

    @property
    def spec(self) -> FactSpec:
        return FACTS[self.name]

    def _table(self, schema) -> PartedTable:
        return PartedTable(self.spark, self.path, schema, KeyRanges(self.spec.owner, self.width))

    def table(self, tables: Tables) -> PartedTable:
        return self._table(self.spec.plan(tables).schema)

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Rows with their part, brought together by it; a large part is still many tasks' work."""
        return rebalanced(rows.withColumn(PLACE, KeyRanges(self.spec.owner, self.width).of()), PLACE)

    def _computed(self, tables: Tables) -> DataFrame:
        """The fact's rows, laid out by part.

        Headers and lines are brought together by part, not by owner, which one shuffle of them does; the few parts
        with very many lines are joined apart.
        """
        owned = {table: KeyRanges(column, self.width) for table, column in self.spec.owned.items()}
        if len(owned) == 1:
            return self._spread(self.spec.plan(tables))
        lines = list(owned)[-1]
        counted = tables[lines].groupBy(owned[lines].of().alias(PLACE)).agg(F.count(F.lit(1)).alias("_n"))
        hot = [r[0] for r in counted.where((F.col("_n") > MOST_LINES) & F.col(PLACE).isNotNull()).collect()]
        placed = {table: tables[table].withColumn(PLACE, ranges.of()) for table, ranges in owned.items()}
        if not hot:
            return self.spec.plan(ChainMap(placed, tables))
        cold = {table: rows.where(~F.col(PLACE).isin(hot)) for table, rows in placed.items()}
        apart = {table: tables[table].where(ranges.exactly(hot)) for table, ranges in owned.items()}
        rows = self.spec.plan(ChainMap(cold, tables))
        return rows.unionByName(self._spread(self.spec.plan(ChainMap(apart, tables))))

    def _store(self, tables: Tables, rows: DataFrame, parts: list[int] | None = None) -> None:
        # Else a join by part and owner shuffles by both what is laid out by part.
        with setting(self.spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            self.table(tables).replace(rows, parts, placed=PLACE)

    def build(self, tables: Tables) -> None:
        """All of it, from the clean tables."""
        self._store(tables, self._computed(tables))

    def read(self, tables: Tables) -> DataFrame:
        return self.table(tables).read()

    def refresh(self, tables: Tables, changed: Mapping[str, DataFrame]) -> list[int]:
        """Bring the fact up to the clean tables, of which `changed` differs; returns the parts replaced.

        Doing it again changes nothing. The owners are stored, so that neither side of the write computes them
        again; their parts' numbers come to the driver. Clean tables are read in the ranges of those parts.
        """
        spec, path = self.spec, workspace(self.spark, "owners")
        affected_owners(spec, tables, changed).write.parquet(path)
        owners = self.spark.read.schema(f"{OWNER} long").parquet(path)
        ranges = KeyRanges(OWNER, self.width)
        counted = owners.groupBy(ranges.of().alias(PLACE)).agg(F.count(F.lit(1)).alias("_n")).collect()
        anew = [part for part, n in counted if n * ANEW >= self.width]
        merged = [part for part, n in counted if n * ANEW < self.width]
        rows = []
        if anew:
            own = {table: tables[table].where(ranges.exactly(anew, column)) for table, column in spec.owned.items()}
            rows.append(self._computed(ChainMap(own, tables)))
        if merged:
            rows.append(self._merged(tables, owners.where(ranges.exactly(merged)), merged))
        if rows:
            self._store(tables, reduce(DataFrame.unionByName, rows), anew + merged)
        return sorted(anew + merged)

    def _merged(self, tables: Tables, owners: DataFrame, parts: list[int]) -> DataFrame:
        """The parts' rows with those of the owners computed and all others as they are, laid out by part."""
        spec, ranges = self.spec, KeyRanges(OWNER, self.width)

        def of_owners(table: str, column: str) -> DataFrame:
            rows = tables[table].where(ranges.within(parts, column))
            return rows.join(owners, F.col(column) == F.col(OWNER), "left_semi")

        own = {table: of_owners(table, column) for table, column in spec.owned.items()}
        rows = spec.plan(ChainMap(own, tables))
        kept = self.table(tables).read(parts).join(owners, F.col(spec.owner) == F.col(OWNER), "left_anti")
        return self._spread(kept.unionByName(rows))


def refresh_gold(
    loads: Iterable[IncrementalLoad], database: str, facts: Iterable[MaintainedFact], tables: Callable[[], Tables]
) -> None:
    """Facts, then clean tables, brought up to what the loads have logged since they were last published.

    `tables` gives the clean tables without the loads' own, which are read with their logs. Facts come first: should
    the job die, the logs are still there and the next one does the same again.
    """
    loads = list(loads)
    after = ChainMap({load.table: load.current() for load in loads}, tables())
    changed = {load.table: load.log.changed() for load in loads}
    for fact in facts:
        fact.refresh(after, changed)
    for load in loads:
        load.publish(database)
