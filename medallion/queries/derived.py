"""Inputs of the catalogue queries, derived from the given tables row by row (no sampling, no shuffle)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.dictionary import DataDictionary
from medallion.operators.projection import select_once
from medallion.sources.cdc import current_documents

# (table, column, ordinal, nullable, source type, primary key, declared type)
DICTIONARY_ROWS = [
    ("orders", "o_orderkey", 1, False, "bigint", True, "bigint"),
    ("orders", "o_custkey", 2, False, "bigint", False, "bigint"),
    ("orders", "o_orderstatus", 3, False, "nvarchar", False, "string"),
    ("orders", "o_totalprice", 4, False, "decimal", False, "double"),
    ("orders", "o_orderdate", 6, True, "datetime2", False, "string"),
    ("orders", "o_orderpriority", 7, True, "nvarchar", False, "string"),
    ("events", "event_id", 1, False, "bigint", False, "bigint"),
    ("events", "ts", 2, False, "datetime2", False, "string"),
    ("events", "user_id", 3, False, "bigint", True, "bigint"),
    ("events", "event_type", 4, False, "nvarchar", True, "string"),
    ("events", "value", 5, False, "decimal", False, "double"),
    ("events", "props", 6, True, "nvarchar", False, "string"),
    ("props", "k", 1, True, "int", True, "integer"),
]


#: Every table of the source.
SOURCE_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def dictionary(*tables: str) -> DataDictionary:
    """The dictionary of the given tables, without names of all."""
    return DataDictionary.from_rows([r for r in DICTIONARY_ROWS if not tables or r[0] in tables])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int, key: str = "o_orderkey"):
    return F.col(key) % n == 0


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as text, with blank, mistyped and misdated values at fixed keys."""
    derived = {
        "o_orderkey": F.col("o_orderkey").cast("string"),
        "o_custkey": F.when(_every(101), "abc")
        .when(_every(103), None)
        .otherwise(F.col("o_custkey").cast("string")),
        "o_orderstatus": F.when(_every(109), "")
        .when(_every(113), "NULL")
        .when(_every(127), "None")
        .otherwise(F.col("o_orderstatus")),
        "o_totalprice": F.when(_every(107), "n/a").otherwise(
            F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        ),
        "o_orderdate": F.when(_every(131), "not-a-date")
        .when(_every(137), None)
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")),
    }
    return select_once(table(spark, sf_dir, "orders"), ["o_orderpriority"], derived)


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON documents; some lack a field, some have one the dictionary does not know."""
    price = F.when(~_every(4), F.col("o_totalprice"))
    note = F.when(_every(5), F.col("o_orderpriority"))
    body = F.struct(
        F.col("o_orderkey").cast("string").alias("_id"),
        "o_orderkey", "o_custkey", "o_orderstatus",
        price.alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        note.alias("o_note"),
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_json(body).alias("document"))


def _event_document():
    # Timestamps as text: to_json on its own would cut them to milliseconds.
    return F.struct(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "user_id", "event_type", "value", "props",
    )


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of `events` as a change event (event JSON, seq); some are deletes, some cut off,
    some updates without their document."""
    op = F.when(_every(50, "event_id"), "delete").when(_every(3, "event_id"), "insert").otherwise("update")
    bare = _every(50, "event_id") | (_every(7, "event_id") & ~_every(3, "event_id"))
    envelope = F.to_json(
        F.struct(
            op.alias("operationType"),
            F.struct(F.lit("shop").alias("db"), F.col("event_type").alias("coll")).alias("ns"),
            F.struct(F.col("event_id").cast("string").alias("_id")).alias("documentKey"),
            F.when(~bare, _event_document()).alias("fullDocument"),
        )
    )
    cut_off = F.lit('{"operationType": "insert", "ns": {"db": "sh')
    return table(spark, sf_dir, "events").select(
        F.when(_every(97, "event_id"), cut_off).otherwise(envelope).alias("event"),
        F.col("event_id").alias("seq"),
    )


def event_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current documents of `events` by collection; every eleventh is gone."""
    rows = table(spark, sf_dir, "events").where(~_every(11, "event_id"))
    rows = rows.select("event_type", F.col("event_id").alias("_id"), F.to_json(_event_document()).alias("document"))
    return current_documents(rows, F.lit("shop"), F.col("event_type"), "_id", "document")


def shared_key_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of `events` as an update of the document of its user, which each collection has its own of; every
    other one without document, some without key."""
    key = F.when(~_every(13, "event_id"), F.col("user_id").cast("string"))
    envelope = F.struct(
        F.lit("update").alias("operationType"),
        F.struct(F.lit("shop").alias("db"), F.col("event_type").alias("coll")).alias("ns"),
        F.struct(key.alias("_id")).alias("documentKey"),
        F.when(~_every(2, "event_id"), _event_document()).alias("fullDocument"),
    )
    return table(spark, sf_dir, "events").select(F.to_json(envelope).alias("event"), F.col("event_id").alias("seq"))


def shared_key_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By collection and user the document of the last event; users divisible by eleven have none."""
    rows = table(spark, sf_dir, "events").where(~_every(11, "user_id"))
    last = rows.groupBy("event_type", "user_id").agg(F.max("event_id").alias("event_id"))
    last = last.withColumn("document", F.to_json(F.struct("event_id")))
    return current_documents(last, F.lit("shop"), F.col("event_type"), "user_id", "document")


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event documents, some cut off."""
    document = F.when(_every(97, "event_id"), F.lit('{"event_id": ')).otherwise(F.to_json(_event_document()))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("source_id"), document.alias("document"))


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a value that is no number in every eleventh."""
    text = F.col("value").cast("decimal(18,2)").cast("string")
    return table(spark, sf_dir, "events").withColumn(
        "value", F.when(_every(11, "event_id"), "abc").otherwise(text)
    )


def nested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as nested documents: structs in structs, and a list that may be empty or absent."""
    amounts = F.array(
        F.struct(F.lit("price").alias("kind"), F.col("l_extendedprice").alias("amount")),
        F.struct(F.lit("discount").alias("kind"), F.col("l_discount").alias("amount")),
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.struct("l_shipdate", F.struct("l_returnflag", "l_linestatus").alias("st")).alias("hdr"),
        F.when(F.col("l_partkey") % 9 == 0, None)
        .when(F.col("l_partkey") % 9 == 1, F.slice(amounts, 1, 0))
        .otherwise(amounts)
        .alias("items"),
    )


# Clean tables the gold plans read: source table, and column = SQL expression.
SILVER: dict[str, tuple[str, dict[str, str]]] = {
    "Cities": ("customer", {
        "CityID": "c_custkey", "CityName": "c_name", "StateProvinceID": "c_nationkey",
        "Location": "c_mktsegment",
    }),
    "StateProvinces": ("nation", {
        "StateProvinceID": "n_nationkey", "StateProvinceName": "n_name", "CountryID": "n_regionkey",
    }),
    "Countries": ("region", {
        "CountryID": "r_regionkey", "CountryName": "r_name", "Continent": "lower(r_name)",
        "Region": "substring(r_name, 1, 2)", "Subregion": "substring(r_name, 2, 3)",
        "LatestRecordedPopulation": "r_regionkey * 1000",
    }),
    "Customers": ("customer", {
        "CustomerID": "c_custkey", "CustomerName": "c_name",
        "BillToCustomerID": "c_custkey - c_custkey % 10", "CustomerCategoryID": "c_nationkey % 5",
        "BuyingGroupID": "case when c_custkey % 7 <> 0 then c_nationkey end",
        "PrimaryContactPersonID": "c_custkey", "DeliveryCityID": "c_nationkey",
        "DeliveryPostalCode": "c_mktsegment",
    }),
    "BuyingGroups": ("nation", {
        "BuyingGroupID": "n_nationkey", "BuyingGroupName": "n_name",
    }),
    "CustomerCategories": ("region", {
        "CustomerCategoryID": "r_regionkey", "CustomerCategoryName": "r_name",
    }),
    "People": ("customer", {
        "PersonID": "c_custkey", "FullName": "c_name", "PreferredName": "c_mktsegment",
        "IsEmployee": "c_acctbal < 0", "IsSalesperson": "c_nationkey % 2 = 0",
    }),
    "PackageTypes": ("nation", {
        "PackageTypeID": "n_nationkey", "PackageTypeName": "n_name",
    }),
    "Colors": ("region", {
        "ColorID": "r_regionkey", "ColorName": "r_name",
    }),
    "StockItems": ("part", {
        "StockItemID": "p_partkey", "StockItemName": "p_name",
        "ColorID": "case when p_partkey % 3 <> 0 then p_partkey % 7 end", "UnitPackageID": "p_size % 25",
        "OuterPackageID": "(p_size + 1) % 25", "Brand": "p_brand", "Size": "p_type",
        "LeadTimeDays": "p_size", "QuantityPerOuter": "p_size", "IsChillerStock": "p_size > 25",
        "Barcode": "cast(p_partkey as string)", "UnitPrice": "p_retailprice",
        "RecommendedRetailPrice": "p_retailprice", "TypicalWeightPerUnit": "p_retailprice",
    }),
    "Suppliers": ("supplier", {
        "SupplierID": "s_suppkey", "SupplierName": "s_name", "SupplierCategoryID": "s_nationkey % 5",
        "PrimaryContactPersonID": "s_suppkey", "SupplierReference": "cast(s_suppkey as string)",
        "PaymentDays": "s_nationkey", "DeliveryPostalCode": "cast(s_nationkey as string)",
    }),
    "SupplierCategories": ("region", {
        "SupplierCategoryID": "r_regionkey", "SupplierCategoryName": "r_name",
    }),
    "StockItemTransactions": ("events", {
        "StockItemTransactionID": "event_id", "StockItemID": "user_id",
        "TransactionTypeID": "length(event_type)", "CustomerID": "user_id",
        "InvoiceID": "case when event_id % 2 = 0 then event_id end",
        "SupplierID": "case when event_id % 2 = 1 then user_id end",
        "PurchaseOrderID": "case when event_id % 2 = 1 then event_id end", "TransactionOccurredWhen": "ts",
        "Quantity": "value",
    }),
    "Orders": ("orders", {
        "OrderID": "o_orderkey", "CustomerID": "o_custkey", "SalespersonPersonID": "o_custkey % 7",
        "PickedByPersonID": "case when o_orderstatus = 'F' then o_custkey % 5 end",
        "BackorderOrderID": "case when o_orderkey % 5 = 0 then o_orderkey + 1 end",
        "OrderDate": "o_orderdate", "LastEditedWhen": "o_orderdate",
    }),
    "OrderLines": ("lineitem", {
        "OrderID": "l_orderkey", "StockItemID": "l_partkey", "Description": "l_returnflag",
        "PackageTypeID": "l_suppkey % 25", "Quantity": "cast(l_quantity as int)",
        "UnitPrice": "l_extendedprice", "TaxRate": "l_tax * 100", "PickingCompletedWhen": "l_shipdate",
        "LastEditedWhen": "l_shipdate",
    }),
    "PurchaseOrders": ("orders", {
        "PurchaseOrderID": "o_orderkey", "SupplierID": "o_custkey", "OrderDate": "o_orderdate",
        "LastEditedWhen": "o_orderdate",
    }),
    "PurchaseOrderLines": ("lineitem", {
        "PurchaseOrderLineID": "l_linenumber", "PurchaseOrderID": "l_orderkey", "StockItemID": "l_partkey",
        "OrderedOuters": "cast(l_quantity as int)", "ReceivedOuters": "l_linenumber",
        "PackageTypeID": "l_linenumber", "IsOrderLineFinalized": "l_linestatus = 'F'",
        "LastEditedWhen": "l_shipdate",
    }),
    "Invoices": ("orders", {
        "InvoiceID": "o_orderkey", "CustomerID": "o_custkey",
        "BillToCustomerID": "case when o_orderkey % 11 = 0 then -1 else o_custkey - o_custkey % 10 end",
        "SalespersonPersonID": "o_custkey % 7", "InvoiceDate": "o_orderdate",
        "ConfirmedDeliveryTime": "case when o_orderstatus = 'F' then o_orderdate end",
        "LastEditedWhen": "o_orderdate",
    }),
    "InvoiceLines": ("lineitem", {
        "InvoiceLineID": "l_linenumber", "InvoiceID": "l_orderkey", "StockItemID": "l_partkey", "Description": "l_returnflag",
        "PackageTypeID": "l_suppkey % 25", "Quantity": "cast(l_quantity as int)",
        "UnitPrice": "l_extendedprice", "TaxRate": "l_tax * 100", "TaxAmount": "l_tax",
        "LineProfit": "l_discount", "ExtendedPrice": "l_extendedprice", "LastEditedWhen": "l_shipdate",
    }),
    "CustomerTransactions": ("orders", {
        "CustomerTransactionID": "o_orderkey", "CustomerID": "o_custkey - o_custkey % 10",
        "TransactionTypeID": "length(o_orderpriority)",
        "InvoiceID": "case when o_orderstatus <> 'P' then o_orderkey * 2 end",
        "PaymentMethodID": "case when o_orderstatus = 'P' then 4 end", "TransactionDate": "o_orderdate",
        "AmountExcludingTax": "o_totalprice", "TaxAmount": "o_totalprice * 0",
        "TransactionAmount": "o_totalprice", "OutstandingBalance": "o_totalprice * 0",
        "IsFinalized": "o_orderstatus = 'F'", "LastEditedWhen": "o_orderdate",
    }),
    "SupplierTransactions": ("lineitem", {
        "SupplierTransactionID": "l_orderkey * 10 + l_linenumber", "SupplierID": "l_suppkey",
        "TransactionTypeID": "l_linenumber", "PurchaseOrderID": "l_orderkey",
        "PaymentMethodID": "case when l_returnflag = 'R' then 4 end",
        "SupplierInvoiceNumber": "l_returnflag", "TransactionDate": "l_shipdate",
        "AmountExcludingTax": "l_extendedprice", "TaxAmount": "l_tax",
        "TransactionAmount": "l_extendedprice", "OutstandingBalance": "l_discount",
        "IsFinalized": "l_linestatus = 'F'", "LastEditedWhen": "l_shipdate",
    }),
}


def sources_before(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders, lines and events before the last of them came: every tenth isn't there."""
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}
    return {name: table(spark, sf_dir, name).where(~_every(10, key)) for name, key in keys.items()}


def sources_after(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All of them, some changed: other customers, quantities, cities, item sizes, and a package's name."""
    changes = {
        "orders": ("o_custkey", F.when(_every(7), 1).otherwise(F.col("o_custkey"))),
        "lineitem": ("l_quantity", F.col("l_quantity") + F.when(_every(11, "l_orderkey"), 1).otherwise(0)),
        "customer": ("c_nationkey", F.when(_every(50, "c_custkey"), 99).otherwise(F.col("c_nationkey"))),
        "part": ("p_size", F.when(_every(40, "p_partkey"), 1).otherwise(F.col("p_size"))),
        "nation": ("n_name", F.when(F.col("n_nationkey") == 3, "RENAMED").otherwise(F.col("n_name"))),
        "events": ("value", F.when(_every(9, "event_id"), 1.0).otherwise(F.col("value"))),
    }
    return {
        name: table(spark, sf_dir, name).withColumn(column, value.cast(table(spark, sf_dir, name).schema[column].dataType))
        for name, (column, value) in changes.items()
    }


def changed_rows(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows of the clean tables that `sources_before` and `sources_after` differ in."""
    new = {"OrderID": 7, "PurchaseOrderID": 7, "InvoiceID": 7, "CustomerTransactionID": 7, "StockItemTransactionID": 9}
    lines = {"OrderLines": "OrderID", "PurchaseOrderLines": "PurchaseOrderID", "InvoiceLines": "InvoiceID"}
    headers = {
        "Orders": "OrderID", "PurchaseOrders": "PurchaseOrderID", "Invoices": "InvoiceID",
        "CustomerTransactions": "CustomerTransactionID", "StockItemTransactions": "StockItemTransactionID",
    }
    changed = {name: tables[name].where(_every(10, key) | _every(new[key], key)) for name, key in headers.items()}
    changed |= {name: tables[name].where(_every(10, key) | _every(11, key)) for name, key in lines.items()}
    changed["SupplierTransactions"] = tables["SupplierTransactions"].where("PurchaseOrderID % 10 = 0")
    changed["Customers"] = tables["Customers"].where(_every(50, "CustomerID"))
    changed["StockItems"] = tables["StockItems"].where(_every(40, "StockItemID"))
    changed["PackageTypes"] = tables["PackageTypes"].where("PackageTypeID = 3")
    return changed


class SilverTables(Mapping):
    """The given tables under the names and columns the gold plans read, built when asked for.

    `sources` are frames to take in place of given tables.
    """

    def __init__(
        self, spark: SparkSession, sf_dir: str, sources: Mapping[str, DataFrame] | None = None, **replaced: DataFrame
    ):
        self._spark, self._sf_dir, self._sources, self._replaced = spark, sf_dir, sources or {}, replaced

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._replaced:
            return self._replaced[name]
        source, columns = SILVER[name]
        rows = self._sources[source] if source in self._sources else table(self._spark, self._sf_dir, source)
        return rows.selectExpr(*[f"{sql} as {column}" for column, sql in columns.items()])

    def __iter__(self):
        return iter(SILVER)

    def __len__(self) -> int:
        return len(SILVER)
