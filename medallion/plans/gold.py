"""Gold tables from clean tables.

Each builder takes the clean tables by name and returns one lazy plan. No join carries a broadcast
hint: dimensions here (customers, people, stock items) grow with the business, so the planner's own
size checks, static and at run time, decide; what it does not broadcast is a sort-merge join whose
skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.functions.scalars import (
    amount_excluding_tax,
    later_of,
    money,
    parse_timestamp,
    tax_amount,
)
from medallion.operators.joins import left_lookup
from medallion.operators.setops import union_all
from medallion.session import run_parallel, workspace
from medallion.sinks.catalog import create_database, register_gold
from medallion.sinks.writers import remove_directory, write_gold, write_working

Tables = Mapping[str, DataFrame]

# Key of a line, carried along for ordering and left out of the table.
LINE_ID = "_line_id"
# Headers and lines may both name the part of a stored fact that their rows go to; the fact's rows name it then.
PLACE = "_place"


def _placed(*tables: DataFrame) -> list[str]:
    return [PLACE] if all(PLACE in table.columns for table in tables) else []


def _joined(
    lines: DataFrame, header: DataFrame, key: str, place: list[str], dimensions: dict[str, DataFrame]
) -> DataFrame:
    """Lines with their headers, and with dimensions by the name of their key.

    Stock items may be too many to broadcast. They join the lines alone, which are narrower than lines with headers,
    so what that shuffles is less, and the rows come out in the order of the headers' key.

    With a place, lines and headers are laid out by it and not by the key, and join last: the rows come out as they
    are stored.
    """
    first = [k for k in dimensions if place or k == "StockItemID"]
    lines = reduce(lambda rows, k: rows.join(dimensions[k], k), first, lines)
    if not place:
        others = [k for k in dimensions if k not in first]
        return reduce(lambda rows, k: rows.join(dimensions[k], k), others, lines.join(header, key))
    return lines.repartition(PLACE).join(header.repartition(PLACE), [PLACE, key])


def dim_city(t: Tables) -> DataFrame:
    """Cities with state and country; the population is the country's."""
    country = t["Countries"].select(
        "CountryID", "CountryName", "Continent", "Region", "Subregion", "LatestRecordedPopulation"
    )
    state = t["StateProvinces"].select("StateProvinceID", "StateProvinceName", "CountryID")
    city = t["Cities"].select("CityID", F.col("CityName").alias("City"), "Location", "StateProvinceID")
    return city.join(state.join(country, "CountryID"), "StateProvinceID").select(
        "CityID", "City", "StateProvinceName", "Location", "CountryName", "Continent", "Region",
        "Subregion", "LatestRecordedPopulation",
    )


def dim_customer(t: Tables) -> DataFrame:
    """Customers of a buying group, with category, contact and the customer who is billed."""
    customers = t["Customers"]
    billed = customers.select(
        F.col("CustomerID").alias("BillToCustomerID"), F.col("CustomerName").alias("BillToCustomer")
    )
    contact = t["People"].select(F.col("PersonID").alias("PrimaryContactPersonID"), "FullName")
    return (
        customers.join(t["BuyingGroups"].select("BuyingGroupID", "BuyingGroupName"), "BuyingGroupID")
        .join(
            t["CustomerCategories"].select("CustomerCategoryID", "CustomerCategoryName"),
            "CustomerCategoryID",
        )
        .join(billed, "BillToCustomerID")
        .join(contact, "PrimaryContactPersonID")
        .select(
            "CustomerID", "CustomerName", "BillToCustomer", "CustomerCategoryName", "BuyingGroupName",
            "FullName", "DeliveryPostalCode",
        )
    )


def dim_employee(t: Tables) -> DataFrame:
    return t["People"].where(F.col("IsEmployee")).select(
        F.col("PersonID").alias("WWI_Employee_ID"), "FullName", "PreferredName", "IsSalesperson"
    )


def dim_stock_item(t: Tables) -> DataFrame:
    """Stock items; package types play two roles, the colour may be unknown."""
    def package(role: str, name: str) -> DataFrame:
        return t["PackageTypes"].select(
            F.col("PackageTypeID").alias(role), F.col("PackageTypeName").alias(name)
        )

    items = (
        t["StockItems"]
        .join(package("UnitPackageID", "Selling_Package"), "UnitPackageID")
        .join(package("OuterPackageID", "Buying_Package"), "OuterPackageID")
    )
    colors = t["Colors"].select(F.col("ColorID").alias("_ColorID"), "ColorName")
    return left_lookup(items, colors, "ColorID", "_ColorID", ["StockItemID"]).select(
        "StockItemID", "StockItemName", "ColorName", "Selling_Package", "Buying_Package", "Brand",
        "Size", "LeadTimeDays", "QuantityPerOuter", "IsChillerStock", "Barcode", "UnitPrice",
        "RecommendedRetailPrice", "TypicalWeightPerUnit",
    )


def dim_supplier(t: Tables) -> DataFrame:
    contact = t["People"].select(F.col("PersonID").alias("PrimaryContactPersonID"), "FullName")
    return (
        t["Suppliers"]
        .join(
            t["SupplierCategories"].select("SupplierCategoryID", "SupplierCategoryName"),
            "SupplierCategoryID",
        )
        .join(contact, "PrimaryContactPersonID")
        .select(
            "SupplierID", "SupplierName", "SupplierCategoryName", "FullName", "SupplierReference",
            "PaymentDays", "DeliveryPostalCode",
        )
    )


def fact_stock_movement(t: Tables) -> DataFrame:
    """Stock item transactions with a date key."""
    moves = t["StockItemTransactions"]
    occurred = parse_timestamp(
        F.col("TransactionOccurredWhen"), moves.schema["TransactionOccurredWhen"].dataType
    )
    return moves.select(
        occurred.cast("date").alias("Date_Key"),
        "StockItemTransactionID", "InvoiceID", "PurchaseOrderID",
        F.col("Quantity").try_cast("int").alias("Quantity"),
        "StockItemID", "CustomerID", "SupplierID", "TransactionTypeID", "TransactionOccurredWhen",
    )


def _package(t: Tables) -> DataFrame:
    return t["PackageTypes"].select("PackageTypeID", F.col("PackageTypeName").alias("Package"))


def _last_modified(line: str, header: str):
    return later_of(F.col(line), F.col(header)).alias("Last_Modified_When")


def fact_order_line(t: Tables) -> DataFrame:
    """Order lines with amounts; amounts are computed exactly and given as double.

    Customers join the orders, before the lines do: lines are never shuffled by a customer, whose share may be large.
    """
    place = _placed(t["Orders"], t["OrderLines"])
    orders = t["Orders"].select(
        "OrderID", "OrderDate", "BackorderOrderID", "CustomerID", "SalespersonPersonID",
        "PickedByPersonID", F.col("LastEditedWhen").alias("_OrderEdited"), *place,
    ).join(t["Customers"].select("CustomerID", "DeliveryCityID"), "CustomerID")
    lines = t["OrderLines"].select(
        "OrderID", "PickingCompletedWhen", "Description", "PackageTypeID", "Quantity", "UnitPrice",
        "TaxRate", "StockItemID", F.col("LastEditedWhen").alias("_LineEdited"), *place,
    )
    excluding = amount_excluding_tax(F.col("Quantity"), F.col("UnitPrice"))
    tax = tax_amount(F.col("Quantity"), F.col("UnitPrice"), F.col("TaxRate"))
    return (
        _joined(lines, orders, "OrderID", place, {"PackageTypeID": _package(t)})
        .select(
            "OrderDate", "PickingCompletedWhen", "OrderID", "BackorderOrderID", "Description", "Package",
            "Quantity", "UnitPrice", "TaxRate",
            excluding.cast("double").alias("Total_Excluding_Tax"),
            tax.cast("double").alias("Tax_Amount"),
            (excluding + tax).cast("double").alias("Total_Including_Tax"),
            "DeliveryCityID", "CustomerID", "StockItemID", "SalespersonPersonID", "PickedByPersonID",
            _last_modified("_LineEdited", "_OrderEdited"),
            *place,
        )
    )


def _purchase(t: Tables) -> DataFrame:
    place = _placed(t["PurchaseOrders"], t["PurchaseOrderLines"])
    orders = t["PurchaseOrders"].select(
        "PurchaseOrderID", "OrderDate", "SupplierID", F.col("LastEditedWhen").alias("_OrderEdited"), *place
    )
    lines = t["PurchaseOrderLines"].select(
        "PurchaseOrderID", "OrderedOuters", "ReceivedOuters", "PackageTypeID", "IsOrderLineFinalized",
        "StockItemID", F.col("LastEditedWhen").alias("_LineEdited"),
        F.col("PurchaseOrderLineID").alias(LINE_ID), *place,
    )
    items = t["StockItems"].select("StockItemID", "QuantityPerOuter")
    return (
        _joined(lines, orders, "PurchaseOrderID", place, {"StockItemID": items, "PackageTypeID": _package(t)})
        .select(
            "OrderDate", "PurchaseOrderID", "OrderedOuters",
            (F.col("OrderedOuters") * F.col("QuantityPerOuter")).alias("Ordered_Quantity"),
            "ReceivedOuters", "Package", "IsOrderLineFinalized", "SupplierID", "StockItemID",
            _last_modified("_LineEdited", "_OrderEdited"),
            LINE_ID, *place,
        )
    )


def fact_purchase(t: Tables) -> DataFrame:
    """Purchase order lines; ordered quantity is outers times the item's quantity per outer."""
    return _purchase(t).drop(LINE_ID)


def _sales(t: Tables) -> DataFrame:
    place = _placed(t["Invoices"], t["InvoiceLines"])
    # The billed customer only has to exist: a semi join on invoices, before lines join.
    customers = t["Customers"]
    billed = customers.select(F.col("CustomerID").alias("BillToCustomerID"))
    invoices = (
        t["Invoices"]
        .select(
            "InvoiceID", "InvoiceDate", "ConfirmedDeliveryTime", "CustomerID", "BillToCustomerID",
            "SalespersonPersonID", F.col("LastEditedWhen").alias("_InvoiceEdited"), *place,
        )
        .join(customers.select("CustomerID", "DeliveryCityID"), "CustomerID")
        .join(billed, "BillToCustomerID", "left_semi")
    )
    lines = t["InvoiceLines"].select(
        "InvoiceID", "Description", "PackageTypeID", "Quantity", "UnitPrice", "TaxRate", "TaxAmount",
        "LineProfit", "ExtendedPrice", "StockItemID", F.col("LastEditedWhen").alias("_LineEdited"),
        F.col("InvoiceLineID").alias(LINE_ID), *place,
    )
    items = t["StockItems"].select("StockItemID", "IsChillerStock")
    chilled = F.col("IsChillerStock")
    excluding = money(F.col("ExtendedPrice")) - money(F.col("TaxAmount"))
    return (
        _joined(lines, invoices, "InvoiceID", place, {"StockItemID": items, "PackageTypeID": _package(t)})
        .select(
            "InvoiceDate", "ConfirmedDeliveryTime", "InvoiceID", "Description", "Package", "Quantity",
            "UnitPrice", "TaxRate",
            excluding.cast("double").alias("Total_Excluding_Tax"),
            "TaxAmount",
            F.col("LineProfit").alias("Profit"),
            F.col("ExtendedPrice").alias("Total_Including_Tax"),
            F.when(~chilled, F.col("Quantity")).otherwise(0).alias("Total_Dry_Items"),
            F.when(chilled, F.col("Quantity")).otherwise(0).alias("Total_Chiller_Items"),
            "DeliveryCityID", "CustomerID", "BillToCustomerID", "StockItemID", "SalespersonPersonID",
            _last_modified("_LineEdited", "_InvoiceEdited"),
            LINE_ID, *place,
        )
    )


def fact_sales(t: Tables) -> DataFrame:
    """Invoice lines with profit and the split into dry and chilled items."""
    return _sales(t).drop(LINE_ID)


def fact_transactions(t: Tables) -> DataFrame:
    """Customer and supplier transactions in one table.

    A customer transaction belongs to its invoice's customer where it has one. Payments have no
    invoice, so NULL invoice keys are common and are spread over the join's partitions.
    """
    amounts = [
        "AmountExcludingTax", "TaxAmount", "TransactionAmount", "OutstandingBalance", "IsFinalized",
    ]
    invoices = t["Invoices"].select(
        F.col("InvoiceID").alias("_InvoiceID"), F.col("CustomerID").alias("_InvoiceCustomerID")
    )
    no_key = F.lit(None).cast("int")
    customer = left_lookup(
        t["CustomerTransactions"], invoices, "InvoiceID", "_InvoiceID", ["CustomerTransactionID"]
    ).select(
        "TransactionDate", "CustomerTransactionID", no_key.alias("SupplierTransactionID"), "InvoiceID",
        no_key.alias("PurchaseOrderID"), F.lit(None).cast("string").alias("SupplierInvoiceNumber"),
        *amounts,
        F.coalesce("_InvoiceCustomerID", "CustomerID").alias("CustomerID"),
        F.col("CustomerID").alias("BillToCustomerID"),
        no_key.alias("SupplierID"), "TransactionTypeID", "PaymentMethodID", "LastEditedWhen",
    )
    supplier = t["SupplierTransactions"].select(
        "TransactionDate", no_key.alias("CustomerTransactionID"), "SupplierTransactionID",
        no_key.alias("InvoiceID"), "PurchaseOrderID", "SupplierInvoiceNumber", *amounts,
        no_key.alias("CustomerID"), no_key.alias("BillToCustomerID"),
        "SupplierID", "TransactionTypeID", "PaymentMethodID", "LastEditedWhen",
    )
    return union_all(customer, supplier)


@dataclass(frozen=True)
class GoldTable:
    """`plan` may carry the line key besides the table's columns, to order rows by when written."""

    plan: Callable[[Tables], DataFrame]
    order_by: tuple[str, ...] = ()


# Directory names of the gold layer. `Movement` holds order lines and `Order` purchases; both names
# are kept for readers of the existing layer, next to names that say what the tables hold.
GOLD: dict[str, GoldTable] = {
    "Cities": GoldTable(dim_city),
    "Customer": GoldTable(dim_customer),
    "Employee": GoldTable(dim_employee),
    "StockItem": GoldTable(dim_stock_item),
    "Supplier": GoldTable(dim_supplier),
    "StockMovement": GoldTable(fact_stock_movement),
    "Movement": GoldTable(fact_order_line),
    "Order": GoldTable(_purchase, ("PurchaseOrderID", LINE_ID)),
    "Purchase": GoldTable(_purchase, ("PurchaseOrderID", LINE_ID)),
    "Sales": GoldTable(_sales, ("InvoiceID", LINE_ID)),
    "Transactions": GoldTable(fact_transactions),
}


def build(name: str, tables: Tables) -> DataFrame:
    return GOLD[name].plan(tables).drop(LINE_ID)


def build_all(
    spark: SparkSession,
    tables: Tables,
    gold_path: str,
    names: Iterable[str] | None = None,
    database: str | None = None,
    total_order: bool = False,
    parallel: int = 4,
) -> None:
    """Write gold tables, one execution each, and register them as `<name>_gold`.

    Tables of one plan are written from the same rows, which a working table keeps for that: it is smaller than
    cached rows are on disk, and leaves the memory to the joins.
    """
    alike: dict[GoldTable, list[str]] = {}
    for name in names if names is not None else GOLD:
        alike.setdefault(GOLD[name], []).append(name)

    def write(table: GoldTable) -> None:
        rows, kept = table.plan(tables), None
        try:
            if len(alike[table]) > 1:  # joined once
                kept = workspace(spark, "alike")
                rows = write_working(rows, kept)
            for name in alike[table]:
                write_gold(rows, f"{gold_path}/{name}", list(table.order_by), [LINE_ID], total_order)
        finally:
            if kept:
                remove_directory(spark, kept)

    run_parallel(spark, write, alike, parallel)
    if database:
        create_database(spark, database)
        register_gold(spark, database, gold_path)
