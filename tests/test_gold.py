"""Gold plans on literal clean tables, expectations worked out by hand."""

from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pytest

from medallion.plans import gold

T1, T2, T3 = datetime(2024, 1, 1, 8), datetime(2024, 1, 2, 8), datetime(2024, 1, 3, 8)


@pytest.fixture(scope="module")
def t(spark):
    def frame(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return {
        "Cities": frame("CityID int, CityName string, StateProvinceID int, Location string, LatestRecordedPopulation int",
                        (1, "Oslo", 10, "x", 5), (2, "Nowhere", 99, None, 1)),
        "StateProvinces": frame("StateProvinceID int, StateProvinceName string, CountryID int, LatestRecordedPopulation int",
                                (10, "Viken", 100, 50)),
        "Countries": frame("CountryID int, CountryName string, Continent string, Region string, Subregion string, LatestRecordedPopulation int",
                           (100, "Norway", "Europe", "EU", "North", 500)),
        "Customers": frame("CustomerID int, CustomerName string, BillToCustomerID int, CustomerCategoryID int, BuyingGroupID int, PrimaryContactPersonID int, DeliveryCityID int, DeliveryPostalCode string",
                           (1, "Head", 1, 5, 7, 21, 1, "0001"), (2, "Branch", 1, 5, 7, 22, 2, "0002"), (3, "Single", 3, 5, None, 21, 1, "0003")),
        "BuyingGroups": frame("BuyingGroupID int, BuyingGroupName string", (7, "Group")),
        "CustomerCategories": frame("CustomerCategoryID int, CustomerCategoryName string", (5, "Shop")),
        "People": frame("PersonID int, FullName string, PreferredName string, IsEmployee boolean, IsSalesperson boolean",
                        (21, "Ann A", "Ann", True, False), (22, "Bo B", "Bo", False, False), (23, "Cy C", "Cy", None, True)),
        "PackageTypes": frame("PackageTypeID int, PackageTypeName string", (1, "Each"), (2, "Box")),
        "Colors": frame("ColorID int, ColorName string", (1, "red")),
        "StockItems": frame("StockItemID int, StockItemName string, ColorID int, UnitPackageID int, OuterPackageID int, Brand string, Size string, LeadTimeDays int, QuantityPerOuter int, IsChillerStock boolean, Barcode string, UnitPrice double, RecommendedRetailPrice double, TypicalWeightPerUnit double",
                            (1, "Mug", 1, 1, 2, "B", "S", 3, 12, False, None, 1.5, 2.0, 0.1),
                            (2, "Choc", None, 2, 2, None, None, 1, 24, True, "c", 3.0, 4.0, 0.2),
                            (3, "Odd", 9, 1, 1, None, None, 1, 1, None, None, 1.0, None, 0.3)),
        "Suppliers": frame("SupplierID int, SupplierName string, SupplierCategoryID int, PrimaryContactPersonID int, SupplierReference string, PaymentDays int, DeliveryPostalCode string",
                           (1, "Sup", 3, 22, None, 14, "9"), (2, "Lost", 4, 22, "r", 7, "8")),
        "SupplierCategories": frame("SupplierCategoryID int, SupplierCategoryName string", (3, "Toys")),
        "StockItemTransactions": frame("StockItemTransactionID int, StockItemID int, TransactionTypeID int, CustomerID int, InvoiceID int, SupplierID int, PurchaseOrderID int, TransactionOccurredWhen timestamp_ntz, Quantity double",
                                       (1, 2, 10, 1, 5, None, None, T1, -3.0)),
        "Orders": frame("OrderID int, CustomerID int, SalespersonPersonID int, PickedByPersonID int, BackorderOrderID int, OrderDate timestamp_ntz, LastEditedWhen timestamp_ntz",
                        (1, 2, 21, None, None, T1, T2), (2, 99, 21, None, None, T1, T2)),
        "OrderLines": frame("OrderLineID int, OrderID int, StockItemID int, Description string, PackageTypeID int, Quantity int, UnitPrice double, TaxRate double, PickingCompletedWhen timestamp_ntz, LastEditedWhen timestamp_ntz",
                            (1, 1, 1, "Mug", 1, 1, 0.05, 50.0, None, T3), (2, 1, 2, "Choc", 2, 4, 3.0, 15.0, T2, T1),
                            (3, 1, 2, "Choc", 2, 1, None, 15.0, T2, None), (4, 2, 1, "Mug", 1, 1, 1.0, 15.0, None, T1)),
        "PurchaseOrders": frame("PurchaseOrderID int, SupplierID int, OrderDate timestamp_ntz, LastEditedWhen timestamp_ntz", (1, 1, T1, T1)),
        "PurchaseOrderLines": frame("PurchaseOrderLineID int, PurchaseOrderID int, StockItemID int, OrderedOuters int, ReceivedOuters int, PackageTypeID int, IsOrderLineFinalized boolean, LastEditedWhen timestamp_ntz",
                                    (1, 1, 2, 5, 4, 2, True, T2)),
        "Invoices": frame("InvoiceID int, CustomerID int, BillToCustomerID int, SalespersonPersonID int, InvoiceDate timestamp_ntz, ConfirmedDeliveryTime timestamp_ntz, LastEditedWhen timestamp_ntz",
                          (1, 2, 1, 21, T1, T2, T1), (2, 2, 77, 21, T1, T2, T1)),
        "InvoiceLines": frame("InvoiceLineID int, InvoiceID int, StockItemID int, Description string, PackageTypeID int, Quantity int, UnitPrice double, TaxRate double, TaxAmount double, LineProfit double, ExtendedPrice double, LastEditedWhen timestamp_ntz",
                              (1, 1, 1, "Mug", 1, 5, 1.5, 15.0, 1.13, 2.0, 8.63, T2), (2, 1, 2, "Choc", 2, 5, 3.0, 15.0, 2.25, 3.0, 17.25, T1),
                              (3, 1, 3, "Odd", 1, 5, 1.0, 0.0, 0.0, 1.0, 5.0, T1), (4, 2, 1, "Mug", 1, 1, 1.5, 15.0, 0.23, 1.0, 1.73, T2)),
        "CustomerTransactions": frame("CustomerTransactionID int, CustomerID int, TransactionTypeID int, InvoiceID int, PaymentMethodID int, TransactionDate timestamp_ntz, AmountExcludingTax double, TaxAmount double, TransactionAmount double, OutstandingBalance double, IsFinalized boolean, LastEditedWhen timestamp_ntz",
                                      (1, 1, 1, 1, None, T1, 10.0, 1.0, 11.0, 0.0, True, T1), (2, 1, 3, None, 4, T2, 0.0, 0.0, -11.0, 0.0, None, T2)),
        "SupplierTransactions": frame("SupplierTransactionID int, SupplierID int, TransactionTypeID int, PurchaseOrderID int, PaymentMethodID int, SupplierInvoiceNumber string, TransactionDate timestamp_ntz, AmountExcludingTax double, TaxAmount double, TransactionAmount double, OutstandingBalance double, IsFinalized boolean, LastEditedWhen timestamp_ntz",
                                      (9, 1, 5, 1, 4, "A7", T1, 5.0, 0.5, 5.5, 0.0, False, T3)),
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_city_takes_the_population_of_the_country(t):
    assert rows(gold.build("Cities", t)) == [(1, "Oslo", "Viken", "x", "Norway", "Europe", "EU", "North", 500)]


def test_customer_needs_a_buying_group(t):
    out = gold.build("Customer", t)
    assert out.columns == ["CustomerID", "CustomerName", "BillToCustomer", "CustomerCategoryName", "BuyingGroupName", "FullName", "DeliveryPostalCode"]
    assert rows(out) == [(1, "Head", "Head", "Shop", "Group", "Ann A", "0001"), (2, "Branch", "Head", "Shop", "Group", "Bo B", "0002")]


def test_employee(t):
    out = gold.build("Employee", t)
    assert out.columns == ["WWI_Employee_ID", "FullName", "PreferredName", "IsSalesperson"]
    assert rows(out) == [(21, "Ann A", "Ann", False)]


def test_stock_item_roles_and_unknown_colour(t):
    out = gold.build("StockItem", t).select("StockItemID", "ColorName", "Selling_Package", "Buying_Package")
    assert rows(out) == [(1, "red", "Each", "Box"), (2, None, "Box", "Box"), (3, None, "Each", "Each")]


def test_supplier(t):
    assert rows(gold.build("Supplier", t)) == [(1, "Sup", "Toys", "Bo B", None, 14, "9")]


def test_stock_movement(t):
    assert rows(gold.build("StockMovement", t)) == [(date(2024, 1, 1), 1, 5, None, -3, 2, 1, None, 10, T1)]


def test_order_lines(t):
    out = gold.build("Movement", t)
    assert len(out.columns) == 18
    picked = out.select("Description", "Quantity", "Total_Excluding_Tax", "Tax_Amount", "Total_Including_Tax", "Last_Modified_When")
    assert rows(picked) == sorted([
        ("Mug", 1, 0.05, 0.03, 0.08, T3),  # tax 0.025 rounds up
        ("Choc", 4, 12.0, 1.8, 13.8, T2),
        ("Choc", 1, None, None, None, T2),  # no price; no line time, so the order's
    ], key=str)


def test_purchase_and_its_second_name(t):
    out = gold.build("Purchase", t)
    assert rows(out) == [(T1, 1, 5, 120, 4, "Box", True, 1, 2, T2)]
    assert rows(gold.build("Order", t)) == rows(out) and gold.build("Order", t).columns == out.columns


def test_sales(t):
    out = gold.build("Sales", t)
    assert len(out.columns) == 20
    picked = out.select("Description", "Total_Excluding_Tax", "Total_Dry_Items", "Total_Chiller_Items", "BillToCustomerID", "Last_Modified_When")
    assert rows(picked) == sorted([
        ("Mug", 7.5, 5, 0, 1, T2), ("Choc", 15.0, 0, 5, 1, T1), ("Odd", 5.0, 0, 0, 1, T1),
    ], key=str)


def test_bill_to_semi_join_equals_the_inner_join(t):
    """Customer keys are unique, so requiring the billed customer cannot multiply lines."""
    customers = t["Customers"]
    assert customers.count() == customers.select("CustomerID").distinct().count()
    inner = t["InvoiceLines"].join(t["Invoices"], "InvoiceID").join(
        customers.selectExpr("CustomerID as BillToCustomerID"), "BillToCustomerID"
    )
    assert inner.count() == gold.build("Sales", t).count()


def test_transactions(t):
    out = gold.build("Transactions", t)
    assert out.columns == [
        "TransactionDate", "CustomerTransactionID", "SupplierTransactionID", "InvoiceID", "PurchaseOrderID",
        "SupplierInvoiceNumber", "AmountExcludingTax", "TaxAmount", "TransactionAmount", "OutstandingBalance",
        "IsFinalized", "CustomerID", "BillToCustomerID", "SupplierID", "TransactionTypeID", "PaymentMethodID",
        "LastEditedWhen",
    ]
    assert rows(out) == sorted([
        (T1, 1, None, 1, None, None, 10.0, 1.0, 11.0, 0.0, True, 2, 1, None, 1, None, T1),
        (T2, 2, None, None, None, None, 0.0, 0.0, -11.0, 0.0, None, 1, 1, None, 3, 4, T2),
        (T1, None, 9, None, 1, "A7", 5.0, 0.5, 5.5, 0.0, False, None, None, 1, 5, 4, T3),
    ], key=str)


def test_build_all_writes_and_registers(spark, t, tmp_path):
    gold.build_all(spark, t, str(tmp_path / "gold"), database=None, total_order=True)
    from medallion.sinks.catalog import create_database, register_gold

    create_database(spark, "gold_all", str(tmp_path / "db"))
    assert register_gold(spark, "gold_all", str(tmp_path / "gold")) == sorted(f"{n}_gold" for n in gold.GOLD)
    for name in gold.GOLD:
        assert rows(spark.table(f"gold_all.{name}_gold")) == rows(gold.build(name, t)), name


def test_customers_join_orders_before_lines_do(spark, tiny_dir):
    from medallion.queries.derived import SilverTables

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold.fact_order_line(SilverTables(spark, tiny_dir))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    by = {key: next(n for n, line in enumerate(joins) if key in line) for key in ("PackageTypeID", "OrderID", "CustomerID")}
    assert by["PackageTypeID"] < by["OrderID"] < by["CustomerID"]


def test_tables_of_one_plan_are_joined_once(spark, tiny_dir, tmp_path, monkeypatch):
    from medallion.queries.derived import SilverTables

    tables, plans = SilverTables(spark, tiny_dir), []
    counted = gold.GoldTable(lambda t: plans.append(1) or gold._purchase(t), ("PurchaseOrderID", gold.LINE_ID))
    monkeypatch.setattr(gold, "GOLD", {"Order": counted, "Purchase": counted})
    gold.build_all(spark, tables, str(tmp_path))
    assert len(plans) == 1
    want = Counter(map(str, gold.fact_purchase(tables).collect()))
    for name in ("Order", "Purchase"):
        stored = spark.read.parquet(f"{tmp_path}/{name}")
        assert gold.LINE_ID not in stored.columns and Counter(map(str, stored.collect())) == want


def test_tables_of_one_plan_leave_the_memory_to_the_joins(spark, tiny_dir, tmp_path, monkeypatch):
    from medallion.queries.derived import SilverTables

    kept, write, place = [], gold.write_gold, gold.workspace
    levels = []
    monkeypatch.setattr(gold, "workspace", lambda *a: kept.append(place(*a)) or kept[-1])
    monkeypatch.setattr(gold, "write_gold", lambda rows, *a: levels.append(rows.storageLevel.useMemory) or write(rows, *a))
    tables = SilverTables(spark, tiny_dir)
    gold.build_all(spark, tables, str(tmp_path), ["Order", "Purchase", "Employee"])
    assert levels == [False] * 3 and len(kept) == 1 and not Path(kept[0].removeprefix("file:")).exists()
    want = sorted(map(tuple, gold.build("Order", tables).collect()), key=str)
    for name in ("Order", "Purchase"):
        files = list((tmp_path / name).glob("*.parquet"))
        assert files and all(f.name.endswith(".zstd.parquet") for f in files)
        assert sorted(map(tuple, spark.read.parquet(str(tmp_path / name)).collect()), key=str) == want
        for file in files:
            keys = [r.PurchaseOrderID for r in spark.read.parquet(str(file)).collect()]
            assert keys == sorted(keys)


@pytest.mark.parametrize(("fact", "key"), [("fact_purchase", "PurchaseOrderID"), ("fact_sales", "InvoiceID")])
def test_items_join_lines_before_headers_do(spark, tiny_dir, fact, key):
    from medallion.queries.derived import SilverTables

    plan = getattr(gold, fact)(SilverTables(spark, tiny_dir))._jdf.queryExecution().analyzed().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    by = {k: next(n for n, line in enumerate(joins) if k in line) for k in (key, "StockItemID")}
    assert by[key] < by["StockItemID"]
