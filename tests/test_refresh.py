"""A fact brought up to date equals the fact built anew, and parts that nothing changed in stay as they are."""

import random
from collections import ChainMap, Counter
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.dictionary import DataDictionary
from medallion.plans import refresh
from medallion.plans.refresh import FACTS, MaintainedFact, affected_owners, refresh_gold
from medallion.queries.derived import SilverTables, changed_rows, sources_after, sources_before
from medallion.session import setting
from medallion.sinks.catalog import create_database
from medallion.sinks.parted import KeyRanges, PartedTable
from medallion.streaming.incremental import IncrementalLoad

SCHEMA = T.StructType().add("k", T.LongType()).add("v", T.StringType())


def bag(df):
    return Counter(map(str, df.collect()))


def parted(spark, path):
    return PartedTable(spark, str(path), SCHEMA, KeyRanges("k", 10))


@pytest.mark.parametrize("most", [64, 2, 1])
def test_ranges_hold_all_keys_of_their_parts(spark, most):
    rng, ranges = random.Random(most), KeyRanges("k", 10)
    for _ in range(5):
        parts = rng.sample(range(-5, 15), 6)
        inside = spark.range(-60, 160).select(F.col("id").alias("k")).withColumn("p", ranges.of())
        kept = inside.where(ranges.within(parts, most=most))
        assert inside.where(F.col("p").isin(parts)).exceptAll(kept).count() == 0
        assert most < 64 or kept.count() == 60
    assert spark.range(5).select(F.col("id").alias("k")).where(ranges.within([])).count() == 0


def test_parts_are_replaced_in_one_step(spark, tmp_path):
    table = parted(spark, tmp_path)
    assert table.read().count() == 0 and table.live() == {}
    table.replace(spark.range(50).selectExpr("id as k", "'old' as v"))
    before = table.read()
    others = {f for f in before.inputFiles() if "/part=1/" not in f and "/part=4/" not in f}
    # rows that come from the table itself, a part that gets no rows, one that is new
    rows = table.read([1]).withColumn("v", F.lit("new")).unionByName(spark.createDataFrame([(77, "far")], SCHEMA))
    table.replace(rows, [1, 4, 7])
    assert table.live() == {0: 0, 1: 1, 2: 0, 3: 0, 7: 1}
    want = [(k, "new" if 10 <= k < 20 else "old") for k in range(40)] + [(77, "far")]
    assert sorted(map(tuple, table.read().collect())) == want
    assert others <= set(table.read().inputFiles())
    assert before.count() == 50  # a reader that started before
    assert {f.split("/part=")[1][0] for f in table.read([0, 1, 9]).inputFiles()} == {"0", "1"}
    table.vacuum()
    assert sorted(map(tuple, table.read().collect())) == want and table._versions() == [1]
    assert not (tmp_path / "data" / "v=0" / "part=1").exists()


def test_a_write_that_died_before_its_manifest_does_not_count(spark, tmp_path):
    table = parted(spark, tmp_path)
    table.replace(spark.range(20).selectExpr("id as k", "'old' as v"))
    table.replace(spark.createDataFrame([(3, "dead")], SCHEMA), [0])
    (tmp_path / "manifest" / "v=1" / "_SUCCESS").unlink()
    assert table.read().count() == 20
    table.replace(spark.createDataFrame([(13, "x")], SCHEMA), [1])
    assert table.read().count() == 11 and table.read().where("v = 'dead'").count() == 0


@pytest.mark.parametrize("name", list(FACTS))
def test_refresh_equals_rebuild(spark, tiny_dir, tmp_path, name):
    before = SilverTables(spark, tiny_dir, sources_before(spark, tiny_dir))
    after = SilverTables(spark, tiny_dir, sources_after(spark, tiny_dir))
    fact = MaintainedFact(spark, name, f"{tmp_path}/fact", 400)
    fact.build(before)
    assert bag(fact.read(before)) == bag(fact.spec.plan(before))
    changed = changed_rows(after)
    assert fact.refresh(after, changed)
    want = bag(fact.spec.plan(after))
    assert want and bag(fact.read(after)) == want
    fact.refresh(after, changed)
    assert bag(fact.read(after)) == want


def test_only_parts_of_changed_owners_are_read_and_written(spark, tiny_dir, tmp_path):
    tables = SilverTables(spark, tiny_dir)
    fact = MaintainedFact(spark, "Movement", f"{tmp_path}/fact", 100)
    fact.build(tables)
    live, rows = fact.table(tables).live(), bag(fact.read(tables))
    late = tables["Orders"].where("OrderID between 205 and 207")
    assert fact.refresh(tables, {"Orders": late}) == [2]
    now = fact.table(tables).live()
    assert bag(fact.read(tables)) == rows
    assert {p for p in live if live[p] != now[p]} == {2}
    # the old rows come from that part only, and the clean tables are read by its range
    kept = fact.table(tables).read([2])
    assert all("/part=2/" in f for f in kept.inputFiles())
    own = tables["OrderLines"].where(KeyRanges("OrderID", 100).within([2]))
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_orderkey,200)" in plan and "LessThan(l_orderkey,300)" in plan
    assert fact.refresh(tables, {}) == [] and fact.refresh(tables, {"Orders": late.where("false")}) == []


def test_a_line_that_moves_leaves_its_order(spark, tiny_dir, tmp_path):
    tables = SilverTables(spark, tiny_dir)
    fact = MaintainedFact(spark, "Movement", f"{tmp_path}/fact", 100)
    fact.build(tables)
    moves = (F.col("OrderID") == 3) & (F.col("Quantity") > 10)
    lines = tables["OrderLines"].withColumn("OrderID", F.when(moves, 903).otherwise(F.col("OrderID")).cast("long"))
    after = ChainMap({"OrderLines": lines}, tables)
    moved = tables["OrderLines"].where(moves)
    both = moved.unionByName(moved.withColumn("OrderID", F.lit(903).cast("long")))
    assert moved.count() and fact.refresh(after, {"OrderLines": both}) == [0, 9]
    assert bag(fact.read(after)) == bag(fact.spec.plan(after))


def test_owners_of_dimensions(spark, tiny_dir):
    tables = SilverTables(spark, tiny_dir)
    changed = {"Customers": spark.createDataFrame([(10,), (10,), (None,)], "CustomerID long")}
    got = {r[0] for r in affected_owners(FACTS["Sales"], tables, changed).collect()}
    want = tables["Invoices"].where("CustomerID = 10 or BillToCustomerID = 10")
    assert got == {r.InvoiceID for r in want.collect()} and got


def test_loads_refresh_facts_before_they_publish(spark, tiny_dir, tmp_path, monkeypatch):
    tables = SilverTables(spark, tiny_dir)
    orders = tables["Orders"]
    kinds = {"bigint": "long", "timestamp_ntz": "string"}
    rows = [
        ("Orders", f.name, place, f.name not in ("OrderID",), "datetime2" if "ntz" in f.dataType.simpleString() else "bigint",
         f.name == "OrderID", kinds.get(f.dataType.simpleString(), f.dataType.simpleString()))
        for place, f in enumerate(orders.schema.fields, 1)
    ]
    landing = T.StructType([*orders.schema.fields, T.StructField("version", T.LongType())])
    root = str(tmp_path)
    load = IncrementalLoad(
        spark, DataDictionary.from_rows(rows), "Orders", f"{root}/landing", f"{root}/load", ["version"],
        date(2024, 1, 1), landing,
    )
    load.seed(orders.where("OrderID % 5 <> 0"))
    start = ChainMap({"Orders": load.current()}, tables)
    facts = [MaintainedFact(spark, n, f"{root}/{n}", 500) for n in ("Movement", "Purchase")]
    for fact in facts:
        fact.build(start)
    arrivals = orders.where("OrderID % 5 = 0 or OrderID % 7 = 0").withColumn("version", F.lit(1).cast("long"))
    arrivals.withColumn("SalespersonPersonID", F.lit(6).cast("long")).write.parquet(load.landing)
    load.run()
    create_database(spark, "refreshed")
    with monkeypatch.context() as patch:
        patch.setattr(IncrementalLoad, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            refresh_gold(spark and [load], "refreshed", facts, lambda: tables)
    refresh_gold([load], "refreshed", facts, lambda: tables)
    assert load.log.changed().count() == 0
    now = ChainMap({"Orders": spark.table("refreshed.Orders_silver")}, tables)
    assert now["Orders"].where("SalespersonPersonID = 6").count() >= arrivals.count()
    for fact in facts:
        assert bag(fact.read(now)) == bag(fact.spec.plan(now))
    spark.sql("DROP DATABASE refreshed CASCADE")


@pytest.mark.parametrize("anew, lines", [(100, 300), (0, 1_000_000)])
@pytest.mark.parametrize("name", ["Movement", "Purchase", "Sales", "SupplierTransactions"])
def test_parts_anew_merged_and_of_many_lines_equal_a_rebuild(spark, tiny_dir, tmp_path, monkeypatch, name, anew, lines):
    monkeypatch.setattr(refresh, "ANEW", anew)
    monkeypatch.setattr(refresh, "MOST_LINES", lines)
    before = SilverTables(spark, tiny_dir, sources_before(spark, tiny_dir))
    tables = SilverTables(spark, tiny_dir, sources_after(spark, tiny_dir))
    # one order has most of the lines of its part
    owned = list(FACTS[name].owned.items())[-1]
    many = F.when(F.col(owned[1]).between(400, 650), 401).otherwise(F.col(owned[1])).cast("long")
    after = ChainMap({owned[0]: tables[owned[0]].withColumn(owned[1], many)}, tables)
    fact = MaintainedFact(spark, name, f"{tmp_path}/fact", 200)
    fact.build(ChainMap({owned[0]: before[owned[0]].withColumn(owned[1], many)}, before))
    changed = changed_rows(after)
    moved = [t[owned[0]].select(owned[1]) for t in (tables, after)]
    assert fact.refresh(after, changed | {owned[0]: moved[0].unionByName(moved[1])})
    want = bag(fact.spec.plan(after))
    assert want and bag(fact.read(after)) == want


def test_rows_come_out_as_they_are_stored(spark, tiny_dir, tmp_path):
    """Headers and lines are each shuffled once, and a part is one file."""
    tables = SilverTables(spark, tiny_dir)
    fact = MaintainedFact(spark, "Movement", f"{tmp_path}/fact", 100)
    fact.build(tables)
    files = fact.read(tables).inputFiles()
    assert len(files) == len(fact.table(tables).live()) > 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10_000))
    try:
        with setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            plan = fact._computed(tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_line = [line for line in plan.splitlines() if "Exchange hashpartitioning(_place" in line]
    assert len(by_line) == 2 and all("OrderID" not in line for line in by_line)


def test_ranges_of_exactly_these_parts(spark):
    ranges = KeyRanges("k", 10)
    keys = spark.range(-60, 160).select(F.col("id").alias("k"))
    for most in (64, 2, 1):
        got = {r.k // 10 for r in keys.where(ranges.exactly([-2, 0, 3, 4, 9], most=most)).collect()}
        assert got == {-2, 0, 3, 4, 9}
