"""A third of all rows with one key, or with none."""

import pytest
from pyspark.sql import functions as F

from medallion.operators.joins import left_lookup
from medallion.operators.upsert import latest
from medallion.plans.gold import fact_order_line


@pytest.fixture
def no_broadcast(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_null_keys_are_spread(spark, no_broadcast):
    left = spark.range(6000).select("id", F.when(F.col("id") % 3 != 0, F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("rk"), (F.col("id") * 10).alias("v"))
    out = left_lookup(left, right, "k", "rk", ["id"])
    assert out.columns == ["id", "k", "rk", "v"]
    expected = left.join(right, F.col("k") == F.col("rk"), "left")
    assert sorted(map(str, out.collect())) == sorted(map(str, expected.collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(k#" in plan and "_spread#" in plan.split("hashpartitioning(k#")[1][:40]
    sizes = [
        r["count"]
        for r in left.withColumn("s", F.when(F.col("k").isNull(), F.pmod(F.xxhash64("id"), F.lit(1024)) + 1).otherwise(0))
        .where("k is null").repartition(8, "k", "s").groupBy(F.spark_partition_id()).count().collect()
    ]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_hot_order_is_split_by_adaptive_execution(spark, no_broadcast):
    text = F.repeat(F.sha2(F.col("id").cast("string"), 256), 4)
    lines = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("int").alias("OrderID"),
        F.lit(None).cast("timestamp").alias("PickingCompletedWhen"), text.alias("Description"),
        (F.col("id") % 5).cast("int").alias("PackageTypeID"), F.lit(2).alias("Quantity"),
        F.lit(1.5).alias("UnitPrice"), F.lit(15.0).alias("TaxRate"), F.col("id").alias("StockItemID"),
        F.lit(1).alias("LastEditedWhen"),
    )
    orders = spark.range(1000).selectExpr(
        "cast(id as int) OrderID", "id as OrderDate", "id as BackorderOrderID", "cast(id % 10 as int) CustomerID",
        "id as SalespersonPersonID", "id as PickedByPersonID", "2 as LastEditedWhen",
    )
    tables = {
        "OrderLines": lines, "Orders": orders,
        "PackageTypes": spark.range(5).selectExpr("cast(id as int) PackageTypeID", "string(id) PackageTypeName"),
        "Customers": spark.range(10).selectExpr("cast(id as int) CustomerID", "id as DeliveryCityID"),
    }
    fact = fact_order_line(tables)
    plan = final_plan(fact)
    assert "skew=true" in plan
    assert fact.count() == 60000


def test_latest_reduces_a_hot_key_before_the_shuffle(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("s"))
    out = latest(df, ["k"], ["s"])
    assert out.where("k = 0").collect() == [(0, 8997)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")
