"""Packed layers, merged profiles, headers stored with their lines, and the newest images of a feed."""

import random
from collections import ChainMap, Counter
from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.scalars import amount_excluding_tax, tax_amount
from medallion.operators.profiles import column_profiles, merged_profiles, readable_profiles
from medallion.operators.quality import null_profile
from medallion.plans.gold import build
from medallion.plans.together import StoredTogether, build_together, hot_keys
from medallion.queries.derived import SilverTables
from medallion.sinks.batches import BatchLayer
from medallion.sinks.writers import remove_directory, write_batch
from medallion.streaming.feed import read_landed
from medallion.streaming.newest import _COLUMNS, _PLACE, KeepNewest, landed_state, run_newest_feed

SCHEMA = T.StructType().add("k", T.LongType()).add("v", T.StringType())
DAY = date(2024, 1, 1)


def bag(df):
    return Counter(map(str, df.collect()))


# --- packed layers


def layer(spark, path, batches):
    for n in batches:
        write_batch(spark.range(10 * n, 10 * n + 5).selectExpr("id as k", f"'b{n}' as v"), str(path), n)
    return BatchLayer(spark, str(path), SCHEMA)


def test_packing_changes_no_row(spark, tmp_path):
    assert BatchLayer(spark, f"{tmp_path}/none", SCHEMA).read().count() == 0
    assert BatchLayer(spark, f"{tmp_path}/none", SCHEMA).pack() is None
    own = layer(spark, tmp_path, range(4))
    before, started = bag(own.read()), own.read()
    assert before == bag(spark.read.parquet(str(tmp_path)))
    assert own.pack() == 3 and own.batches() == [] and bag(own.read()) == before and own.pack() is None
    assert all("_packed" in f for f in own.read().inputFiles())
    assert bag(started) == before  # a reader that started before
    own.vacuum()
    assert bag(own.read()) == before and not (tmp_path / "batch_id=0").exists()
    layer(spark, tmp_path, [4, 5])
    assert own.batches() == [4, 5] and own.read().count() == 30
    more = bag(own.read())
    assert own.pack() == 5 and bag(own.read()) == more
    own.vacuum()
    assert own._packs() == [5] and bag(BatchLayer(spark, str(tmp_path)).read()) == more


def test_a_pack_that_died_changes_nothing(spark, tmp_path):
    own = layer(spark, tmp_path, range(3))
    before = bag(own.read())
    own.pack()
    (tmp_path / "_packed" / "upto=2" / "_SUCCESS").unlink()
    own.vacuum()
    assert own.batches() == [0, 1, 2] and bag(own.read()) == before
    (tmp_path / "batch_id=2" / "_SUCCESS").unlink()  # a batch that isn't finished
    assert own.pack() == 1 and own.read().count() == 10


def test_partitions_stay_in_packs(spark, tmp_path):
    schema = T.StructType([*SCHEMA.fields, T.StructField("coll", T.StringType())])
    rows = spark.range(20).selectExpr("id as k", "'x' as v", "cast(id % 2 as string) as coll")
    write_batch(rows, str(tmp_path), 0, "coll")
    write_batch(rows.where("false"), str(tmp_path), 1, "coll")
    own = BatchLayer(spark, str(tmp_path), schema, ("coll",))
    before = bag(own.read())
    assert own.pack() == 1 and bag(own.read()) == before and own.read().schema["coll"].dataType == T.StringType()
    assert (tmp_path / "_packed" / "upto=1" / "coll=0").exists()


# --- profiles


def test_merged_profiles_count_as_one_scan_does(spark):
    rng = random.Random(1)
    rows = [
        (k, rng.choice(["", "NULL", None, "a", f"t{rng.randrange(3000)}"]), rng.choice([None, float("nan"), -k / 2, 1e9]),
         datetime(2024, 1, 1 + k % 9), [k])
        for k in range(8000)
    ]
    df = spark.createDataFrame(rows, "k long, t string, d double, at timestamp_ntz, list array<int>")
    names = ["k", "t", "d", "at"]
    parts = column_profiles(df.withColumn("part", F.col("k") % 13), by=["part"])
    merged = {r.column_name: r for r in readable_profiles(merged_profiles(parts)).collect()}
    once = {r.column_name: r for r in readable_profiles(column_profiles(df)).collect()}
    assert sorted(merged) == sorted(names) == sorted(once)
    missing = null_profile(df, names).first()
    for name in names:
        exact = df.select(name).distinct().where(F.col(name).isNotNull()).count()
        for found in (merged[name], once[name]):
            assert (found.n_rows, found.n_missing) == (8000, missing[name])
            assert abs(found.n_distinct - exact) <= max(2, 0.05 * exact)
        assert (merged[name].least, merged[name].greatest) == (once[name].least, once[name].greatest)
    assert merged["k"].greatest == "7999" and merged["k"].least == "0" and merged["at"].q50 is None
    assert all(abs(merged["k"][f"q{p}"] - 80 * p) < 240 for p in (25, 50, 75))
    weeks = merged_profiles(parts.withColumn("half", F.col("part") < 6), by=["half"])
    assert weeks.count() == 8 and weeks.groupBy("column_name").agg(F.sum("n_rows").alias("n")).where("n <> 8000").count() == 0


def test_profiles_of_nothing(spark):
    df = spark.createDataFrame([], "k long, t string")
    got = {r.column_name: r for r in readable_profiles(column_profiles(df)).collect()}
    assert (got["k"].n_rows, got["k"].n_missing, got["k"].n_distinct, got["k"].q50, got["t"].least) == (0, 0, 0, None, None)
    assert merged_profiles(column_profiles(df).where("false")).count() == 0
    assert column_profiles(df.withColumn("part", F.lit(1)), by=["part"]).count() == 0


# --- headers with their lines


@pytest.mark.parametrize("name,key", [("Movement", "OrderID"), ("Purchase", "PurchaseOrderID"), ("Sales", "InvoiceID")])
@pytest.mark.parametrize("most", [4, 1_000_000])
def test_facts_of_tables_stored_together(spark, tiny_dir, tmp_path, name, key, most):
    tables = SilverTables(spark, tiny_dir)
    pair = StoredTogether(spark, f"{tmp_path}/{most}", key, 16, most)
    pair.write(tables)
    got = build_together(name, tables, pair)
    assert bag(got) == bag(build(name, tables))
    (cold, hot), lines = pair._read(pair.pair["lines"]), tables[pair.pair["lines"]]
    assert hot.count() + cold.count() == lines.count() and (hot.count() > 0) == (most == 4)
    with pytest.raises(ValueError, match="joins by"):
        build_together("Movement", tables, StoredTogether(spark, str(tmp_path), "InvoiceID", 16))


def test_lines_in_buckets_are_not_shuffled(spark, tiny_dir, tmp_path):
    tables = SilverTables(spark, tiny_dir)
    pair = StoredTogether(spark, str(tmp_path), "PurchaseOrderID", 16)
    pair.write(tables)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cold, _ = pair.parts(tables)
        lines, headers = cold["PurchaseOrderLines"], cold["PurchaseOrders"]
        joined = lines.join(headers, "PurchaseOrderID")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        fact = build("Purchase", cold)._jdf.queryExecution().executedPlan().toString()
        at = fact.index("SortMergeJoin [PurchaseOrderID")
        assert "hashpartitioning(PurchaseOrderID" not in fact[at:]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_header_is_read_by_many_tasks(spark, tiny_dir, tmp_path):
    tables = SilverTables(spark, tiny_dir)
    lines = tables["PurchaseOrderLines"]
    hot = F.when(F.col("StockItemID") % 3 == 0, 1).otherwise(F.col("PurchaseOrderID")).cast("long")
    skewed = ChainMap({"PurchaseOrderLines": lines.withColumn("PurchaseOrderID", hot).repartition(8)}, tables)
    assert [r[0] for r in hot_keys(skewed["PurchaseOrderLines"], "PurchaseOrderID", 500).collect()] == [1]
    pair = StoredTogether(spark, str(tmp_path), "PurchaseOrderID", 16, 500)
    pair.write(skewed)
    cold, apart = pair._read("PurchaseOrderLines")
    assert len(apart.inputFiles()) >= 8 and cold.where("PurchaseOrderID = 1").count() == 0
    assert bag(build_together("Purchase", skewed, pair)) == bag(build("Purchase", skewed))


# --- newest images


def event(seq, key, doc=True, op="update", coll="c"):
    body = f', "fullDocument": {{"n": {seq}}}' if doc else ""
    known = f'"documentKey": {{"_id": "{key}"}}' if key else '"documentKey": {}'
    return (f'{{"operationType": "{op}", "ns": {{"db": "d", "coll": "{coll}"}}, {known}{body}}}', seq)


def test_newest_images_over_runs_a_restart_and_a_lost_checkpoint(spark, tmp_path):
    source, landing, checkpoint = (f"{tmp_path}/{n}" for n in ("source", "landing", "checkpoint"))

    def arrive(*events):
        spark.createDataFrame(list(events), "event string, seq long").coalesce(1).write.mode("append").parquet(source)

    def run():
        run_newest_feed(spark, source, landing, checkpoint, DAY)
        return Counter((r.seq, r.key, r.rule) for r in read_landed(spark, landing).collect())

    arrive(event(5, "a"), event(3, "a"), event(4, "b"), event(9, "x", op="delete"), event(1, None), ("{cut", 2))
    arrive((event(7, "b")[0], None))
    first = run()
    assert first == Counter([
        (5, "a", None), (3, "a", "stale"), (4, "b", None), (9, "x", "unsupported_op"), (1, None, "unordered"),
        (2, None, "corrupt"), (None, "b", "unordered"),
    ])
    arrive(event(4, "a"), event(5, "a"), event(6, "a"), event(2, "b"), event(1, "a", coll="other"), event(8, "b", doc=False))
    second = run()
    assert second - first == Counter([
        (4, "a", "stale"), (5, "a", "stale"), (6, "a", None), (2, "b", "stale"), (1, "a", None), (8, "b", "missing_document")
    ])
    assert run() == second
    state = {tuple(r) for r in landed_state(spark, landing).collect()}
    assert ('{"db":"d","coll":"c","key":"a"}', 6) in state and len(state) == 3
    # A lost checkpoint: everything comes again, nothing is usable twice, and no landed batch is written over.
    remove_directory(spark, checkpoint)
    arrive(event(7, "a"))
    third = run()
    usable = Counter(k for k in third.elements() if k[2] is None)
    assert usable == Counter([(5, "a", None), (4, "b", None), (6, "a", None), (1, "a", None), (7, "a", None)])
    assert second - third == Counter()


class States(dict):
    def getMapState(self, *_):
        return self

    getValue, updateValue = dict.get, dict.__setitem__


def test_a_group_holds_many_documents():
    """A processor is called once for a group, with the frames of all its documents."""
    rng, keeper, states = random.Random(5), KeepNewest(), States()
    keeper.init(states)
    known = {}
    for _ in range(3):
        events = [(rng.choice("abcdefgh"), rng.randrange(40), f"{rng.randrange(3)}") for _ in range(60)]
        rows = [("update", "d", "c", k, doc, seq, None, None, k) for k, seq, doc in events]
        rows += [("delete", "d", "c", "a", None, 99, None, "unsupported_op", None)]
        rng.shuffle(rows)
        frames = [pd.DataFrame(rows[at : at + 20], columns=[*_COLUMNS, _PLACE]) for at in range(0, len(rows), 20)]
        out = pd.concat(list(keeper.handleInputRows((1,), iter(frames), None)))
        got = Counter((r.key, int(r.seq), r.document, r.rule) for r in out.replace({np.nan: None}).itertuples())
        best = {k: max((seq, doc) for key, seq, doc in events if key == k) for k, *_ in events}
        usable = {k: v for k, v in best.items() if v[0] > known.get(k, -1)}
        want = Counter((k, seq, doc, "stale") for k, seq, doc in events)
        want -= Counter((k, *v, "stale") for k, v in usable.items())
        want += Counter((k, *v, None) for k, v in usable.items())
        assert got == want + Counter([("a", 99, None, "unsupported_op")])
        known |= {k: seq for k, (seq, _) in usable.items()}
    assert {place: seq for (place,), (seq,) in states.items()} == known


# --- amounts


def test_prices_of_four_digits_are_multiplied_before_they_are_rounded(spark):
    rows = [(1000, 0.0125, 10.0), (3, 0.005, 12.5), (7, 1234.56, 15.0), (1, 0.0049, 100.0), (3, 33.3333, 7.125)]
    df = spark.createDataFrame(rows, "q int, p double, r double")
    got = df.select(
        amount_excluding_tax(F.col("q"), F.col("p")).cast("string").alias("a"),
        tax_amount(F.col("q"), F.col("p"), F.col("r")).cast("string").alias("t"),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("12.50", "1.25"), ("0.02", "0.00"), ("8641.92", "1296.29"), ("0.00", "0.00"), ("100.00", "7.12")
    ]
