from itertools import permutations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from medallion.operators.upsert import latest, merge_into_table, upsert, upsert_by_full_join, upsert_by_union

FORMS = [upsert, upsert_by_union, upsert_by_full_join]
forms = pytest.mark.parametrize("form", FORMS)


def versions(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, val string, seq int")


def state(df):
    return {r["id"]: r["val"] for r in df.collect()}


@forms
def test_update_and_insert(spark, form):
    out = form(versions(spark, (1, "a", 1), (2, "b", 1)), versions(spark, (2, "B", 2), (3, "c", 2)), ["id"], ["seq"])
    assert out.columns == ["id", "val", "seq"]
    assert state(out) == {1: "a", 2: "B", 3: "c"} and out.count() == 3


@forms
def test_late_update_is_ignored(spark, form):
    out = form(versions(spark, (2, "b", 5)), versions(spark, (2, "old", 3)), ["id"], ["seq"])
    assert out.collect() == [(2, "b", 5)]


@forms
def test_duplicate_keys_in_one_batch(spark, form):
    out = form(versions(spark), versions(spark, (2, "x", 1), (2, "y", 2)), ["id"], ["seq"])
    assert out.collect() == [(2, "y", 2)]


@forms
def test_null_values_are_written(spark, form):
    out = form(versions(spark, (1, "a", 1)), versions(spark, (1, None, 2)), ["id"], ["seq"])
    assert out.collect() == [(1, None, 2)]


@forms
def test_composite_key(spark, form):
    ddl = "a int, b int, val string, seq int"
    target = spark.createDataFrame([(1, 1, "x", 1), (1, 2, "y", 1)], ddl)
    out = form(target, spark.createDataFrame([(1, 2, "Y", 2)], ddl), ["a", "b"], ["seq"])
    assert sorted(out.collect()) == [(1, 1, "x", 1), (1, 2, "Y", 2)]


def test_tie_does_not_depend_on_order(spark):
    rows = [(1, "a", 1), (1, "b", 1), (1, "c", 1)]
    assert len({latest(versions(spark, *p), ["id"], ["seq"]).first()["val"] for p in permutations(rows)}) == 1


def stored(spark, path, df):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def exchanges_above_scans(df, path):
    """Whether any scan of `path` has a shuffle between it and the first join above it."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and str(path) in line:
            join = max(j for j in range(i) if "Join" in lines[j])
            found.append(any("Exchange hashpartitioning" in x for x in lines[join:i]))
    return found


def test_small_updates_do_not_shuffle_the_target(spark, tmp_path):
    target = stored(spark, tmp_path / "T", spark.range(1000).selectExpr("int(id) id", "'v' val", "1 seq"))
    updates = stored(spark, tmp_path / "U", versions(spark, (2, "B", 2)))
    out = upsert(target, updates, ["id"], ["seq"])
    assert exchanges_above_scans(out, tmp_path / "T") == [False, False]
    assert out.count() == 1000


def test_bucketed_target_is_not_shuffled(spark, tmp_path):
    from medallion.streaming.changelog import ChangeLog

    rows = spark.range(1000).selectExpr("int(id) id", "'v' val", "1 seq")
    log = ChangeLog(spark, str(tmp_path / "log"), rows.schema, ["id"], ["seq"], buckets=16)
    log.seed(rows)
    log.append(versions(spark, (2, "B", 2), (5000, "n", 1)), 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        now = log.current()
        assert exchanges_above_scans(now, "snapshot_") == [False]
        assert now.count() == 1001
        log.compact()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    files = [f for f in (tmp_path / "log" / "snapshot" / "v=1").iterdir() if f.suffix == ".parquet"]
    assert len(files) <= 16, "one file per bucket, written without a shuffle"
    assert state(log.current())[2] == "B" and log.current().count() == 1001
    log.vacuum()
    assert sorted(p.name for p in (tmp_path / "log" / "snapshot").iterdir()) == ["v=1"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 5), st.integers(0, 10**6)), unique_by=lambda t: t[1], max_size=12),
    st.integers(0, 12),
)
def test_any_split_into_target_and_updates_gives_the_newest(spark, rows, cut):
    data = [(k, f"v{s}", s) for k, s in rows]
    expected = {k: v for k, v, _ in sorted(data, key=lambda r: r[2])}
    target = latest(versions(spark, *data[:cut]), ["id"], ["seq"])
    updates = versions(spark, *data[cut:])
    for form in FORMS:
        once = form(target, updates, ["id"], ["seq"])
        assert state(once) == expected
        assert state(form(once, updates, ["id"], ["seq"])) == expected


def test_merge_needs_a_table_format_that_can(spark):
    spark.sql("create table if not exists merge_target (id int, val string, seq int) using parquet")
    with pytest.raises(PySparkException, match="MERGE|UNSUPPORTED|does not support"):
        merge_into_table(versions(spark, (1, "a", 1)), "merge_target", ["id"], ["seq"])
