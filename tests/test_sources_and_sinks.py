from datetime import date

import pytest
from pyspark.sql import functions as F

from medallion.dictionary import DataDictionary
from medallion.plans.initial import Layers, ingest_all, load_silver, register_layers
from medallion.session import run_parallel, workspace
from medallion.sinks.catalog import create_database, register_gold
from medallion.sinks.writers import (
    append_landing, child_directories, write_batch, write_errors, write_full, write_gold,
)
from medallion.sources.cdc import current_documents, look_up_documents, parse_events, split_events
from medallion.sources.documents import parse_documents, split_corrupt
from medallion.sources.readers import jdbc_options, read_day, read_silver, read_source, read_table

DAY_1, DAY_2 = date(2024, 1, 1), date(2024, 1, 2)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id int")


def test_full_load_replaces_all_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_full(numbers(spark, 1, 2), path, DAY_1)
        write_full(numbers(spark, 2, 3), path, DAY_2)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert {tuple(r) for r in read_table(spark, path).collect()} == {(2, DAY_2), (3, DAY_2)}


def test_landing_keeps_both_arrivals(spark, tmp_path):
    path = str(tmp_path / "t")
    append_landing(numbers(spark, 1), path, DAY_1)
    append_landing(numbers(spark, 2), path, DAY_1)
    assert ids(read_table(spark, path)) == [1, 2]


def test_landing_routes_in_one_write(spark, tmp_path):
    path = str(tmp_path / "t")
    append_landing(numbers(spark, 1, 2, 3).withColumn("coll", F.expr("if(id = 2, 'a', 'b')")), path, DAY_1, "coll")
    assert sorted(child_directories(spark, path)) == ["coll=a", "coll=b"]
    assert ids(read_table(spark, f"{path}/coll=b")) == [1, 3]


def test_errors_of_a_rerun_replace_their_day(spark, tmp_path):
    path = str(tmp_path / "t")
    write_errors(numbers(spark, 1, 2), path, DAY_1)
    write_errors(numbers(spark, 3), path, DAY_2)
    write_errors(numbers(spark, 2), path, DAY_1)
    assert ids(read_day(spark, path, DAY_1)) == [2] and ids(read_day(spark, path, DAY_2)) == [3]
    write_errors(numbers(spark, 1).where("false"), path, DAY_1)
    assert ids(read_table(spark, path)) == [3]


def test_day_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_errors(numbers(spark, 1), path, DAY_1)
    write_errors(numbers(spark, 2), path, DAY_2)
    plan = read_day(spark, path, DAY_2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_date" in plan


def test_batch_write_twice(spark, tmp_path):
    path = str(tmp_path / "t")
    write_batch(numbers(spark, 1, 2), path, 0)
    write_batch(numbers(spark, 3), path, 1)
    write_batch(numbers(spark, 1, 2), path, 0)
    assert ids(read_table(spark, path)) == [1, 2, 3]
    write_batch(numbers(spark, 1).where("false"), path, 1)
    assert ids(read_table(spark, path)) == [1, 2]


def test_gold_order(spark, tmp_path):
    df = spark.range(100, numPartitions=4).selectExpr("id % 7 as k", "id as _line")
    write_gold(df, str(tmp_path / "g"), ["k", "_line"], ["_line"], total_order=True)
    out = read_table(spark, str(tmp_path / "g"))
    assert out.columns == ["k"]
    parts = out.select(F.input_file_name().alias("f"), "k").groupBy("f").agg(F.min("k"), F.max("k")).orderBy("f").collect()
    assert all(a[2] <= b[1] for a, b in zip(parts, parts[1:]))


@pytest.mark.parametrize("fmt", ["json", "orc", "csv", "parquet"])
def test_any_source_format(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    numbers(spark, 1, 2).write.format(fmt).save(path)
    schema = "id int" if fmt in ("csv", "json") else None
    assert ids(read_source(spark, fmt, path=path, schema=schema)) == [1, 2]


def test_schema_is_inferred_for_documents(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"id": 1, "s": {"a": "x"}}\n{"id": 2, "extra": true}\n')
    df = read_source(spark, "json", path=str(tmp_path / "d.json"))
    assert sorted(df.columns) == ["extra", "id", "s"]


def test_drifting_files(spark, tmp_path):
    numbers(spark, 1).write.parquet(str(tmp_path / "t" / "p=1"))
    numbers(spark, 2).withColumn("more", F.lit("x")).write.parquet(str(tmp_path / "t" / "p=2"))
    df = read_table(spark, str(tmp_path / "t"), merge_schema=True)
    assert sorted(df.columns) == ["id", "more", "p"] and ids(df) == [1, 2]


def test_jdbc_reads_in_ranges():
    options = jdbc_options("jdbc:x", "t", "id", "0", "100", 16, user="u")
    assert options["numPartitions"] == "16" and options["partitionColumn"] == "id" and options["user"] == "u"


def test_workspace_is_shared(spark):
    assert workspace(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert workspace(spark) != workspace(spark)


def test_parallel_work_raises(spark):
    def fail(name):
        raise KeyError(name)

    with pytest.raises(KeyError):
        run_parallel(spark, fail, ["a"], 2)


DD = DataDictionary.from_rows(
    [
        ("Colors", "ColorID", 1, False, "int", True, "integer"),
        ("Colors", "ColorName", 2, False, "nvarchar", False, "string"),
        ("Groups", "GroupID", 1, False, "int", True, "integer"),
        ("Groups", "Since", 2, True, "date", False, "string"),
    ]
)


def test_initial_load_and_catalog(spark, tmp_path):
    layers = Layers(str(tmp_path / "sys"))
    sources = {
        "Colors": spark.createDataFrame([("1", "red", "x"), ("2", "NULL", "y"), ("z", "blue", "z")], "ColorID string, ColorName string, _id string"),
        "Groups": spark.createDataFrame([("1", "2024-05-06"), ("2", None)], "GroupID string, Since string"),
    }
    ingest_all(spark, sources.__getitem__, DD.tables(), layers, DAY_1)
    assert [load_silver(spark, layers, DD, t, DAY_1) for t in DD.tables()] == [True, True]
    register_layers(spark, "shop_a", layers, DD.tables(), str(tmp_path / "db"))
    silver = read_silver(spark, "shop_a", DD)
    assert silver["Colors"].collect() == [(1, "red", DAY_1)]
    assert dict(silver["Groups"].dtypes)["Since"] == "timestamp_ntz"
    errors = spark.table("error_shop_a.Colors")
    assert {(r["ColorID"], r["error_desc"], r["part_date"]) for r in errors.collect()} == {
        ("2", "NULL Check Failed for Column ColorName", DAY_1),
        ("z", "Data Type MisMatch for ColorID", DAY_1),
    }
    assert spark.table("error_shop_a.Groups").count() == 0
    # good rows and distinct bad rows make up the input
    assert silver["Colors"].count() + errors.select("ColorID").distinct().count() == 3


def test_initial_load_reports_a_wrong_header(spark, tmp_path):
    layers = Layers(str(tmp_path / "sys"))
    write_full(spark.createDataFrame([("1", "x")], "ColorID string, Other string"), layers.bronze("Colors"), DAY_1)
    assert load_silver(spark, layers, DD, "Colors", DAY_1) is False
    with pytest.raises(ValueError):
        load_silver(spark, layers, DD, "Colors", DAY_1, strict_header=True)


def test_rendered_dates_in_silver(spark, tmp_path):
    layers = Layers(str(tmp_path / "sys"))
    write_full(spark.createDataFrame([("1", "2019-12-30")], "GroupID string, Since string"), layers.bronze("Groups"), DAY_1)
    load_silver(spark, layers, DD, "Groups", DAY_1, render_dates=True)
    assert read_table(spark, layers.silver("Groups")).first()["Since"] == "12-30-2019 00:00:00"


def test_gold_directories_become_tables(spark, tmp_path):
    for name in ("One", "Two"):
        numbers(spark, 1).write.parquet(str(tmp_path / "gold" / name))
    create_database(spark, "gold_names", str(tmp_path / "db"))
    assert register_gold(spark, "gold_names", str(tmp_path / "gold")) == ["One_gold", "Two_gold"]
    assert spark.table("gold_names.Two_gold").count() == 1


# --- documents and change events ------------------------------------------------------------------


def test_broken_document_keeps_what_can_be_read(spark):
    df = spark.createDataFrame(
        [('{"ColorID": 1, "ColorName": "red"}',), ('{"ColorID": "one", "ColorName": "blue"}',), ('{"ColorID": ',), ("null",)],
        "doc string",
    )
    rows, corrupt = split_corrupt(parse_documents(df, "doc", DD.schema("Colors")))
    assert (1, "red") in [tuple(r) for r in rows.collect()]
    assert {(r["ColorName"], r["rule"], r["bad_value"]) for r in corrupt.collect()} == {
        ("blue", "corrupt", '{"ColorID": "one", "ColorName": "blue"}'), (None, "corrupt", '{"ColorID": '),
        (None, "corrupt", "null"),
    }


def test_document_is_parsed_once_however_many_rules_look_at_it(spark):
    from medallion.operators.quality import good_rows
    from medallion.operators.rules import rules_for

    df = spark.createDataFrame([('{"ColorID": 1, "ColorName": "red"}',)], "doc string")
    rows = split_corrupt(parse_documents(df, "doc", DD.schema("Colors"))).rows
    plan = good_rows(rows, rules_for(rows, DD, "Colors"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


EVENTS = [
    ('{"operationType": "insert", "ns": {"db": "d", "coll": "c"}, "documentKey": {"_id": "1"}, "fullDocument": {"a": {"b": "None of True"}}}', 1),
    ('{"operationType": "update", "ns": {"db": "d", "coll": "c"}, "documentKey": {"_id": "2"}, "updateDescription": {"updatedFields": {"a": 1}}}', 2),
    ('{"operationType": "update", "ns": {"db": "d", "coll": "c"}, "documentKey": {"_id": "9"}}', 3),
    ('{"operationType": "delete", "ns": {"db": "d", "coll": "c"}, "documentKey": {"_id": "1"}}', 4),
    ('{"operationType": "ins', 5),
    (None, 6),
]


def test_events(spark):
    events = parse_events(spark.createDataFrame(EVENTS, "event string, seq bigint"))
    collection = spark.createDataFrame([("2", '{"a": 1, "b": 2}')], "_id string, document string")
    current = current_documents(collection, F.lit("d"), F.lit("c"), "_id", "document")
    feed = split_events(look_up_documents(events, current))
    good = {(r["op"], r["db"], r["coll"], r["key"], r["document"], r["seq"]) for r in feed.events.collect()}
    assert good == {
        ("insert", "d", "c", "1", '{"a":{"b":"None of True"}}', 1), ("update", "d", "c", "2", '{"a": 1, "b": 2}', 2),
    }
    assert {(r["seq"], r["rule"]) for r in feed.errors.collect()} == {
        (3, "missing_document"), (4, "unsupported_op"), (5, "corrupt"), (6, "corrupt"),
    }


def test_no_event_is_lost_by_lookup_and_none_gets_another_collections_document(spark):
    def bare(seq, coll, key):
        key = f', "documentKey": {{"_id": "{key}"}}' if key else ""
        return (f'{{"operationType": "update", "ns": {{"db": "d", "coll": "{coll}"}}{key}}}', seq)

    raw = [bare(1, "a", "1"), bare(2, "a", "1"), bare(3, "b", "1"), bare(4, "a", None), bare(5, "a", None), bare(6, "c", "1")]
    events = parse_events(spark.createDataFrame(raw, "event string, seq bigint"))
    rows = [("d", "a", "1", "of a"), ("d", "b", "1", "of b"), ("d", "a", None, "none"), ("e", "c", "1", "other db")]
    current = spark.createDataFrame(rows, "db string, coll string, key string, document string")
    feed = split_events(look_up_documents(events, current))
    assert {(r["seq"], r["document"]) for r in feed.events.collect()} == {(1, "of a"), (2, "of a"), (3, "of b")}
    assert sorted((r["seq"], r["rule"]) for r in feed.errors.collect()) == [(n, "missing_document") for n in (4, 5, 6)]


def test_no_event_is_lost_without_lookup(spark):
    feed = split_events(parse_events(spark.createDataFrame(EVENTS, "event string, seq bigint")))
    assert feed.events.count() + feed.errors.count() == len(EVENTS)
