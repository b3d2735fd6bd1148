import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.dictionary import DataDictionary
from medallion.operators.header import (
    HeaderMismatch,
    column_list,
    document_header_report,
    header_matches,
    header_report,
)
from medallion.operators.upsert import merge_condition

ROWS = [
    # Out of order and with a gap, as dictionaries have it.
    ("Lines", "Sold", 7, True, "date", False, "string"),
    ("Lines", "LineID", 1, False, "int", True, "integer"),
    ("Lines", "OrderID", 2, False, "int", True, "integer"),
    ("Lines", "Amount", 5, False, "decimal", False, "double"),
    ("Lines", "Gift", 6, False, "bit", False, "boolean"),
    ("Tags", "TagID", 1, False, "int", True, "integer"),
]


@pytest.fixture(scope="module")
def dd():
    return DataDictionary.from_rows(ROWS)


def test_lookups(dd):
    assert dd.tables() == ["Lines", "Tags"]
    assert dd.names("Lines") == ["LineID", "OrderID", "Amount", "Gift", "Sold"]
    assert dd.primary_keys("Lines") == ["LineID", "OrderID"]
    assert dd.not_null("Lines") == ["LineID", "OrderID", "Amount"]
    assert dd.not_null("Lines", include_flags=True) == ["LineID", "OrderID", "Amount", "Gift"]
    assert dd.dates("Lines") == ["Sold"]
    with pytest.raises(KeyError):
        dd.columns("Nowhere")


def test_schema(spark, dd):
    assert dd.schema("Lines").simpleString() == (
        "struct<LineID:int,OrderID:int,Amount:double,Gift:boolean,Sold:string>"
    )
    assert dd.schema("Lines", typed_dates=True)["Sold"].dataType == T.TimestampNTZType()


def test_csv_round_trip(spark, dd, tmp_path):
    path = str(tmp_path / "dictionary")
    dd.to_frame(spark).write.option("header", True).csv(path)
    again = DataDictionary.from_csv(spark, path)
    assert [again.columns(t) for t in again.tables()] == [dd.columns(t) for t in dd.tables()]


def test_merge_condition_has_every_key(dd):
    text = str(merge_condition(dd.primary_keys("Lines"), "t"))
    assert "LineID" in text and "OrderID" in text and "AND" in text.upper()


HEADER = DataDictionary.from_rows(
    [("t", "a", 1, False, "int", True, "integer"), ("t", "b", 2, True, "nvarchar", False, "string")]
)


def frame(spark, *names):
    return spark.range(1).select(*[F.lit(1).alias(n) for n in names])


def test_header_ignores_order_and_framework_columns(spark):
    df = frame(spark, "b", "a", "part_date", "_id", "IngestTimeStamp")
    assert header_matches(df, HEADER, "t")
    assert column_list(df) == ["b", "a", "part_date", "_id", "IngestTimeStamp"]


def test_header_differences(spark):
    df = frame(spark, "a", "c", "part_date")
    assert not header_matches(df, HEADER, "t")
    report = {r["column_name"]: r["status"] for r in header_report(df, HEADER, "t").collect()}
    assert report == {"a": "ok", "b": "missing", "c": "unexpected", "part_date": "ok"}
    with pytest.raises(HeaderMismatch):
        header_matches(df, HEADER, "t", strict=True)


def test_header_is_case_sensitive_and_wants_the_partition_column(spark):
    assert not header_matches(frame(spark, "A", "b", "part_date"), HEADER, "t")
    assert not header_matches(frame(spark, "a", "b"), HEADER, "t")


def test_document_header(spark):
    docs = spark.createDataFrame([('{"a": 1, "x": 2}',), ('{"a": 3, "_id": 9}',), (None,)], "d string")
    report = document_header_report(docs, F.col("d"), HEADER, "t")
    assert {tuple(r) for r in report.collect()} == {
        ("a", "ok", 2), ("b", "missing", 0), ("x", "unexpected", 1)
    }
