"""Tables that are rebuilt, and rules that merging must not hide."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.scalars import parse_timestamp
from medallion.operators.joins import left_lookup
from medallion.operators.quality import good_rows
from medallion.operators.rules import Rule, not_null_rule, type_rule
from medallion.sinks.catalog import create_database, register_table


def test_a_rebuilt_table_is_registered_with_its_new_columns(spark, tmp_path):
    create_database(spark, "rebuilt")
    path = str(tmp_path / "t")
    for rows in (["a"], ["b", "c"]):
        df = spark.createDataFrame([(r,) for r in rows], "x string")
        df = df.withColumn("y", F.lit(len(rows))) if len(rows) > 1 else df
        df.write.mode("overwrite").parquet(path)
        register_table(spark, "rebuilt", "t", path)
        got = spark.table("rebuilt.t")
        assert got.columns == df.columns and sorted(got.collect()) == sorted(df.collect())
    spark.sql("DROP DATABASE rebuilt CASCADE")


def test_text_nan_and_user_rules_of_a_required_number(spark):
    df = spark.createDataFrame([("1",), ("NaN",), ("x",), ("900",), (None,)], "n string")
    rules = [not_null_rule("n", T.StringType()), type_rule("n", T.StringType(), T.DoubleType())]
    assert [r.n for r in good_rows(df, rules).collect()] == ["1", "900"]
    rules.append(Rule("range", "n", F.coalesce(F.col("n").try_cast("double") > 100, F.lit(False)), "too large"))
    assert [r.n for r in good_rows(df, rules).collect()] == ["1"]


def test_null_keys_are_spread_without_a_bound(spark):
    left = spark.range(5000).select("id", F.lit(None).cast("long").alias("k"))
    right = spark.createDataFrame([(1, "a")], "key long, v string")
    out = left_lookup(left, right, "k", "key", ["id"])
    assert out.count() == 5000 and out.where("v is not null").count() == 0
    assert "pmod(xxhash64(id" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_dates_with_an_offset_become_utc_in_any_session_zone(spark):
    texts = {
        "2024-01-01T10:00:00+05:00": "2024-01-01 05:00:00", "2024-01-01T10:00:00Z": "2024-01-01 10:00:00",
        "2024-01-01 10:00:00.5": "2024-01-01 10:00:00.5", "2024-01-05": "2024-01-05 00:00:00",
        "2024-01-01T10:00:00.123456-02:30": "2024-01-01 12:30:00.123456", "2024-01-01T10:00:00+99:00": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            parsed = parse_timestamp(F.col("t"), T.StringType()).cast("string").alias("p")
            assert {r.t: r.p for r in df.select("t", parsed).collect()} == texts
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
