import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.dictionary import DataDictionary
from medallion.functions.scalars import amount_excluding_tax, later_of, tax_amount
from medallion.operators.quality import (
    any_broken,
    error_records,
    error_report,
    fill_nulls,
    good_rows,
    has_rows,
    null_profile,
    quality_counts,
    split,
)
from medallion.operators.rules import date_rule, not_null_rule, rules_for, type_rule
from medallion.operators.standardize import conform, standardize_dates

DD = DataDictionary.from_rows(
    [
        ("t", "id", 1, False, "int", True, "integer"),
        ("t", "name", 2, False, "nvarchar", False, "string"),
        ("t", "amount", 3, True, "decimal", False, "double"),
        ("t", "flag", 4, False, "bit", False, "boolean"),
        ("t", "day", 5, True, "datetime2", False, "string"),
    ]
)
TEXTS = [None, "", "NULL", "None", "xNULLy", "ok"]


def flagged(df, rule):
    return [r[0] for r in df.where(rule.broken).collect()]


def test_null_rule_on_text(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "c string")
    assert flagged(df, not_null_rule("c", T.StringType())) == [None, "", "NULL", "None", "xNULLy"]
    assert flagged(df, not_null_rule("c", T.StringType(), "exact")) == [None, "", "NULL", "None"]
    with pytest.raises(ValueError):
        not_null_rule("c", T.StringType(), "other")


def test_null_rule_on_numbers_and_others(spark):
    df = spark.createDataFrame([(1.0, 1, True), (math.nan, None, None), (None, 2, False)], "d double, i int, b boolean")
    assert df.where(not_null_rule("d", T.DoubleType()).broken).count() == 2
    assert df.where(not_null_rule("i", T.IntegerType()).broken).count() == 1
    assert df.where(not_null_rule("b", T.BooleanType()).broken).count() == 1


def test_type_rule_integer(spark):
    df = spark.createDataFrame([(t,) for t in ["7", " 7 ", "abc", "3.7", "3000000000", None, ""]], "c string")
    rule = type_rule("c", T.StringType(), T.IntegerType())
    assert flagged(df, rule) == ["abc", "3.7", "3000000000"]


def test_type_rule_is_left_out_where_every_value_fits():
    assert type_rule("c", T.IntegerType(), T.DoubleType()) is None
    assert type_rule("c", T.LongType(), T.StringType()) is None
    assert type_rule("c", T.LongType(), T.IntegerType()) is not None
    assert date_rule("c", T.DateType()) is None


def test_type_rule_overflow_and_uncastable(spark):
    df = spark.createDataFrame([(2**40,), (5,)], "c bigint")
    assert flagged(df, type_rule("c", T.LongType(), T.IntegerType())) == [2**40]
    stamps = spark.createDataFrame([(datetime(2024, 1, 1),)], "c timestamp")
    assert stamps.where(type_rule("c", T.TimestampType(), T.BooleanType()).broken).count() == 1


def test_date_rule(spark):
    df = spark.createDataFrame([(t,) for t in ["2019-12-30 01:02:03", "2020-02-30", "soon", "", None]], "c string")
    assert flagged(df, date_rule("c", T.StringType())) == ["2020-02-30", "soon"]


def rows(spark, *data):
    return spark.createDataFrame(data, "id string, name string, amount string, flag string, day string")


@pytest.mark.parametrize("bad", [0, 1, 2])
def test_null_errors_are_recorded_for_any_count(spark, bad):
    df = rows(spark, *[(str(i), None if i < bad else "n", "1", "true", None) for i in range(4)])
    assert error_records(df, rules_for(df, DD, "t")).count() == bad


def test_two_bad_columns_give_two_records_of_one_row(spark):
    df = rows(spark, ("1", "None", "much", "true", "2024-01-01"), ("2", "n", "1", "true", "2024-01-01"))
    good, errors = split(df, rules_for(df, DD, "t"))
    found = {(r["column_name"], r["bad_value"], r["error_desc"]) for r in errors.collect()}
    assert found == {
        ("name", "None", "NULL Check Failed for Column name"),
        ("amount", "much", "Data Type MisMatch for amount"),
    }
    assert [r["id"] for r in good.collect()] == ["2"]
    assert {r["amount"] for r in errors.collect()} == {"much"}, "rows are kept as read"


def test_duplicate_keys_do_not_multiply(spark):
    df = rows(spark, ("1", "n", "x", "true", None), ("1", "n", "2", "true", None))
    good, errors = split(df, rules_for(df, DD, "t"))
    assert (good.count(), errors.count()) == (1, 1)


def test_duplicate_good_rows_stay(spark):
    df = rows(spark, ("1", "n", "2", "true", None), ("1", "n", "2", "true", None))
    assert good_rows(df, rules_for(df, DD, "t")).count() == 2


def test_null_flag_passes_unless_asked_for(spark):
    df = rows(spark, ("1", "n", "2", None, None))
    assert good_rows(df, rules_for(df, DD, "t")).count() == 1
    assert good_rows(df, rules_for(df, DD, "t", include_flags=True)).count() == 0


NUMBERS_AS_TEXT = ["7", " 7 ", "abc", "3.7", "3000000000", None, "", "NULL", "xNone", "NaN", "true", "1e3", "  "]


@pytest.mark.parametrize("declared", ["integer", "double", "boolean", "bigint", "decimal(10,2)"])
@pytest.mark.parametrize("match", ["contains", "exact"])
def test_merged_test_of_a_required_number_equals_its_two_rules(spark, declared, match):
    dd = DataDictionary.from_rows([("t", "c", 1, False, "x", True, declared)])
    df = spark.createDataFrame([(t,) for t in NUMBERS_AS_TEXT], "c string")
    rules = rules_for(df, dd, "t", match)
    assert [r.rule for r in rules] == ["not_null", "type"] and rules[1].no_value is not None
    merged = [r[0] for r in df.where(any_broken(rules)).collect()]
    assert merged == [r[0] for r in df.where(rules[0].broken | rules[1].broken).collect()]
    assert good_rows(df, rules).count() + len(merged) == len(NUMBERS_AS_TEXT)
    # one rule alone is not widened
    assert df.where(any_broken(rules[1:])).count() == df.where(rules[1].broken).count()


def test_rules_of_a_wide_table_stay_in_a_method_the_jvm_compiles(spark, tmp_path):
    kinds = [("int", "integer"), ("nvarchar", "string"), ("decimal", "double"), ("datetime2", "string")]
    dd = DataDictionary.from_rows([("t", f"c{i}", i, False, kinds[i % 4][0], i == 0, kinds[i % 4][1]) for i in range(20)])
    spark.range(10).selectExpr(*[f"cast(id as string) as c{i}" for i in range(20)]).write.parquet(str(tmp_path / "w"))
    df = spark.read.parquet(str(tmp_path / "w"))
    execution = good_rows(df, rules_for(df, dd, "t"))._jdf.queryExecution()
    codes = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(execution.executedPlan())
    sizes = [codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())]
    assert sizes and max(sizes) < 8000


def test_no_rules(spark):
    df = spark.range(3)
    good, errors = split(df, [])
    assert (good.count(), errors.count()) == (3, 0)
    assert errors.columns == ["id", "rule", "column_name", "bad_value", "error_desc"]


def test_quality_is_one_narrow_stage(spark):
    df = rows(spark, ("1", "n", "2", "true", None))
    good, errors = split(df, rules_for(df, DD, "t"))
    for part in (good, errors):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()


def test_profile_counts_and_report(spark):
    df = rows(spark, ("1", "None", "x", "true", "soon"), ("2", "", "1", "true", None), ("3", "n", "1", "true", None))
    assert null_profile(df, ["id", "name"]).collect() == [(0, 2)]
    rules = rules_for(df, DD, "t")
    assert quality_counts(df, rules).collect() == [(3, 1, 2, 4)]
    assert quality_counts(df.limit(0), rules).collect() == [(0, 0, 0, 0)]
    report = error_report(error_records(df, rules), "t", ["id"])
    assert {tuple(r) for r in report.collect()} == {
        ("t", "not_null", "name", 2, 2, ""), ("t", "type", "amount", 1, 1, "x"), ("t", "date", "day", 1, 1, "soon"),
    }


def test_fill_and_gate(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b string, c boolean")
    assert fill_nulls(df).collect() == [(0, "", None)]
    assert has_rows(df) and not has_rows(df.where("false"))


def test_dates_render_the_calendar_year(spark):
    df = spark.createDataFrame([("2019-12-30 01:02:03",), ("soon",)], "day string")
    assert [r[0] for r in standardize_dates(df, ["day"], render=True).collect()] == ["12-30-2019 01:02:03", None]
    assert [r[0] for r in standardize_dates(df, ["day"]).collect()] == [datetime(2019, 12, 30, 1, 2, 3), None]


def test_dates_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10 02:30:00",)], "day string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # this hour is skipped there
        assert standardize_dates(df, ["day"], render=True).first()[0] == "03-10-2024 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_conform(spark):
    df = rows(spark, ("1", "n", "", "true", "2024-01-02")).withColumn("extra", F.lit("e")).select(
        "extra", "day", "flag", "amount", "name", "id"
    )
    out = conform(df, DD, "t")
    assert out.columns == ["id", "name", "amount", "flag", "day", "extra"]
    assert out.collect() == [(1, "n", None, True, datetime(2024, 1, 2), "e")]


def test_later_of_is_not_greatest(spark):
    df = spark.createDataFrame([(1, 2), (2, 1), (None, 1), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(later_of(F.col("a"), F.col("b"))).collect()] == [2, 2, 1, None]


def test_amounts_round_half_up_on_exact_values(spark):
    df = spark.createDataFrame([(1, 0.05, 50.0), (3, 1.005, 15.0), (10**6, 99999999.99, 15.0)], "q int, p double, r double")
    out = df.select(
        amount_excluding_tax(F.col("q"), F.col("p")).cast("string"),
        tax_amount(F.col("q"), F.col("p"), F.col("r")).cast("string"),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("0.05", "0.03"), ("3.03", "0.45"), ("99999999990000.00", "14999999998500.00")
    ]
