"""Data quality in one pass: profile, split into good rows and error records, report."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.functions.scalars import is_blank
from medallion.operators.rules import Rule

VIOLATION_FIELDS = ("rule", "column_name", "bad_value", "error_desc")


class Split(NamedTuple):
    good: DataFrame
    errors: DataFrame


def any_broken(rules: list[Rule]) -> Column:
    """True for a bad row. A plain OR: evaluated in generated code, stops at the first hit.

    A required number or flag held as text needs one test instead of two rules': NULL, '' and words
    for NULL are no numbers either, so a failed cast covers them all. Short conditions matter, since
    the code generated for a wide table's rules is a single method (see `session.DEFAULTS`).
    """
    required = {r.column for r in rules if r.rule == "not_null"}
    merged = {r.column: r.no_value for r in rules if r.no_value is not None and r.column in required}
    covered = ("not_null", "type")
    tests = [r.broken for r in rules if r.column not in merged or r.rule not in covered]
    tests += list(merged.values())
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _violation(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.rule).alias("rule"),
        F.lit(rule.column).alias("column_name"),
        (F.col(f"`{rule.column}`") if rule.value is None else rule.value).cast("string").alias("bad_value"),
        F.lit(rule.error_desc).alias("error_desc"),
    )


def good_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break no rule. A filter: no shuffle, and duplicate rows stay."""
    return df.where(~any_broken(rules))


def error_records(df: DataFrame, rules: list[Rule], first: str | None = None) -> DataFrame:
    """One record per (bad row, broken rule): the whole row as read, plus what is wrong with it.

    Good rows leave before the violation array is built, so its cost falls on bad rows only. `first` names a
    flag that is true for one record of each bad row.
    """
    if not rules:
        nothing = [F.lit(None).cast("string").alias(name) for name in VIOLATION_FIELDS]
        flag = [F.lit(True).alias(first)] if first else []
        return df.where(F.lit(False)).select("*", *nothing, *flag)
    violations = F.array_compact(F.array(*[F.when(r.broken, _violation(r)) for r in rules]))
    flag = [(F.col("_place") == 0).alias(first)] if first else []
    return (
        df.where(any_broken(rules))
        .select("*", F.posexplode(violations).alias("_place", "_violation"))
        .select(*[f"`{c}`" for c in df.columns], "_violation.*", *flag)
    )


def split(df: DataFrame, rules: list[Rule]) -> Split:
    """Good rows and error records of the same rows; both are narrow."""
    return Split(good_rows(df, rules), error_records(df, rules))


def null_profile(df: DataFrame, columns: list[str], match: str = "contains") -> DataFrame:
    """One row: per column the number of missing values. One scan, one partial aggregate per task."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.agg(*[F.count_if(is_blank(c, types[c], match)).alias(c) for c in columns])


def fill_nulls(df: DataFrame) -> DataFrame:
    """NULL (and NaN) numbers become 0, NULL text becomes ''."""
    return df.na.fill(0).na.fill("")


def has_rows(df: DataFrame) -> bool:
    """Gate before a write: stops at the first row found instead of counting all."""
    return not df.isEmpty()


def quality_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Good, bad and all rows, and the number of violations, in one scan."""
    violations = reduce(lambda a, b: a + b, (r.broken.cast("int") for r in rules), F.lit(0))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(violations == 0).alias("n_good"),
        F.count_if(violations > 0).alias("n_bad"),
        F.coalesce(F.sum(violations), F.lit(0)).cast("bigint").alias("n_violations"),
    )


def error_report(errors: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Errors by rule and column: records, distinct keys, and one value as a sample.

    Grouped by the key first and by rule and column second, so that a rule broken by a third of all
    rows is spread over all tasks before its few totals are put together.
    """
    per_key = errors.groupBy("rule", "column_name", *keys).agg(
        F.count("*").alias("n"), F.min("bad_value").alias("sample")
    )
    return per_key.groupBy("rule", "column_name").agg(
        F.sum("n").alias("n_rows"),
        F.count("*").alias("n_keys"),
        F.min("sample").alias("sample_value"),
    ).select(F.lit(table).alias("table_name"), "*")

