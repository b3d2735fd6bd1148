"""Rules over rows: is the primary key present, and is it unique?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.operators.quality import VIOLATION_FIELDS, Split

NULL_KEY, REPEATED_KEY = "null_key", "duplicate_key"
NULL_KEY_ERROR, REPEATED_KEY_ERROR = "Primary Key Is NULL: ", "Primary Key Is Not Unique: "


def _key(keys: list[str]) -> list[Column]:
    return [F.col(f"`{k}`") for k in keys]


def _missing(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (c.isNull() for c in _key(keys)))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without NULL that more than one row has, with their number of rows.

    Counted in every task before the shuffle, so a key with a third of all rows is one row per task.
    """
    counted = df.where(~_missing(keys)).groupBy(*_key(keys)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where("n_rows > 1")


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Error records of rows whose key is NULL in part (`null_key`) or that share it with another row (`duplicate_key`).

    The whole row as read, with the fields of other error records; `bad_value` is the key as JSON. All rows of a
    repeated key are violations, copies too, since none is known to be the right one. Only the repeated keys meet
    the rows again, in a join whose skewed keys adaptive execution splits. Without rows there are none.
    """
    if not keys:
        raise ValueError("a table without primary key has no rule over keys")
    names = ",".join(keys)
    value = F.to_json(F.struct(*_key(keys)), {"ignoreNullFields": "false"})

    def records(rows: DataFrame, rule: str, error: str) -> DataFrame:
        fields = (F.lit(rule), F.lit(names), value, F.lit(error + names))
        return rows.select(*[f"`{c}`" for c in df.columns], *[f.alias(n) for f, n in zip(fields, VIOLATION_FIELDS)])

    missing = records(df.where(_missing(keys)), NULL_KEY, NULL_KEY_ERROR)
    again = df.join(repeated_keys(df, keys).drop("n_rows"), keys, "left_semi")
    return missing.unionByName(records(again, REPEATED_KEY, REPEATED_KEY_ERROR))


def split_by_key(df: DataFrame, keys: list[str]) -> Split:
    """Rows whose key is whole and their own, and error records of the others."""
    good = df.where(~_missing(keys)).join(repeated_keys(df, keys).drop("n_rows"), keys, "left_anti")
    return Split(good.select(*[f"`{c}`" for c in df.columns]), key_violations(df, keys))
