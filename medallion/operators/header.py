"""Header check: do the columns of a table equal the dictionary's?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.dictionary import DataDictionary

# Columns the framework adds around a source table.
PARTITION_COLUMN = "part_date"
IGNORED_COLUMNS = ("IngestTimeStamp", "_id")


class HeaderMismatch(ValueError):
    pass


def column_list(df: DataFrame) -> list[str]:
    """Column names of a table; schema only, no job."""
    return df.columns


def header_differences(
    df: DataFrame, dictionary: DataDictionary, table: str
) -> tuple[list[str], list[str]]:
    """(missing, unexpected) names. Case counts; order and types do not."""
    expected = {*dictionary.names(table), PARTITION_COLUMN}
    actual = set(df.columns) - set(IGNORED_COLUMNS)
    return sorted(expected - actual), sorted(actual - expected)


def header_matches(
    df: DataFrame, dictionary: DataDictionary, table: str, strict: bool = False
) -> bool:
    missing, unexpected = header_differences(df, dictionary, table)
    if strict and (missing or unexpected):
        raise HeaderMismatch(f"{table}: missing {missing}, unexpected {unexpected}")
    return not missing and not unexpected


def header_report(df: DataFrame, dictionary: DataDictionary, table: str) -> DataFrame:
    """One row per column name with status ok, missing or unexpected."""
    missing, unexpected = header_differences(df, dictionary, table)
    expected = [*dictionary.names(table), PARTITION_COLUMN]
    rows = [(name, "missing" if name in missing else "ok") for name in expected]
    rows += [(name, "unexpected") for name in unexpected]
    return df.sparkSession.createDataFrame(rows, "column_name string, status string")


def document_header_report(
    docs: DataFrame, document: Column, dictionary: DataDictionary, table: str
) -> DataFrame:
    """Header check of schema-less JSON documents: which dictionary names occur, and in how many.

    A document collection has no header but the keys of its documents, so this one reads the data.
    Keys are counted with the dictionary's names added at zero: one aggregate, whose exchange carries
    one row per name and task.
    """
    names = dictionary.names(table)
    found = docs.select(
        F.explode(F.json_object_keys(document)).alias("column_name"), F.lit(1).alias("n")
    ).where(~F.col("column_name").isin(*IGNORED_COLUMNS))
    expected = docs.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("column_name"), F.lit(0).alias("n")
    )
    return (
        found.union(expected)
        .groupBy("column_name")
        .agg(F.sum("n").alias("n_documents"))
        .select(
            "column_name",
            F.when(~F.col("column_name").isin(*names), "unexpected")
            .when(F.col("n_documents") == 0, "missing")
            .otherwise("ok")
            .alias("status"),
            "n_documents",
        )
    )
