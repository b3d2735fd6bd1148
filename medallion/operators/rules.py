"""Validation rules generated from the dictionary.

A rule is one boolean Column that is true for a bad row and never NULL. Rules of all columns are
evaluated together in one pass by `medallion.operators.quality`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.dictionary import DataDictionary
from medallion.functions.scalars import is_blank, parse_timestamp

# Descriptions written to the error table, followed by the column name.
NULL_ERROR = "NULL Check Failed for Column "
TYPE_ERROR = "Data Type MisMatch for "
DATE_ERROR = "Date Parse Failed for Column "
CORRUPT_ERROR = "Document Cannot Be Read"
DRIFT_ERROR = "Schema Drift in Column "

# Column that keeps the raw text of a document that does not fit its schema.
CORRUPT_COLUMN = "_corrupt_record"


@dataclass(frozen=True)
class Rule:
    """`no_value`, on type rules of text columns: true for a value that is missing or does not fit.

    `value` is the bad value, where that isn't the column's.
    """

    rule: str
    column: str
    broken: Column
    error_desc: str
    no_value: Column | None = None
    value: Column | None = None


def not_null_rule(column: str, data_type: T.DataType, match: str = "contains") -> Rule:
    return Rule("not_null", column, is_blank(column, data_type, match), NULL_ERROR + column)


def _always_castable(actual: T.DataType, declared: T.DataType) -> bool:
    widening = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
    if actual == declared or isinstance(declared, T.StringType):
        return True
    return (
        isinstance(actual, widening)
        and isinstance(declared, widening)
        and widening.index(type(actual)) <= widening.index(type(declared))
    )


def type_rule(column: str, actual: T.DataType, declared: T.DataType) -> Rule | None:
    """Value that does not fit the declared type; None where every value fits.

    NULL and '' are missing values, not mismatches.
    """
    if _always_castable(actual, declared):
        return None
    value = F.col(f"`{column}`")
    castable = isinstance(actual, (T.StringType, T.NumericType, T.BooleanType))
    fits = (value if castable else value.cast("string")).try_cast(declared).isNotNull()
    if isinstance(declared, (T.FloatType, T.DoubleType)) and isinstance(actual, T.StringType):
        fits = fits & ~F.isnan(value.try_cast(declared))  # text NaN is a missing value, not a number
        fits = F.coalesce(fits, F.lit(False))
    broken = value.isNotNull() & ~fits
    no_value = None
    if isinstance(actual, T.StringType):
        broken = broken & (value != "")
        if isinstance(declared, (T.NumericType, T.BooleanType)):
            no_value = ~fits
    return Rule("type", column, broken, TYPE_ERROR + column, no_value)


def date_rule(column: str, actual: T.DataType) -> Rule | None:
    """Text in a date column that is no date; None where the column is a date already."""
    if isinstance(actual, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return None
    value = F.col(f"`{column}`")
    broken = value.isNotNull() & parse_timestamp(value, actual).isNull()
    if isinstance(actual, T.StringType):
        broken = broken & (value != "")
    return Rule("date", column, broken, DATE_ERROR + column)


def rules_for(
    df: DataFrame,
    dictionary: DataDictionary,
    table: str,
    match: str = "contains",
    include_flags: bool = False,
) -> list[Rule]:
    """All rules of a table for the columns it has; absent columns are the header check's matter."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    declared = dictionary.schema(table)
    required = set(dictionary.not_null(table, include_flags))
    rules: list[Rule | None] = []
    for spec in dictionary.columns(table):
        if spec.name not in actual:
            continue
        data_type = actual[spec.name]
        if spec.name in required:
            rules.append(not_null_rule(spec.name, data_type, match))
        if spec.is_date:
            rules.append(date_rule(spec.name, data_type))
        else:
            rules.append(type_rule(spec.name, data_type, declared[spec.name].dataType))
    return [r for r in rules if r is not None]


def corrupt_rule() -> Rule:
    return Rule("corrupt", CORRUPT_COLUMN, F.col(CORRUPT_COLUMN).isNotNull(), CORRUPT_ERROR)


def drift_rules(columns: list[str], rescued: str, others: list[Rule]) -> list[Rule]:
    """Values of declared columns that a retyped file holds and the declared type doesn't; see `sources.drift`.

    Such a value is no missing one, so `others` on that column are held back where it is rescued.
    """

    def rule(column: str) -> Rule:
        value = F.get_json_object(F.col(rescued), f"$['{column}']")
        broken = F.col(rescued).isNotNull() & value.isNotNull()
        return Rule("schema_drift", column, broken, DRIFT_ERROR + column, value=value)

    drift = {column: rule(column) for column in columns}
    rest = [replace(r, broken=r.broken & ~drift[r.column].broken) if r.column in drift else r for r in others]
    return [*drift.values(), *rest]


def document_rules(rules: list[Rule]) -> list[Rule]:
    """Rules for parsed documents: one that cannot be read is `corrupt` and nothing else.

    Its fields are NULL for want of a value, which must not count as further violations.
    """
    corrupt = corrupt_rule()

    def gated(condition: Column | None) -> Column | None:
        return None if condition is None else ~corrupt.broken & condition

    return [corrupt, *(replace(r, broken=gated(r.broken), no_value=gated(r.no_value)) for r in rules)]
