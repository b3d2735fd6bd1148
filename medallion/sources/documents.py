"""JSON documents typed by the dictionary."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.projection import fields_once
from medallion.operators.quality import error_records, good_rows
from medallion.operators.rules import CORRUPT_COLUMN, corrupt_rule


class Parsed(NamedTuple):
    rows: DataFrame
    corrupt: DataFrame


def parse_documents(df: DataFrame, document: str, schema: T.StructType) -> DataFrame:
    """The document's fields as columns, other columns kept; a broken document in `_corrupt_record`.

    Permissive: fields that can be read are read, the rest is NULL, and the raw text is kept.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    others = [c for c in df.columns if c != document]
    return fields_once(df, F.from_json(F.col(document), with_corrupt, options), others)


def split_corrupt(parsed: DataFrame) -> Parsed:
    """Readable rows, and broken documents as error records (rule `corrupt`)."""
    rules = [corrupt_rule()]
    return Parsed(
        good_rows(parsed, rules).drop(CORRUPT_COLUMN),
        error_records(parsed, rules).drop(CORRUPT_COLUMN),
    )
