"""Bring good rows to the clean layer's types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.dictionary import DataDictionary
from medallion.functions.scalars import parse_timestamp, render_timestamp


def standardize_dates(df: DataFrame, columns: list[str], render: bool = False) -> DataFrame:
    """Date columns as timestamps, or with `render` as text `MM-dd-yyyy HH:mm:ss`.

    Unreadable text becomes NULL. The text form is for presentation: it does not sort by time.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name in columns:
        parsed = parse_timestamp(F.col(f"`{name}`"), types[name])
        changed[name] = render_timestamp(parsed) if render else parsed
    return df.withColumns(changed) if changed else df


def conform(df: DataFrame, dictionary: DataDictionary, table: str) -> DataFrame:
    """Dictionary columns in ordinal order at their declared types, dates as timestamps.

    Columns outside the dictionary follow unchanged. Meant for good rows, where every cast succeeds;
    '' in a column that is not text becomes NULL.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    declared = dictionary.schema(table)
    selected = []
    for spec in dictionary.columns(table):
        if spec.name not in types:
            continue
        value = F.col(f"`{spec.name}`")
        if spec.is_date:
            value = parse_timestamp(value, types[spec.name])
        elif types[spec.name] != declared[spec.name].dataType:
            value = value.try_cast(declared[spec.name].dataType)
        selected.append(value.alias(spec.name))
    known = set(dictionary.names(table))
    selected += [F.col(f"`{c}`") for c in df.columns if c not in known]
    return df.select(*selected)
