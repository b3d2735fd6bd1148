"""Flatten documents: arrays to rows, structs to columns. Narrow: no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: characters that are not allowed in a flattened column name.
UNSAFE_NAME_CHARACTERS = "@|?()!./:"

_UNSAFE = re.compile(f"[{re.escape(UNSAFE_NAME_CHARACTERS)}]")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def safe_name(name: str) -> str:
    return _UNSAFE.sub("_", name)


def _check_unique(names: list[str]) -> None:
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"flattened column names collide: {repeated}")


def sanitize_names(df: DataFrame) -> DataFrame:
    names = [safe_name(c) for c in df.columns]
    _check_unique(names)
    return df.toDF(*names)


def expand_structs(df: DataFrame) -> DataFrame:
    """Children of every struct column as columns `<parent>_<child>`, moved to the end."""
    plain = [F.col(_quoted(f.name)) for f in df.schema.fields if not isinstance(f.dataType, T.StructType)]
    names = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StructType)]
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            for child in field.dataType.names:
                name = safe_name(f"{field.name}.{child}")
                plain.append(F.col(f"{_quoted(field.name)}.{_quoted(child)}").alias(name))
                names.append(name)
    _check_unique(names)
    return df.select(*plain)


def explode_array(df: DataFrame, column: str) -> DataFrame:
    """One row per element with its zero-based `<column>_pos`; an empty or NULL array keeps its row."""
    others = [F.col(_quoted(c)) for c in df.columns if c != column]
    _check_unique([*df.columns, f"{column}_pos"])
    return df.select(
        *others, F.posexplode_outer(F.col(_quoted(column))).alias(f"{column}_pos", column)
    )


def flatten(df: DataFrame) -> DataFrame:
    """Repeat both steps until no array and no struct is left; maps stay as they are.

    Sibling arrays multiply (every pairing of their elements), as independent lists of one document
    do in a flat table. The loop runs over the schema only; the result is a single plan.
    """
    df = sanitize_names(df)
    while True:
        fields = df.schema.fields
        array = next((f.name for f in fields if isinstance(f.dataType, T.ArrayType)), None)
        if any(isinstance(f.dataType, T.StructType) for f in fields):
            df = expand_structs(df)
        elif array is not None:
            df = explode_array(df, array)
        else:
            return df
