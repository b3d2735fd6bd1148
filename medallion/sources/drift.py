"""Files whose schema isn't the declared one: found by their footers, read without losing a value."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column that keeps, as JSON, what of a row isn't in the declared columns.
RESCUED_COLUMN = "_rescued"
#: Footers read side by side.
FOOTERS_AT_ONCE = 16

_WRITE = re.compile(r"part-\d{5}-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")
_EXACT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def readable(file_path: str) -> str:
    """A path as the readers take it, from the encoded form that file metadata has; pattern characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file_path))


def _write_of(file_path: str) -> str:
    """Which write a file is from; itself, if its name doesn't say. All files of one write have one schema."""
    directory, _, name = file_path.rpartition("/")
    found = _WRITE.match(name)
    return f"{directory}/{found[1]}" if found else file_path


def footer_schemas(spark: SparkSession, files: Iterable[str]) -> list[tuple[T.StructType, list[str]]]:
    """The different schemas in the footers of Parquet files, each with its files.

    One footer per write is read, or per file where names don't tell the write; no data. Fields that differ in
    nullability only are one schema.
    """
    writes: dict[str, list[str]] = {}
    for path in sorted(files):
        writes.setdefault(_write_of(path), []).append(path)

    def schema(paths: list[str]) -> T.StructType:
        return spark.read.parquet(readable(paths[0])).schema

    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(schema), writes.values()))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for one, paths in zip(found, writes.values()):
        groups.setdefault(one.simpleString(), (one, []))[1].extend(paths)
    return list(groups.values())


def _fits(value: Column, actual: T.DataType, declared: T.DataType) -> tuple[Column, Column]:
    """The value at its declared type, and whether nothing of it is lost. Text need only be readable."""
    if not isinstance(actual, T.AtomicType) or not isinstance(declared, T.AtomicType):
        return F.lit(None).cast(declared), F.lit(False)
    cast = value.try_cast(declared)
    same = cast.isNotNull()
    if isinstance(actual, T.NumericType) and isinstance(declared, T.NumericType):
        same = same & (cast.try_cast(actual) == value)
    return cast, F.coalesce(same, F.lit(False))


def fit_to(df: DataFrame, declared: T.StructType) -> DataFrame:
    """The declared columns, and `_rescued`: a JSON object of all other values, NULL if there are none.

    Rescued are columns that aren't declared, and values that don't fit the declared type (they are NULL in their
    column). Declared columns that `df` lacks are NULL. Names that differ by case only are one name where the
    session says so.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"

    def same(name: str) -> str:
        return name if exact else name.lower()

    actual = {same(f.name): f.dataType for f in df.schema.fields}
    known = {same(n) for n in declared.names}
    columns, rescued = [], []
    for field in declared.fields:
        if same(field.name) not in actual:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value, kind = F.col(f"`{field.name}`"), actual[same(field.name)]
        if kind == field.dataType:
            columns.append(value.alias(field.name))
            continue
        cast, fits = _fits(value, kind, field.dataType)
        columns.append(F.when(fits, cast).alias(field.name))
        rescued.append(F.when(~fits, value).alias(field.name))
    rescued += [F.col(f"`{f.name}`") for f in df.schema.fields if same(f.name) not in known]
    left = F.lit(None).cast("string")
    if rescued:
        options = {"timestampFormat": _EXACT, "timestampNTZFormat": _EXACT}
        left = F.nullif(F.to_json(F.struct(*rescued), options), F.lit("{}"))
    return df.select(*columns, left.alias(RESCUED_COLUMN))


def read_drifting(spark: SparkSession, files: Iterable[str], declared: T.StructType) -> tuple[DataFrame, list[T.StructType]]:
    """Files of any schemas as the declared columns and `_rescued`, and the schemas found."""
    groups = footer_schemas(spark, files)
    parts = [
        fit_to(spark.read.schema(schema).parquet(*map(readable, paths)), declared) for schema, paths in groups
    ]
    return reduce(DataFrame.unionByName, parts), [schema for schema, _ in groups]
