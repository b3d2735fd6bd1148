"""Batch and stream readers."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.dictionary import DataDictionary
from medallion.operators.header import PARTITION_COLUMN


def read_source(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """One collection or table of any format on the classpath; without `schema` it is inferred."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def jdbc_options(
    url: str, table: str, partition_column: str, lower: str, upper: str, partitions: int, **more: str
) -> dict[str, str]:
    """Options of a relational source, read in ranges of a column.

    The range is required: without one a JDBC source is read whole by a single task. Credentials
    belong to the caller's `more` (from a secret store), never to this repository.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
        **more,
    }


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, merge_schema: bool = False
) -> DataFrame:
    """A layer's table. `merge_schema` looks at every file's footer; leave it off unless files drift."""
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def read_day(spark: SparkSession, path: str, as_of: date) -> DataFrame:
    """One day of a partitioned table; the other days' files are not listed for the scan."""
    return spark.read.parquet(path).where(F.col(PARTITION_COLUMN) == F.lit(as_of))


def read_silver(spark: SparkSession, database: str, dictionary: DataDictionary) -> dict[str, DataFrame]:
    """Clean tables by catalog name, as input of the gold plans."""
    return {t: spark.table(f"`{database}`.`{t}_silver`") for t in dictionary.tables()}


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Files of a directory as a stream. The schema is declared, so drift cannot change it mid-run.

    One of the limits bounds a micro-batch; the checkpoint of the query remembers files taken.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(path)


def arriving_files(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Files of a directory as a stream of their metadata: (file_path, modified), a row for each row of a file.

    No column is read, so a file of any schema passes.
    """
    files = stream_files(spark, path, T.StructType(), max_files=max_files, max_bytes=max_bytes)
    return files.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
