"""Tables bucketed by key, so that joins and merges on the key do not shuffle them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _quoted(names: list[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def write_bucketed(
    df: DataFrame, table: str, path: str, keys: list[str], buckets: int, clustered: bool = False
) -> None:
    """One file per bucket at `path`, registered as `table`.

    For keys with few rows each, such as a primary key: a bucket is read by one task, so a hot key
    would not be split. `clustered` says that rows of a bucket sit in one partition already (a merge
    of bucketed tables); otherwise rows are brought together here, with the hash buckets use.
    """
    if not clustered:
        df = df.repartition(buckets, *keys)
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(table)
    )


def bucketed_table(
    spark: SparkSession, table: str, path: str, schema: T.StructType, keys: list[str], buckets: int
) -> DataFrame:
    """The table at `path`, declared here if this session's catalog does not know it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET "
        f"CLUSTERED BY ({_quoted(keys)}) SORTED BY ({_quoted(keys)}) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(table)
