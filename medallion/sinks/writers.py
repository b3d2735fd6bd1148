"""Writers of the layers. Every write is one pass over its frame."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators.header import PARTITION_COLUMN


# Codec of tables that are large and written once: a quarter smaller than Spark's default.
COMPACT = "zstd"
WORKING_PIECE = "16m"


def with_part_date(df: DataFrame, as_of: date) -> DataFrame:
    """The load date is a parameter, so that a rerun or retry on another day writes the same rows."""
    return df.withColumn(PARTITION_COLUMN, F.lit(as_of))


def _static(df: DataFrame, mode: str):
    # "static" replaces the whole table on overwrite, whatever the session's own setting.
    return df.write.mode(mode).option("partitionOverwriteMode", "static")


def write_full(df: DataFrame, path: str, as_of: date) -> None:
    """Full load: replaces the table, all earlier load dates included."""
    _static(with_part_date(df, as_of), "overwrite").partitionBy(PARTITION_COLUMN).parquet(path)


def write_errors(errors: DataFrame, path: str, as_of: date) -> None:
    """Error records of a full load, into the directory of its date.

    Other dates stay. A rerun for the same date replaces its own records instead of adding them
    again, also when the rerun finds none.
    """
    _static(errors, "overwrite").parquet(f"{path}/{PARTITION_COLUMN}={as_of.isoformat()}")


def rebalanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a directory-to-be brought together in files of the advisory size.

    Without it every task writes a file into every directory it has rows for. Adaptive execution
    merges small partitions and splits large ones, so a directory with most of the rows is still
    written by many tasks.
    """
    return df.hint("rebalance", *columns)


def append_landing(df: DataFrame, path: str, as_of: date, route: str | None = None) -> None:
    """Add arrivals to a landing directory; files of earlier arrivals stay.

    With `route`, one pass writes a directory per value of that column (one per collection).
    """
    columns = [PARTITION_COLUMN]
    if route:
        df, columns = rebalanced(df, route), [route, PARTITION_COLUMN]
    with_part_date(df, as_of).write.mode("append").partitionBy(*columns).parquet(path)


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch_id: int, *partitions: str) -> None:
    """A micro-batch into its own directory. Overwrites only itself, so a retry changes nothing."""
    _static(df, "overwrite").partitionBy(*partitions).parquet(batch_path(path, batch_id))


def write_gold(
    df: DataFrame,
    path: str,
    order_by: list[str] | None = None,
    leave_out: list[str] | None = None,
    total_order: bool = False,
) -> None:
    """A gold table, replaced. Sorted within files by `order_by`, which needs no shuffle.

    `total_order` sorts across files too (a range exchange). Order by a unique last column: rows of
    one hot key can then be cut into several ranges. Columns in `leave_out` serve the order only.
    Files are compressed as `COMPACT` says.
    """
    if order_by:
        df = df.orderBy(*order_by) if total_order else df.sortWithinPartitions(*order_by)
    _static(df.drop(*(leave_out or [])), "overwrite").option("compression", COMPACT).parquet(path)


def write_working(df: DataFrame, path: str) -> DataFrame:
    """`df` written for reading it several times, and read back. `path` is to be removed when that is done.

    It is read by a session of the same settings but for smaller pieces: files are packed closely, and the rows of a
    piece are to be sorted in a task's memory.
    """
    _static(df, "overwrite").option("compression", COMPACT).parquet(path)
    spark, own = df.sparkSession, df.sparkSession.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", WORKING_PIECE)
    return own.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The file system that holds `path`, with the path in its own type. Metadata only."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def child_directories(spark: SparkSession, path: str) -> dict[str, str]:
    """Names and paths of the directories below `path`."""
    fs, root = _file_system(spark, path)
    if not fs.exists(root):
        return {}
    return {
        s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(root) if s.isDirectory()
    }


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a write to `path` has finished."""
    fs, marker = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def remove_directory(spark: SparkSession, path: str) -> None:
    fs, directory = _file_system(spark, path)
    fs.delete(directory, True)


def write_bytes(spark: SparkSession, path: str, content: bytes) -> str:
    """A small file, such as code that executors need; returns its path with its file system's name."""
    fs, file = _file_system(spark, path)
    stream = fs.create(file, True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    return fs.makeQualified(file).toString()
