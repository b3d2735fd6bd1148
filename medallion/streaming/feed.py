"""Change feed to landing directories: one write per micro-batch routes all collections."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sinks.writers import rebalanced, with_part_date, write_batch
from medallion.sources.cdc import classify_events, look_up_documents, parse_events
from medallion.sources.readers import stream_files

_TEXT = T.StringType()

LANDING_SCHEMA = (
    T.StructType().add("op", _TEXT).add("db", _TEXT).add("key", _TEXT).add("document", _TEXT)
    .add("seq", T.LongType())
)


def land_events(
    raw: DataFrame,
    landing: str,
    batch_id: int,
    as_of: date,
    current: DataFrame | None = None,
) -> None:
    """Raw events to `<landing>/batch_id=<n>/status=<usable|rejected>/coll=<name>/`.

    Envelopes are parsed once, and one write routes every event by status and collection; rejected
    ones keep their rule and, if unreadable, their text. With `current`, the state of the collections
    (db, coll, key, document), absent documents are looked up there.
    """
    events = parse_events(raw)
    if current is not None:
        events = look_up_documents(events, current)
    status = F.when(F.col("rule").isNull(), "usable").otherwise("rejected")
    routed = classify_events(events).withColumn("status", status)
    routed = rebalanced(routed, "status", "coll")
    write_batch(with_part_date(routed, as_of), landing, batch_id, "status", "coll")


def run_feed(
    spark: SparkSession,
    source: str,
    landing: str,
    checkpoint: str,
    as_of: date,
    max_files: int | None = None,
    max_bytes: int | None = None,
    current: Callable[[SparkSession], DataFrame] | None = None,
) -> None:
    """Land every event file that arrived since the last run, then stop.

    `current` gives the state of the collections (db, coll, key, document) and is asked for every batch.
    """

    def land(df: DataFrame, batch_id: int) -> None:
        land_events(df, landing, batch_id, as_of, current(df.sparkSession) if current else None)

    stream = stream_files(
        spark, source, T.StructType.fromDDL("event string, seq bigint"),
        max_files=max_files, max_bytes=max_bytes,
    )
    query = (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_landed(spark: SparkSession, landing: str) -> DataFrame:
    """Events of all batches and collections, usable and rejected, told apart by `status`."""
    return spark.read.parquet(landing)


def collection_landing(landing: str, collection: str) -> str:
    """Path pattern of one collection's files over all batches, for a reader or a file stream."""
    return f"{landing}/batch_id=*/status=usable/coll={collection}"


def read_rejected(spark: SparkSession, landing: str) -> DataFrame:
    """Rejected events of all batches; files of usable ones are not scanned."""
    return read_landed(spark, landing).where(F.col("status") == "rejected")
