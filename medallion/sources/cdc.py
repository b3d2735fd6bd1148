"""Change feed of a document store: envelope, post-images, routing.

An event is a JSON text with the store's envelope. Inserts and replaces carry the whole document;
an update may carry only the changed fields, then the current document is looked up by key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.joins import left_lookup
from medallion.operators.projection import fields_once
from medallion.operators.upsert import latest

_TEXT = T.StringType()
_BROKEN = "_corrupt_record"

# Names inside the envelope, and the operations that yield a document.
ENVELOPE = (
    T.StructType()
    .add("operationType", _TEXT)
    .add("ns", T.StructType().add("db", _TEXT).add("coll", _TEXT))
    .add("documentKey", T.StructType().add("_id", _TEXT))
    .add("fullDocument", _TEXT)
    .add(_BROKEN, _TEXT)
)
APPLIED_OPERATIONS = ("insert", "update", "replace")

# Columns of a parsed event.
EVENT_COLUMNS = ("op", "db", "coll", "key", "document", "seq")


class Feed(NamedTuple):
    events: DataFrame
    errors: DataFrame


def parse_events(df: DataFrame, event: str = "event", seq: str = "seq") -> DataFrame:
    """Envelope to columns (op, db, coll, key, document, seq); the document stays JSON text.

    `broken` holds the raw text of an envelope that cannot be read.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    envelopes = fields_once(df, F.from_json(F.col(event), ENVELOPE, options), [seq])
    return envelopes.select(
        F.col("operationType").alias("op"),
        F.col("ns.db").alias("db"),
        F.col("ns.coll").alias("coll"),
        F.col("documentKey._id").alias("key"),
        F.col("fullDocument").alias("document"),
        F.col(seq).alias("seq"),
        F.col(_BROKEN).alias("broken"),
    )


def current_documents(collection: DataFrame, db: Column, coll: Column, key: str, document: str) -> DataFrame:
    """The state of one or more collections as (db, coll, key, document), for `look_up_documents`."""
    return collection.select(
        db.alias("db"), coll.alias("coll"), F.col(key).cast("string").alias("key"), F.col(document).alias("document")
    )


def _place() -> Column:
    """Where a document is kept; NULL if any part of that is unknown."""
    parts = ("db", "coll", "key")
    known = reduce(and_, [F.col(c).isNotNull() for c in parts])
    return F.when(known, F.struct(*parts))


def look_up_documents(events: DataFrame, current: DataFrame) -> DataFrame:
    """Fill missing documents of events from the current state of their own collection.

    `current` has (db, coll, key, document), each place once. One left join instead of one lookup per event, and
    every event stays one row: those that have a document, need none or say no key meet nothing and are
    spread over all partitions.
    """
    wanted = F.col("document").isNull() & F.col("op").isin(*APPLIED_OPERATIONS)
    asking = events.withColumn("_wanted", F.when(wanted, _place()))
    state = current.select(_place().alias("_place"), F.col("document").alias("_document"))
    found = left_lookup(asking, state.where(F.col("_place").isNotNull()), "_wanted", "_place", ["seq", "key"])
    return found.withColumn("document", F.coalesce("document", "_document")).select(*events.columns)


def classify_events(events: DataFrame) -> DataFrame:
    """Events with a `rule` that says why one cannot be applied, NULL for those that can.

    Deletes are not applied (`unsupported_op`); an event whose document is gone is
    `missing_document`; an envelope that cannot be read is `corrupt`.
    """
    unreadable = F.col("broken").isNotNull() | F.col("op").isNull() | F.col("coll").isNull()
    rule = (
        F.when(unreadable, "corrupt")
        .when(~F.col("op").isin(*APPLIED_OPERATIONS), "unsupported_op")
        .when(F.col("document").isNull(), "missing_document")
    )
    return events.withColumn("rule", rule).select(*EVENT_COLUMNS, "broken", "rule")


def split_events(events: DataFrame) -> Feed:
    """Events with a document to apply, and the others as error records with their rule."""
    ruled = classify_events(events)
    return Feed(
        ruled.where(F.col("rule").isNull()).select(*EVENT_COLUMNS),
        ruled.where(F.col("rule").isNotNull()),
    )


def post_images(events: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The newest image per key."""
    return latest(events, keys, seq)


def of_collection(events: DataFrame, collection: str) -> DataFrame:
    return events.where(F.col("coll") == collection)
