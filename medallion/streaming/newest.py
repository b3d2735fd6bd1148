"""The newest image of each document while a change feed streams, by keyed state.

Files of a feed can arrive out of order. For every document the state holds how new its newest landed image is; an
event that is not newer is landed too, but as rejected by rule `stale`.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from medallion.sinks.writers import child_directories, committed, rebalanced, with_part_date, write_batch
from medallion.sources.cdc import EVENT_COLUMNS, classify_events, parse_events
from medallion.sources.readers import stream_files
from medallion.streaming.feed import read_landed

STALE, UNORDERED = "stale", "unordered"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Groups that documents are dealt to. A checkpoint keeps the number it began with.
GROUPS = 1024

IMAGE = "op string, db string, coll string, key string, document string, seq bigint, broken string, rule string"
_COLUMNS = [field.split()[0] for field in IMAGE.split(", ")]
# No underscore before: the frames a processor gets have no such names.
_PLACE, _GROUP = "place", "group"


class KeepNewest(StatefulProcessor):
    """Lets one event of a document through per batch: the newest, if it is newer than all before.

    The others get the rule `stale`. Events that have a rule already pass as they are. A group's events are looked at
    frame by frame, so memory holds one event of each of its documents besides the frame in hand; the state has an
    entry for each document, and those of a batch's documents are read and written.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._newest = handle.getMapState("newest_of", "place string", "seq bigint")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for place, seq in zip(initialState[_PLACE], initialState["newest"]):
            self._newest.updateValue((place,), (int(seq),))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for frame in rows:
            frame = frame[[*_COLUMNS, _PLACE]].astype({"seq": "Int64"})
            ruled = frame["rule"].notna()
            if ruled.any():
                yield frame.loc[ruled, _COLUMNS]
            # Of events as new as each other the one with the greater document counts, in every order of arrival.
            frame = frame[~ruled] if best is None else pd.concat([best, frame[~ruled]])
            frame = frame.sort_values([_PLACE, "seq", "document"], kind="stable", ignore_index=True)
            older = frame.duplicated(_PLACE, keep="last")
            best = frame[~older]
            if older.any():
                yield frame.loc[older, _COLUMNS].assign(rule=STALE)
        if best is not None and len(best):
            newer = [self._is_newer(place, int(seq)) for place, seq in zip(best[_PLACE], best["seq"])]
            yield best[_COLUMNS].assign(rule=[None if new else STALE for new in newer])

    def _is_newer(self, place: str, seq: int) -> bool:
        known = self._newest.getValue((place,))
        if known is not None and seq <= known[0]:
            return False
        self._newest.updateValue((place,), (seq,))
        return True

    def close(self) -> None:
        pass


def _place() -> Column:
    """The document an event is of."""
    return F.to_json(F.struct("db", "coll", "key")).alias(_PLACE)


def _group(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(GROUPS)).cast("int").alias(_GROUP)


def newest_images(events: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Classified events of a stream, those that are not the newest of their document with rule `stale`.

    An event without `seq` can't be ordered and gets the rule `unordered`, one without document key too. `known` is
    the state to start from if the query has none yet: (place, newest).
    """
    orderless = F.col("seq").isNull() | F.col("key").isNull()
    rule = F.coalesce("rule", F.when(orderless, F.lit(UNORDERED))).alias("rule")
    rows = events.select(*EVENT_COLUMNS, "broken", rule)
    # Events that can't be applied have no document to meet at; they are spread.
    rows = rows.select("*", F.when(F.col("rule").isNull(), _place()).alias(_PLACE))
    group = F.when(F.col("rule").isNull(), _group(_PLACE)).otherwise(_group("seq", "broken", "key")).alias(_GROUP)
    return rows.select("*", group).groupBy(_GROUP).transformWithStateInPandas(
        statefulProcessor=KeepNewest(),
        outputStructType=IMAGE,
        outputMode="Append",
        timeMode="None",
        initialState=None if known is None else known.select("*", _group(_PLACE)).groupBy(_GROUP),
    )


def landed_state(spark: SparkSession, landing: str) -> DataFrame:
    """(place, newest) of every document landed."""
    if not child_directories(spark, landing):
        return spark.createDataFrame([], f"{_PLACE} string, newest bigint")
    usable = read_landed(spark, landing).where("status = 'usable'")
    # Directory names turn into columns of whatever type they look like.
    usable = usable.withColumn("coll", F.col("coll").cast("string"))
    return usable.groupBy(_place()).agg(F.max("seq").alias("newest"))


def _first_number(spark: SparkSession, landing: str, checkpoint: str) -> int:
    """The number of a query's batch 0: after all that have landed, so a new checkpoint overwrites none of them."""
    path = f"{checkpoint}-first"
    if child_directories(spark, checkpoint) and committed(spark, path):
        return spark.read.schema("first bigint").parquet(path).first()[0]
    landed = [int(n.split("=")[1]) for n in child_directories(spark, landing) if n.startswith("batch_id=")]
    first = max(landed, default=-1) + 1
    frame = spark.createDataFrame([(first,)], "first bigint").coalesce(1)
    frame.write.mode("overwrite").parquet(path)
    return first


def run_newest_feed(
    spark: SparkSession,
    source: str,
    landing: str,
    checkpoint: str,
    as_of: date,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> None:
    """Land every event file that arrived since the last run, the newest image per document as usable; then stop.

    State is kept in RocksDB with the checkpoint. A checkpoint that is lost is made good by what has landed: the
    state starts from there, events delivered again are stale, and batches get new numbers. So is one that was made
    while each document was a group of its own, once it is removed. All events of a document meet in one task, which
    streams them; the state is one number per document.
    """
    raw = stream_files(
        spark, source, T.StructType.fromDDL("event string, seq bigint"), max_files=max_files, max_bytes=max_bytes
    )
    known = landed_state(spark, landing)
    events = newest_images(classify_events(parse_events(raw)), known)
    first = _first_number(spark, landing, checkpoint)

    def land(df: DataFrame, batch_id: int) -> None:
        status = F.when(F.col("rule").isNull(), "usable").otherwise("rejected")
        routed = rebalanced(df.withColumn("status", status), "status", "coll")
        write_batch(with_part_date(routed, as_of), landing, first + batch_id, "status", "coll")

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, STATE_STORE)
    try:
        query = (
            events.writeStream.foreachBatch(land)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.set(provider, before)
