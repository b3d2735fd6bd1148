"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.header import document_header_report
from medallion.operators.keys import key_violations, split_by_key
from medallion.operators.nested import flatten, sanitize_names
from medallion.operators.profiles import column_profiles, merged_profiles
from medallion.operators.quality import (
    error_records,
    error_report,
    fill_nulls,
    good_rows,
    null_profile,
    quality_counts,
)
from medallion.operators.rules import Rule, rules_for
from medallion.operators.setops import except_distinct, union_all
from medallion.operators.standardize import conform, standardize_dates
from medallion.operators.upsert import latest, upsert, upsert_by_full_join, upsert_by_union
from medallion.plans import gold
from medallion.plans.initial import Layers, ingest_all, load_silver, register_layers
from medallion.plans.refresh import MaintainedFact
from medallion.plans.together import FACT_KEYS, StoredTogether, build_together
from medallion.queries.derived import (
    SilverTables,
    change_events,
    dictionary,
    dirty_events,
    dirty_orders,
    event_collection,
    event_documents,
    nested_lines,
    order_documents,
    SOURCE_TABLES,
    changed_rows,
    sources_after,
    sources_before,
    shared_key_collections,
    shared_key_events,
    table,
)
from medallion.session import workspace
from medallion.sinks.catalog import create_database, register_gold
from medallion.sinks.writers import append_landing, remove_directory, write_errors, write_full
from medallion.sources.cdc import look_up_documents, of_collection, parse_events, post_images, split_events
from medallion.sources.documents import parse_documents, split_corrupt
from medallion.sources.readers import read_day, read_silver, read_source, read_table
from medallion.streaming.changelog import ChangeLog
from medallion.streaming.feed import read_landed, run_feed
from medallion.streaming.incremental import IncrementalLoad
from medallion.streaming.newest import run_newest_feed

Query = Callable[[SparkSession, str], DataFrame]

DAY_1 = date(2024, 3, 1)
DAY_2 = date(2024, 3, 2)
EVENT_KEYS = ["user_id", "event_type"]
EVENT_SEQ = ["ts", "event_id"]


# --- data quality -------------------------------------------------------------------------------


def _order_rules(df: DataFrame, kind: str | None = None) -> list[Rule]:
    rules = rules_for(df, dictionary(), "orders")
    return [r for r in rules if kind is None or r.rule == kind]


def q_null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(dirty_orders(spark, sf_dir), dictionary().not_null("orders"))


def _violations(kind: str | None, spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty_orders(spark, sf_dir)
    return error_records(df, _order_rules(df, kind)).select(
        "o_orderkey", "rule", "column_name", "bad_value", "error_desc"
    )


def q_quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty_orders(spark, sf_dir)
    return error_records(df, _order_rules(df)).drop("rule", "column_name", "bad_value")


def q_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty_orders(spark, sf_dir)
    return good_rows(df, _order_rules(df))


def q_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(q_good_rows(spark, sf_dir), dictionary(), "orders")


def q_quality_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty_orders(spark, sf_dir)
    return quality_counts(df, _order_rules(df))


def q_error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty_orders(spark, sf_dir)
    return error_report(error_records(df, _order_rules(df)), "orders", ["o_orderkey"])


def q_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return fill_nulls(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.when(key % 3 != 0, F.col("o_custkey")).alias("o_custkey"),
            F.when(key % 4 != 0, F.col("o_totalprice")).alias("o_totalprice"),
            F.when(key % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        )
    )


def _dates(render: bool, spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dirty_orders(spark, sf_dir).select("o_orderkey", "o_orderdate")
    return standardize_dates(df, dictionary().dates("orders"), render)


def q_header_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_header_report(
        order_documents(spark, sf_dir), F.col("document"), dictionary(), "orders"
    )


# --- nested data and documents ------------------------------------------------------------------


def q_flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(nested_lines(spark, sf_dir))


def q_flatten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(table(spark, sf_dir, "embeddings"))


def q_flatten_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(
        table(spark, sf_dir, "part").select(
            "p_partkey",
            F.split("p_name", " ").alias("words"),
            F.array("p_size", F.col("p_size") + 1).alias("sizes"),
        )
    )


def q_sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize_names(
        table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("p.key"),
            F.col("p_name").alias("p@name"),
            F.col("p_size").alias("p/size:cm"),
            F.col("p_type").alias("p(type)!"),
        )
    )


def q_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = table(spark, sf_dir, "events").select("event_id", "props")
    return split_corrupt(parse_documents(props, "props", dictionary().schema("props"))).rows


def _event_rows(spark: SparkSession, sf_dir: str):
    return split_corrupt(
        parse_documents(event_documents(spark, sf_dir), "document", dictionary().schema("events"))
    )


def q_typed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(_event_rows(spark, sf_dir).rows, dictionary(), "events")


def q_json_corrupt_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_rows(spark, sf_dir).corrupt.select("source_id", "rule", "bad_value")


# --- change feed --------------------------------------------------------------------------------


def q_cdc_post_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest image per key from the feed alone; events without a document are set aside."""
    feed = split_events(parse_events(change_events(spark, sf_dir)))
    documents = parse_documents(feed.events.select("document"), "document", dictionary().schema("events"))
    rows = conform(split_corrupt(documents).rows, dictionary(), "events")
    return post_images(rows, EVENT_KEYS, EVENT_SEQ)


def q_cdc_lookup_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of all usable events, absent ones looked up in the collection by key."""
    events = look_up_documents(parse_events(change_events(spark, sf_dir)), event_collection(spark, sf_dir))
    documents = split_events(events).events.select("op", "coll", "key", "document")
    parsed = parse_documents(documents, "document", dictionary().schema("events"))
    rows = conform(split_corrupt(parsed).rows, dictionary(), "events")
    return rows.select("op", "coll", "key", "event_id", "ts", "user_id", "value")


def q_cdc_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = look_up_documents(parse_events(change_events(spark, sf_dir)), event_collection(spark, sf_dir))
    return split_events(events).errors.select("seq", "op", "key", "rule")


def q_cdc_lookup_shared_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose keys repeat and occur in several collections: each with the document of its own one."""
    events = parse_events(shared_key_events(spark, sf_dir))
    feed = split_events(look_up_documents(events, shared_key_collections(spark, sf_dir)))
    document_id = F.get_json_object("document", "$.event_id").cast("long").alias("document_id")
    usable = feed.events.select("seq", "coll", "key", document_id, F.lit(None).cast("string").alias("rule"))
    return union_all(usable, feed.errors.select("seq", "coll", "key", document_id, "rule"))


def q_cdc_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = split_events(parse_events(change_events(spark, sf_dir))).events
    return of_collection(events, "click").select("seq", "op", "db", "key")


def q_cdc_feed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed files to landing directories by a stream that looks documents up; every event read back."""
    root = workspace(spark, "feed")
    change_events(spark, sf_dir).write.parquet(f"{root}/source")
    run_feed(
        spark, f"{root}/source", f"{root}/landing", f"{root}/checkpoint", DAY_1,
        current=lambda session: event_collection(session, sf_dir),
    )
    return read_landed(spark, f"{root}/landing").select("coll", "op", "key", "seq", "rule")


# --- upsert and streaming -----------------------------------------------------------------------


def _target_and_updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """State of the even events, and the odd ones as updates: newer and older ones mixed."""
    events = table(spark, sf_dir, "events")
    even = F.col("event_id") % 2 == 0
    return latest(events.where(even), EVENT_KEYS, EVENT_SEQ), events.where(~even)


def q_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(table(spark, sf_dir, "events"), EVENT_KEYS, EVENT_SEQ)


def q_upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_target_and_updates(spark, sf_dir), EVENT_KEYS, EVENT_SEQ)


def q_upsert_by_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_by_union(*_target_and_updates(spark, sf_dir), EVENT_KEYS, EVENT_SEQ)


def q_upsert_by_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_by_full_join(*_target_and_updates(spark, sf_dir), EVENT_KEYS, EVENT_SEQ)


def q_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot bucketed by key, two logged batches, compaction, then a third batch on top."""
    target, updates = _target_and_updates(spark, sf_dir)
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    log = ChangeLog(
        spark, workspace(spark, "bucketed"), target.schema, EVENT_KEYS, EVENT_SEQ, buckets
    )
    log.seed(target)
    for batch_id in (0, 1):
        log.append(updates.where(F.col("event_id") % 3 == batch_id), batch_id)
    log.compact()
    log.append(updates.where(F.col("event_id") % 3 == 2), 2)
    return log.current()


LANDED_EVENTS = (
    T.StructType()
    .add("event_id", T.LongType())
    .add("ts", T.TimestampNTZType())
    .add("user_id", T.LongType())
    .add("event_type", T.StringType())
    .add("value", T.StringType())
    .add("props", T.StringType())
)


def _landed_in_two_runs(spark: SparkSession, sf_dir: str) -> IncrementalLoad:
    """Two arrivals, each followed by a run; the second brings older versions as well as newer."""
    root = workspace(spark, "incremental")
    load = IncrementalLoad(
        spark, dictionary(), "events", f"{root}/landing", root, EVENT_SEQ, DAY_1, LANDED_EVENTS
    )
    events = dirty_events(spark, sf_dir)
    for arrival in (0, 1):
        events.where(F.col("event_id") % 2 == arrival).write.mode("append").parquet(load.landing)
        load.run()
    return load


def q_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed_in_two_runs(spark, sf_dir).current()


def q_stream_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = _landed_in_two_runs(spark, sf_dir)
    return load.errors().select("event_id", "rule", "column_name", "bad_value", "part_date")


def q_stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze copy: everything that arrived, good or bad, under its batch."""
    load = _landed_in_two_runs(spark, sf_dir)
    return spark.read.parquet(f"{load.root}/bronze").select("event_id", "value", "part_date", "batch_id")


def q_stream_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `upsert_stream`, with a run that finds nothing, a batch delivered twice, and a compaction."""
    load = _landed_in_two_runs(spark, sf_dir)
    load.run()
    again = spark.read.schema(LANDED_EVENTS).parquet(load.landing).where("event_id % 2 = 0")
    load.process_batch(again, 0)
    load.log.compact()
    return load.current()


def q_stream_lost_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals; before the last the checkpoint is lost, so its run is delivered every file again.

    All three sides of the load, told apart by `side`.
    """
    load = _landed_in_two_runs(spark, sf_dir)
    remove_directory(spark, f"{load.root}/checkpoint")
    late = dirty_events(spark, sf_dir).where("event_id % 10 = 0").withColumn("event_id", -F.col("event_id"))
    late.write.mode("append").parquet(load.landing)
    load.ledger.fold()
    load.run(max_files=1)
    sides = {
        "good": load.current(),
        "bronze": spark.read.parquet(f"{load.root}/bronze"),
        "error": load.errors().withColumn("value", F.col("bad_value")),
    }
    parts = [
        df.select(F.lit(side).alias("side"), "event_id", F.col("value").cast("decimal(18,2)" if side == "good" else "string").cast("string").alias("value"))
        for side, df in sides.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def q_stream_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze and error rows with their batches, two of them packed and their directories removed, one after that."""
    load = _landed_in_two_runs(spark, sf_dir)
    load.pack()
    load.vacuum()
    late = dirty_events(spark, sf_dir).where("event_id % 10 = 0").withColumn("event_id", -F.col("event_id"))
    late.write.mode("append").parquet(load.landing)
    load.run()
    sides = {"bronze": load.bronze(), "error": load.errors()}
    return reduce(
        DataFrame.unionByName,
        [df.select(F.lit(side).alias("side"), "event_id", "batch_id") for side, df in sides.items()],
    )


def q_stream_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each batch, taken while it was written."""
    return _landed_in_two_runs(spark, sf_dir).balance()


def _drifting_events(spark: SparkSession, sf_dir: str) -> IncrementalLoad:
    """Three arrivals: as declared; with a new column and one lost; with one retyped, in part beyond its type."""
    root = workspace(spark, "drift")
    load = IncrementalLoad(
        spark, dictionary(), "events", f"{root}/landing", root, EVENT_SEQ, DAY_1, LANDED_EVENTS
    )
    events, of = dirty_events(spark, sf_dir), F.col("event_id") % 3
    user = F.col("user_id").cast("string")
    odd = F.concat(F.lit("u"), user)
    arrivals = [
        events.where(of == 0),
        events.where(of == 1).drop("props").withColumn("channel", F.concat(F.lit("c"), F.col("event_id") % 4)),
        events.where(of == 2).withColumn("user_id", F.when(F.col("event_id") % 7 == 0, odd).otherwise(user)),
    ]
    for arrival in arrivals:
        arrival.write.mode("append").parquet(load.landing)
        load.run()
    return load


def q_stream_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table after files with a new, a lost and a retyped column."""
    return _drifting_events(spark, sf_dir).current()


def q_stream_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the declared columns couldn't hold, in bronze and in quarantine."""
    load = _drifting_events(spark, sf_dir)
    bronze = spark.read.parquet(f"{load.root}/bronze").where("_rescued is not null")
    bronze = bronze.select("event_id", F.lit("bronze").alias("side"), F.col("_rescued").alias("value"))
    errors = load.errors().select("event_id", F.concat_ws(":", "rule", "column_name").alias("side"), F.col("bad_value").alias("value"))
    return bronze.unionByName(errors)


def q_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines whose key, as an order and line number, is NULL in part or isn't unique."""
    order = F.when(F.col("l_partkey") % 97 != 0, F.col("l_orderkey")).alias("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(order, "l_linenumber", "l_partkey", "l_suppkey")
    return key_violations(lines, ["l_orderkey", "l_linenumber"])


def q_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines that `key_violations` leaves."""
    order = F.when(F.col("l_partkey") % 97 != 0, F.col("l_orderkey")).alias("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(order, "l_linenumber", "l_partkey", "l_suppkey")
    return split_by_key(lines, ["l_orderkey", "l_linenumber"]).good


def q_seed_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change log seeded with every version of each key, then a batch that some of them are newer than."""
    events = table(spark, sf_dir, "events")
    log = ChangeLog(spark, workspace(spark, "seeded"), events.schema, EVENT_KEYS, EVENT_SEQ)
    log.seed(events.where("event_id % 5 <> 0"))
    log.append(events.where("event_id % 5 = 0"), 0)
    return log.current()


def q_cdc_newest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose files come out of order, in three runs: the newest image per document, the rest told apart."""
    root = workspace(spark, "newest")
    events = shared_key_events(spark, sf_dir)
    for arrival in (0, 1, 2):
        events.where((F.col("seq") + 1) % 3 == arrival).write.mode("append").parquet(f"{root}/source")
        run_newest_feed(spark, f"{root}/source", f"{root}/landing", f"{root}/checkpoint", DAY_1)
    return read_landed(spark, f"{root}/landing").select("seq", F.col("coll").cast("string").alias("coll"), "key", "rule")


# --- layers -------------------------------------------------------------------------------------


def q_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "bronze")
    write_full(table(spark, sf_dir, "customer"), path, DAY_1)
    return read_table(spark, path)


def q_full_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "reload")
    orders = table(spark, sf_dir, "orders")
    write_full(orders, path, DAY_1)
    write_full(orders.where("o_orderstatus <> 'F'"), path, DAY_2)
    return read_table(spark, path)


def q_landing_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "landing")
    events = table(spark, sf_dir, "events")
    append_landing(events.where("event_id % 2 = 0"), path, DAY_1, route="event_type")
    append_landing(events.where("event_id % 2 = 1"), path, DAY_2, route="event_type")
    return read_table(spark, path)


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of a table, the second with a column more, read as one."""
    path = workspace(spark, "drift")
    orders = table(spark, sf_dir, "orders")
    append_landing(orders.where("o_orderstatus = 'F'").drop("o_orderpriority"), path, DAY_1)
    append_landing(orders.where("o_orderstatus <> 'F'"), path, DAY_2)
    return read_table(spark, path, merge_schema=True)


def q_ingest_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = Layers(workspace(spark, "ingest"))
    names = SOURCE_TABLES
    ingest_all(spark, lambda name: read_source(spark, "parquet", path=f"{sf_dir}/{name}.parquet"), names, layers, DAY_1)
    counts = [
        read_table(spark, layers.bronze(name)).groupBy("part_date").agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "part_date", "n_rows")
        for name in names
    ]
    return union_all(*counts)


def _silver_orders(spark: SparkSession, sf_dir: str) -> Layers:
    layers = Layers(workspace(spark, "silver"))
    write_full(dirty_orders(spark, sf_dir), layers.bronze("orders"), DAY_1)
    load_silver(spark, layers, dictionary(), "orders", DAY_1, strict_header=True)
    return layers


def q_silver_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _silver_orders(spark, sf_dir).silver("orders"))


def q_error_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _silver_orders(spark, sf_dir)
    df = dirty_orders(spark, sf_dir)
    write_errors(error_records(df, _order_rules(df, "not_null")), layers.errors("orders"), DAY_2)
    return read_day(spark, layers.errors("orders"), DAY_2).select("o_orderkey", "error_desc", "part_date")


# --- set operators and gold ---------------------------------------------------------------------


def q_except_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "status", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    )
    left = orders.select("o_custkey", "status")
    return except_distinct(left, orders.where("o_totalprice > 400000").select("o_custkey", "status"))


def q_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as party_key", "c_name as name", "c_mktsegment as segment"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as party_key", "s_name as name")
    return union_all(customer, supplier)


def _gold(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.build(name, SilverTables(spark, sf_dir))


def q_gold_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales written in total order of invoice and line, and read back."""
    path = workspace(spark, "ordered")
    tables = SilverTables(spark, sf_dir)
    gold.build_all(spark, tables, path, ["Sales"], total_order=True)
    return read_table(spark, f"{path}/Sales")


def q_gold_catalog_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All gold tables written, registered by directory and counted by catalog name."""
    root = workspace(spark, "gold")
    database = "gold_" + root.rsplit("-", 1)[-1].lower()
    gold.build_all(spark, SilverTables(spark, sf_dir), f"{root}/gold")
    create_database(spark, database, f"{root}/database")
    names = register_gold(spark, database, f"{root}/gold")
    counts = [
        spark.table(f"`{database}`.`{name}`").agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows")
        for name in names
    ]
    return union_all(*counts)


def _order_facts(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    clean = orders.selectExpr(
        "o_orderkey as OrderID", "o_custkey as CustomerID", "o_custkey % 7 as SalespersonPersonID",
        "case when o_orderstatus = 'F' then o_custkey % 5 end as PickedByPersonID",
        "case when o_orderkey % 5 = 0 then o_orderkey + 1 end as BackorderOrderID",
        "o_orderdate as OrderDate", "o_orderdate as LastEditedWhen",
    )
    return gold.fact_order_line(SilverTables(spark, sf_dir, Orders=clean))


def q_incremental_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even orders by a full load, odd ones, later and older versions by a stream, the order line fact by table name."""
    root, database = workspace(spark, "joined"), "medallion_joined"
    layers, orders = Layers(root), dirty_orders(spark, sf_dir)
    number = F.col("o_orderkey").cast("long")
    write_full(orders.where(number % 2 == 0), layers.bronze("orders"), DAY_1)
    load_silver(spark, layers, dictionary(), "orders", DAY_1)
    register_layers(spark, database, layers, ["orders"])

    schema = T.StructType([*orders.schema.fields, T.StructField("version", T.LongType())])
    load = IncrementalLoad(
        spark, dictionary(), "orders", f"{root}/landing", f"{root}/stream", ["version"], DAY_2, schema
    )
    load.seed(read_silver(spark, database, dictionary("orders"))["orders"])
    of_customer = F.col("o_custkey").try_cast("long").isNotNull()
    arrivals = [
        orders.where(number % 2 == 1).withColumn("version", F.lit(1)),
        orders.where(number % 3 == 0).withColumns(
            {"version": F.lit(2), "o_custkey": F.when(of_customer, "1").otherwise(F.col("o_custkey"))}
        ),
        orders.where(number % 5 == 0).withColumns(
            {"version": F.lit(0), "o_custkey": F.when(of_customer, "2").otherwise(F.col("o_custkey"))}
        ),
    ]
    for arrival in arrivals:
        typed = arrival.withColumn("version", F.col("version").cast("long"))
        typed.write.mode("append").parquet(load.landing)
        load.run()
    load.publish(database)
    return _order_facts(spark, sf_dir, read_silver(spark, database, dictionary("orders"))["orders"])


def q_profile_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of seven parts of the text orders, stored and put together."""
    orders = dirty_orders(spark, sf_dir).withColumn("part", F.pmod(F.col("o_orderkey").cast("long"), F.lit(7)))
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    path = workspace(spark, "profiles")
    column_profiles(orders, columns, by=["part"]).write.parquet(path)
    merged = merged_profiles(spark.read.parquet(path))
    return merged.select("column_name", "n_rows", "n_missing", "least", "greatest")


#: Lines beyond which a header and its lines are stored apart; far below the default, so that some are.
MANY_LINES = 6


def _stored_together(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact whose headers and lines lie in buckets of their common key."""
    tables = SilverTables(spark, sf_dir)
    buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pair = StoredTogether(spark, workspace(spark, "together"), FACT_KEYS[name], buckets, MANY_LINES)
    pair.write(tables)
    return build_together(name, tables, pair)


#: Owners in a part of a maintained fact.
OWNERS_A_PART = 5_000


def _refreshed(names: tuple[str, ...], spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact built before rows came and changed, then brought up to date."""
    before = SilverTables(spark, sf_dir, sources_before(spark, sf_dir))
    after = SilverTables(spark, sf_dir, sources_after(spark, sf_dir))
    parts = []
    for name in names:
        fact = MaintainedFact(spark, name, workspace(spark, f"fact-{name}"), OWNERS_A_PART)
        fact.build(before)
        fact.refresh(after, changed_rows(after))
        parts.append(fact.read(after))
    return reduce(DataFrame.unionByName, parts)


def q_clean_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text orders through all checks to typed rows, then the order line fact on the good ones."""
    return _order_facts(spark, sf_dir, q_typed_rows(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "null_profile": q_null_profile,
    "null_violations": partial(_violations, "not_null"),
    "type_violations": partial(_violations, "type"),
    "date_violations": partial(_violations, "date"),
    "quarantine_rows": q_quarantine_rows,
    "good_rows": q_good_rows,
    "typed_rows": q_typed_rows,
    "quality_balance": q_quality_balance,
    "error_report": q_error_report,
    "null_fill": q_null_fill,
    "standardize_dates_text": partial(_dates, True),
    "standardize_dates_typed": partial(_dates, False),
    "header_report": q_header_report,
    "flatten_nested": q_flatten_nested,
    "flatten_embeddings": q_flatten_embeddings,
    "flatten_siblings": q_flatten_siblings,
    "sanitize_names": q_sanitize_names,
    "json_parse": q_json_parse,
    "typed_documents": q_typed_documents,
    "json_corrupt_quarantine": q_json_corrupt_quarantine,
    "cdc_post_images": q_cdc_post_images,
    "cdc_lookup_images": q_cdc_lookup_images,
    "cdc_lookup_shared_keys": q_cdc_lookup_shared_keys,
    "cdc_rejected": q_cdc_rejected,
    "cdc_routed": q_cdc_routed,
    "cdc_feed_stream": q_cdc_feed_stream,
    "latest_version": q_latest,
    "upsert_batch": q_upsert_batch,
    "upsert_by_union": q_upsert_by_union,
    "upsert_by_full_join": q_upsert_by_full_join,
    "upsert_bucketed": q_upsert_bucketed,
    "upsert_stream": q_upsert_stream,
    "stream_errors": q_stream_errors,
    "stream_bronze": q_stream_bronze,
    "stream_rerun_idempotent": q_stream_rerun,
    "stream_lost_checkpoint": q_stream_lost_checkpoint,
    "stream_balance": q_stream_balance,
    "stream_packed": q_stream_packed,
    "cdc_newest_stream": q_cdc_newest_stream,
    "profile_merged": q_profile_merged,
    "together_order_line": partial(_stored_together, "Movement"),
    "together_purchase": partial(_stored_together, "Purchase"),
    "together_sales": partial(_stored_together, "Sales"),
    "stream_schema_drift": q_stream_schema_drift,
    "stream_rescued": q_stream_rescued,
    "key_violations": q_key_violations,
    "unique_keys": q_unique_keys,
    "seed_repeated_keys": q_seed_repeated_keys,
    "bronze_roundtrip": q_bronze_roundtrip,
    "full_reload_overwrite": q_full_reload,
    "landing_append": q_landing_append,
    "schema_drift": q_schema_drift,
    "ingest_all_counts": q_ingest_all_counts,
    "silver_load": q_silver_load,
    "error_day_scan": q_error_day_scan,
    "except_distinct": q_except_distinct,
    "union_all": q_union_all,
    "gold_city": partial(_gold, "Cities"),
    "gold_customer": partial(_gold, "Customer"),
    "gold_employee": partial(_gold, "Employee"),
    "gold_stock_item": partial(_gold, "StockItem"),
    "gold_supplier": partial(_gold, "Supplier"),
    "fact_stock_movement": partial(_gold, "StockMovement"),
    "fact_order_line": partial(_gold, "Movement"),
    "fact_order": partial(_gold, "Order"),
    "fact_purchase": partial(_gold, "Purchase"),
    "fact_sales": partial(_gold, "Sales"),
    "fact_transactions": partial(_gold, "Transactions"),
    "gold_ordered": q_gold_ordered,
    "gold_catalog_counts": q_gold_catalog_counts,
    "clean_order_lines": q_clean_order_lines,
    "incremental_to_gold": q_incremental_to_gold,
    "refresh_order_line": partial(_refreshed, ("Movement",)),
    "refresh_purchase": partial(_refreshed, ("Purchase",)),
    "refresh_sales": partial(_refreshed, ("Sales",)),
    "refresh_transactions": partial(_refreshed, ("CustomerTransactions", "SupplierTransactions")),
    "refresh_stock_movement": partial(_refreshed, ("StockMovement",)),
}
