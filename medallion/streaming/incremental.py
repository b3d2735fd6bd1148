"""Incremental load: files that landed, checked and upserted into the clean layer, run to completion."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.dictionary import DataDictionary
from medallion.operators.header import HeaderMismatch, IGNORED_COLUMNS, PARTITION_COLUMN, header_differences
from medallion.operators.quality import error_records, error_report, good_rows
from medallion.operators.rules import CORRUPT_COLUMN, document_rules, drift_rules, rules_for
from medallion.operators.standardize import conform
from medallion.sinks.batches import BatchLayer
from medallion.sinks.catalog import register_table
from medallion.sinks.writers import batch_path, child_directories, committed, with_part_date, write_batch
from medallion.sources.documents import parse_documents
from medallion.sources.drift import RESCUED_COLUMN, read_drifting
from medallion.sources.readers import arriving_files
from medallion.streaming.changelog import ChangeLog
from medallion.streaming.ledger import FileLedger
from medallion.streaming.schemas import SchemaLog

BALANCE = "batch_id bigint, n_rows bigint, n_good bigint, n_bad bigint, n_violations bigint, n_logged bigint"
_FIRST = "_first_of_row"


@dataclass
class IncrementalLoad:
    """One table's stream from its landing directory to its change log.

    `root` holds the table's bronze, error, log, ledger and checkpoint directories. Landing files hold the
    table's columns, or with `document` a JSON column to parse by the dictionary. `seq` are the
    columns that order versions of a key; columns of `seq` outside the dictionary are carried along.
    `buckets` is the change log's.

    The stream delivers names of files. Files that the ledger has are left, the others are a batch, whose number
    and directories the ledger gives: neither a lost checkpoint nor a batch that died half-way leaves a row twice.
    Files whose schema isn't `landing_schema` are read by their own (see `sources.drift`): what the declared
    columns can't hold is in bronze's `_rescued`, and a row with a declared column's value there is quarantined
    by rule `schema_drift`.
    """

    spark: SparkSession
    dictionary: DataDictionary
    table: str
    landing: str
    root: str
    seq: list[str]
    as_of: date
    landing_schema: T.StructType
    document: str | None = None
    match: str = "contains"
    strict_header: bool = False
    buckets: int | None = None
    reports: list[DataFrame] = field(default_factory=list)

    @property
    def keys(self) -> list[str]:
        return self.dictionary.primary_keys(self.table)

    @property
    def log(self) -> ChangeLog:
        clean = self.dictionary.schema(self.table, typed_dates=True)
        extra = [self.landing_schema[c] for c in self.seq if c not in clean.names]
        schema = T.StructType([*clean.fields, *extra])
        path = f"{self.root}/silver"
        return ChangeLog(self.spark, path, schema, self.keys, self.seq, self.buckets)

    @property
    def ledger(self) -> FileLedger:
        return FileLedger(self.spark, f"{self.root}/ledger")

    @property
    def schemas(self) -> SchemaLog:
        return SchemaLog(self.spark, f"{self.root}/schema", self.landing_schema)

    def seed(self, clean: DataFrame) -> None:
        """Start from the clean table of a full load, whose newest row of each key counts.

        Where that lacks columns of `seq` they are NULL: any update replaces such a row.
        """
        columns = [
            F.col(f"`{f.name}`") if f.name in clean.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.log.schema.fields
        ]
        self.log.seed(clean.select(*columns))

    def publish(self, database: str) -> None:
        """Fold the log into a new snapshot and make that the table `<database>.<table>_silver`.

        The full load registers its table under the same name, so gold plans that read by name see the updates.
        """
        self.log.compact()
        register_table(self.spark, database, f"{self.table}_silver", self.log.newest_snapshot())

    def _layer(self, name: str) -> BatchLayer:
        return BatchLayer(self.spark, f"{self.root}/{name}")

    def bronze(self) -> DataFrame:
        """Everything that arrived, good or bad, under its batch."""
        return self._layer("bronze").read()

    def errors(self) -> DataFrame:
        return self._layer("error").read()

    def pack(self) -> None:
        """Put the directories of finished batches into few, and the ledger's entries; reads stay as they are."""
        for name in ("bronze", "error"):
            self._layer(name).pack()
        self.ledger.fold()

    def vacuum(self) -> None:
        """Remove what readers that start now don't need any more."""
        for name in ("bronze", "error"):
            self._layer(name).vacuum()
        self.log.vacuum()

    def balance(self) -> DataFrame:
        """Rows of each batch: arrived, good, bad, violations, and logged (the newest of each key)."""
        found = child_directories(self.spark, f"{self.root}/balance").values()
        paths = [p for p in found if committed(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], BALANCE)
        return self.spark.read.schema(BALANCE).parquet(*paths)

    def _check_header(self, rows: DataFrame) -> None:
        missing, unexpected = header_differences(rows, self.dictionary, self.table)
        missing = [c for c in missing if c != PARTITION_COLUMN]
        unexpected = [c for c in unexpected if c not in (*self.seq, CORRUPT_COLUMN, RESCUED_COLUMN)]
        if self.strict_header and (missing or unexpected):
            raise HeaderMismatch(f"{self.table}: missing {missing}, unexpected {unexpected}")

    def process_batch(self, df: DataFrame, batch_id: int) -> None:
        """Bronze copy, checks, quarantine, upsert. Every write is the batch's own directory.

        The checks read the bronze copy, not the stream's frame: it is stored and shared, so neither
        the two writes that follow nor a lost executor go back to the landing files or to a cache.

        Rows are counted as they are written, each time in the last stage, whose tasks count once even if
        they run twice.
        """
        arrived = with_part_date(df.drop(PARTITION_COLUMN), self.as_of)
        taken, refused, one = Observation(), Observation(), F.lit(1)
        counted = arrived.observe(taken, F.count(one).alias("n"))
        write_batch(counted, f"{self.root}/bronze", batch_id)
        bronze = batch_path(f"{self.root}/bronze", batch_id)
        rows = self.spark.read.schema(arrived.schema).parquet(bronze)
        rows = rows.drop(PARTITION_COLUMN, *IGNORED_COLUMNS)
        if self.document:
            rows = parse_documents(rows, self.document, self.dictionary.schema(self.table))
        self._check_header(rows)
        rules = rules_for(rows, self.dictionary, self.table, self.match)
        rules = document_rules(rules) if self.document else rules
        if RESCUED_COLUMN in rows.columns:
            rules = drift_rules(self.landing_schema.names, RESCUED_COLUMN, rules)
        errors = error_records(rows, rules, first=_FIRST).observe(
            refused, F.count(one).alias("n"), F.count_if(_FIRST).alias("rows")
        )
        errors = with_part_date(errors.drop(CORRUPT_COLUMN, _FIRST), self.as_of)
        write_batch(errors, f"{self.root}/error", batch_id)
        good = good_rows(rows, rules).drop(CORRUPT_COLUMN, RESCUED_COLUMN)
        logged = self.log.append(conform(good, self.dictionary, self.table), batch_id)
        n, bad = taken.get["n"], refused.get
        counts = [(batch_id, n, n - bad["rows"], bad["rows"], bad["n"], logged)]
        counts = self.spark.createDataFrame(counts, BALANCE).coalesce(1)
        counts.write.mode("overwrite").parquet(batch_path(f"{self.root}/balance", batch_id))
        if not logged:
            written = self.spark.read.parquet(batch_path(f"{self.root}/error", batch_id))
            self.reports.append(error_report(written, self.table, self.keys))

    def take_files(self, files: DataFrame) -> None:
        """Process those of the files (file_path, modified) that no finished batch has taken, as the next batch.

        Their list comes to the driver, as the stream's own does; limit it by `max_files`.
        """
        fresh = [tuple(f) for f in self.ledger.fresh(files).collect()]
        if not fresh:
            return
        batch = self.ledger.next_batch()
        rows, schemas = read_drifting(self.spark, [path for path, _ in fresh], self.landing_schema)
        self.schemas.record(batch, schemas)
        self.process_batch(rows, batch)
        self.ledger.commit(batch, fresh)

    def run(self, max_files: int | None = None, max_bytes: int | None = None) -> None:
        """Process everything that has landed since the last run, then stop."""
        stream = arriving_files(self.spark, self.landing, max_files=max_files, max_bytes=max_bytes)
        query = (
            stream.writeStream.foreachBatch(lambda files, _: self.take_files(files))
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def current(self) -> DataFrame:
        """The clean table now."""
        return self.log.current().select(*self.dictionary.names(self.table))
