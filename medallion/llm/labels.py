"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.common import fold

#: Most labelled rows that a classifier of this folder is fitted on.
TRAIN_ROWS = 20_000


def training_sample(
    labels: DataFrame, label: str, folds: int, held_out: int, rows: int = TRAIN_ROWS
) -> DataFrame:
    """At most `rows` rows (doc_id, label) of the folds that aren't held out, broadcast by that bound.

    The choice follows a hash of the id, so it is the same in every run. Rows without id or label are
    left out; of several labels of an id the largest counts.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.where(fold(F.col("doc_id"), folds) != held_out)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))


def held_out_column(folds: int, held_out: int):
    """Whether a row's fold is the one held out; false without id."""
    return F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out")
