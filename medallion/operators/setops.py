"""Set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def except_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """EXCEPT DISTINCT: distinct rows of `left` that are not in `right`; NULLs are equal, by position.

    One aggregate instead of an anti join followed by a distinct: copies of a row collapse in every
    task before the only shuffle, so a row that makes up a third of the table costs no more than any
    other.
    """
    if len(left.columns) != len(right.columns):
        raise ValueError(f"{len(left.columns)} columns against {len(right.columns)}")
    names = [f"_c{i}" for i in range(len(left.columns))]
    both = (
        left.toDF(*names)
        .withColumn("_right", F.lit(0))
        .union(right.toDF(*names).withColumn("_right", F.lit(1)))
    )
    kept = both.groupBy(*names).agg(F.max("_right").alias("_right")).where("_right = 0")
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, left.columns)])


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; a column one side lacks is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
