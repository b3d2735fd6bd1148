"""Join helpers for skew that adaptive execution cannot see in advance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_lookup(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread_by: list[str]
) -> DataFrame:
    """Left outer equi-join whose left key may be NULL in any share of the rows.

    A left join must keep rows with a NULL key and would hash all of them to one partition. A second
    join key, 0 for real keys and an odd hash of `spread_by` for NULL keys, spreads them over all
    partitions; they match nothing either way. No hint is set: the planner broadcasts `right` if its size allows.
    """
    spread = F.xxhash64(*spread_by).bitwiseOR(F.lit(1).cast("long"))
    keyed = left.withColumn("_spread", F.when(F.col(left_key).isNull(), spread).otherwise(0))
    # Always 0, but not a literal: that would be folded into a filter and leave a one-column key.
    zero = F.pmod(F.xxhash64(right_key), F.lit(1))
    lookup = right.withColumn("_spread_of_real_keys", zero)
    condition = (F.col(left_key) == F.col(right_key)) & (
        F.col("_spread") == F.col("_spread_of_real_keys")
    )
    return keyed.join(lookup, condition, "left").drop("_spread", "_spread_of_real_keys")
