"""Type 1 upsert: the last write per key wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _seq(columns: list[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def latest(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """The newest version of every key.

    An aggregate, not a window: each task reduces a key to one row before the shuffle, so a key with
    a third of all versions reaches its reducer as one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    # Versions that tie in `seq` are ordered by a hash of the row, so no result depends on chance.
    order = F.struct(_seq(seq), F.xxhash64(*rest))
    newest = df.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    picked = {**{k: F.col(f"`{k}`") for k in keys}, **{c: F.col(f"_row.`{c}`") for c in rest}}
    return newest.select(*[picked[c].alias(c) for c in df.columns])


def upsert_by_union(
    target: DataFrame, updates: DataFrame, keys: list[str], seq: list[str]
) -> DataFrame:
    """Target and updates together, newest version per key. Shuffles both; needs nothing unique.

    At the same `seq` an update goes before the target's row, as in the other forms.
    """
    side = "_is_update"
    both = target.withColumn(side, F.lit(0)).unionByName(
        updates.select(*target.columns).withColumn(side, F.lit(1))
    )
    return latest(both, keys, [*seq, side]).drop(side)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Target with updates applied; `target` holds one row per key, updates may repeat keys.

    An update older than the target's row is ignored; one of the same age replaces it. Keys are
    never NULL. Target rows that no update replaces pass through an anti join against the updates'
    keys and order alone, so while those are below the broadcast threshold the target is not
    shuffled; the second look at the target reads its keys and order columns only.
    """
    updates = latest(updates.select(*target.columns), keys, seq)
    stamps = updates.select(
        *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)],
        _seq(seq).alias("_update_seq"),
    )
    same_key = reduce(
        lambda a, b: a & b, (F.col(f"`{k}`") == F.col(f"_k{i}") for i, k in enumerate(keys))
    )
    kept = target.join(stamps, same_key & (F.col("_update_seq") >= _seq(seq)), "left_anti")
    newer_in_target = (
        target.select(*dict.fromkeys([*keys, *seq]))
        .join(stamps, same_key & (F.col("_update_seq") < _seq(seq)), "left_semi")
        .select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
    )
    return kept.unionByName(updates.join(newer_in_target, same_key, "left_anti"))


def upsert_by_full_join(
    target: DataFrame, updates: DataFrame, keys: list[str], seq: list[str]
) -> DataFrame:
    """As `upsert`, by one full outer join: each side is read once.

    With a target bucketed by the keys only the updates are shuffled, whatever their size.
    """
    names = target.columns
    updates = latest(updates.select(*names), keys, seq)
    old = target.select(F.struct(*[f"`{c}`" for c in names]).alias("_old"), *[f"`{k}`" for k in keys])
    new = updates.select(F.struct(*[f"`{c}`" for c in names]).alias("_new"), *[f"`{k}`" for k in keys])
    old_seq = F.struct(*[F.col(f"_old.`{c}`") for c in seq])
    new_seq = F.struct(*[F.col(f"_new.`{c}`") for c in seq])
    wins = F.col("_new").isNotNull() & (F.col("_old").isNull() | (new_seq >= old_seq))
    return old.join(new, keys, "full_outer").select(
        *[F.when(wins, F.col(f"_new.`{c}`")).otherwise(F.col(f"_old.`{c}`")).alias(c) for c in names]
    )


def merge_condition(keys: list[str], target: str = "target", source: str = "updates") -> Column:
    """Equality on every key, for any number of keys."""
    return reduce(
        lambda a, b: a & b, (F.col(f"{target}.`{k}`") == F.col(f"{source}.`{k}`") for k in keys)
    )


def merge_into_table(
    updates: DataFrame, table: str, keys: list[str], seq: list[str]
) -> None:
    """The same upsert on a catalog table whose format supports MERGE (Parquet tables do not).

    Updates are reduced to one row per key first: a merge with two source rows for a key fails. An
    update older than the target's row is ignored.
    """
    not_older = F.struct(*[F.col(f"updates.`{c}`") for c in seq]) >= F.struct(
        *[F.col(f"{table}.`{c}`") for c in seq]
    )
    (
        latest(updates, keys, seq)
        .alias("updates")
        .mergeInto(table, merge_condition(keys, table))
        .whenMatched(not_older)
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
