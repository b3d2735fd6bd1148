"""Column profiles that add up: a day's or a batch's profile is stored, a week's is merged from them.

Counts merge exactly. Distinct values are HyperLogLog sketches, numbers also quantile sketches; both merge without
the rows and estimate within a stated error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.scalars import is_blank

#: 2**LOG_REGISTERS registers: a standard error of about 1.04 / 64, 1.6 % of the number of distinct values.
LOG_REGISTERS = 12
#: Size of a quantile sketch: ranks within about 0.8 %.
QUANTILE_SIZE = 200
#: Ranks that a merged profile tells.
RANKS = (0.25, 0.5, 0.75)

PROFILE = (
    "column_name string, n_rows bigint, n_missing bigint, least string, greatest string, distinct binary, "
    "quantiles binary"
)


def column_profiles(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None, match: str = "contains") -> DataFrame:
    """A row per column (and per value of `by`): rows, missing values as in `null_profile`, extremes, sketches.

    One scan and one aggregate; each task sends one row per value of `by`. Extremes are of the values as text, of
    numbers by their size. `quantiles` is NULL for columns that aren't numbers; a column without values has empty
    sketches. Arrays, maps and structs have no profile.
    """
    by = by or []
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = [c for c in (columns or df.columns) if c not in by and isinstance(kinds[c], T.AtomicType)]

    def profile(name: str) -> Column:
        value, number = F.col(f"`{name}`"), isinstance(kinds[name], T.NumericType)
        quantiles = F.kll_sketch_agg_double(value.cast("double"), QUANTILE_SIZE) if number else F.lit(None)
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(is_blank(name, kinds[name], match)).alias("n_missing"),
            F.min(value).cast("string").alias("least"),
            F.max(value).cast("string").alias("greatest"),
            F.hll_sketch_agg(value.cast("string"), LOG_REGISTERS).alias("distinct"),
            quantiles.cast("binary").alias("quantiles"),
        )

    rows = df.groupBy(*[f"`{c}`" for c in by]).agg(F.array(*map(profile, names)).alias("_profiles"))
    return rows.select(*[f"`{c}`" for c in by], F.explode("_profiles").alias("p")).select(*[f"`{c}`" for c in by], "p.*")


def merged_profiles(profiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Profiles of the same columns put together, one per column (and per value of `by`)."""
    keys = [*(by or []), "column_name"]
    number = F.count_if(F.col("quantiles").isNotNull()) > 0
    # Extremes are text: numbers compare as numbers where all of a column's are.
    def extreme(name: str, pick) -> Column:
        as_number = pick(F.struct(F.col(name).try_cast("double").alias("n"), F.col(name).alias("t")))["t"]
        return F.when(number, as_number).otherwise(pick(F.col(name))).alias(name)

    def known(name: str, pick) -> Column:
        return extreme(name, lambda c: pick(F.when(F.col(name).isNotNull(), c)))

    return profiles.groupBy(*keys).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_missing").alias("n_missing"),
        known("least", F.min),
        known("greatest", F.max),
        F.hll_union_agg("distinct").alias("distinct"),
        F.when(number, F.kll_merge_agg_double("quantiles", QUANTILE_SIZE)).alias("quantiles"),
    )


def readable_profiles(profiles: DataFrame) -> DataFrame:
    """The profile with estimates in place of sketches: `n_distinct`, and `q25`, `q50`, `q75` of numbers."""
    found = [
        F.when(F.kll_sketch_get_n_double("quantiles") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(rank)))
        for rank in RANKS
    ]
    return profiles.withColumn("n_distinct", F.hll_sketch_estimate("distinct")).withColumns(
        {f"q{round(100 * rank)}": q for rank, q in zip(RANKS, found)}
    ).drop("distinct", "quantiles")
