"""Projections that are evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fields_once(df: DataFrame, value: Column, keep: list[str]) -> DataFrame:
    """Kept columns and the fields of a struct `value` that is costly to compute (a parsed document).

    The optimizer moves a filter below a projection by repeating the projected expression wherever
    the filter names it; a document with forty fields checked by eighty rules would be parsed that
    often per row. A generator is not repeated: one element in, one row out, no shuffle.
    """
    return df.select(*[f"`{c}`" for c in keep], F.inline(F.array(value)))


def select_once(df: DataFrame, keep: list[str], derived: dict[str, Column]) -> DataFrame:
    """Kept and derived columns, every derivation computed once however often it is used later."""
    return fields_once(df, F.struct(*[c.alias(name) for name, c in derived.items()]), keep)
