"""Metadata-driven bronze / silver / gold pipelines as plain Spark DataFrame operators."""

from medallion.dictionary import ColumnSpec, DataDictionary
from medallion.session import get_spark, workspace

__all__ = ["ColumnSpec", "DataDictionary", "get_spark", "workspace"]
