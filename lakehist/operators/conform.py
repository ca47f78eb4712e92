"""Rename, clean and derive columns from a declarative mapping."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform(df: DataFrame, mapping: Mapping[str, str], constants: Mapping[str, Column] | None = None) -> DataFrame:
    """One projection: ``mapping`` gives each output column its SQL expression, ``constants`` are appended."""
    columns = [F.expr(expression).alias(name) for name, expression in mapping.items()]
    columns += [value.alias(name) for name, value in (constants or {}).items()]
    return df.select(*columns)
