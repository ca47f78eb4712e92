"""Top and bottom reports.

Each half is a filter, a sort and a limit, which Spark plans as a bounded heap per task followed by one
merge of ``k`` rows per task: no global sort and no shuffle of the table. The keys break ties, so the
rows at the cut are always the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehist.functions.changes import columns, quoted


@dataclass(frozen=True)
class Ranking:
    """A report over the rows where ``active`` is true, ordered by ``metric`` and then ``keys``."""

    metric: str
    keys: tuple[str, ...]
    active: str
    columns: tuple[str, ...]
    label_column: str
    top_label: str
    bottom_label: str
    stamp_column: str
    k: int = 10


def _half(df: DataFrame, spec: Ranking, order: Column, label: str, stamp: Column) -> DataFrame:
    ties = [key.asc() for key in columns(spec.keys)]
    ranked = df.where(F.col(quoted(spec.active))).orderBy(order, *ties).limit(spec.k)
    return ranked.select(*columns(spec.columns), F.lit(label).alias(spec.label_column), stamp.alias(spec.stamp_column))


def top(df: DataFrame, spec: Ranking, stamp: Column) -> DataFrame:
    """The ``k`` largest; NULL metrics come last."""
    return _half(df, spec, F.col(quoted(spec.metric)).desc_nulls_last(), spec.top_label, stamp)


def bottom(df: DataFrame, spec: Ranking, stamp: Column, skip_null: bool = False) -> DataFrame:
    """The ``k`` smallest; NULL metrics come first unless ``skip_null`` leaves them out."""
    if skip_null:
        df = df.where(F.col(quoted(spec.metric)).isNotNull())
    return _half(df, spec, F.col(quoted(spec.metric)).asc_nulls_first(), spec.bottom_label, stamp)


def top_bottom(df: DataFrame, spec: Ranking, stamp: Column, skip_null: bool = False) -> DataFrame:
    """Both halves as one bag. With fewer than ``2k`` active rows a key may appear in both."""
    return top(df, spec, stamp).unionByName(bottom(df, spec, stamp, skip_null))
