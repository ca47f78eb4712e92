"""What distinguishes one table from another; the layer jobs take everything else from the operators."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import BooleanType, DateType, StructField, StructType, TimestampType

from lakehist.functions import AsOf
from lakehist.operators import HistorySpec, MirrorSpec, Ranking, conform, enrich
from lakehist.operators.scd2 import CURRENT, END, START, UPDATED


@dataclass(frozen=True)
class Entity:
    """A table's schemas, keys, column mapping, business rules and report."""

    name: str
    raw: StructType
    history: HistorySpec
    silver: StructType
    mapping: Mapping[str, str]
    mirror: MirrorSpec
    gold_columns: tuple[str, ...]
    attributes: Callable[[AsOf], Mapping[str, Column]]
    ranking: Ranking

    @property
    def bronze(self) -> StructType:
        return StructType([
            *self.raw.fields,
            StructField(START, DateType(), False),
            StructField(END, DateType(), False),
            StructField(CURRENT, BooleanType(), False),
            StructField(UPDATED, TimestampType(), False),
        ])

    def conformed(self, current: DataFrame, as_of: AsOf) -> DataFrame:
        """Current raw rows, renamed and cleaned, under the run's audit stamp."""
        return conform(current, self.mapping, {self.mirror.audit: as_of.audit()})

    def enriched(self, silver: DataFrame, as_of: AsOf) -> DataFrame:
        """Mirror rows plus the business attributes as of the run's day."""
        return enrich(silver, self.gold_columns, self.attributes(as_of))
