"""Append rule-derived attributes to a pruned projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from lakehist.functions.changes import columns


def enrich(df: DataFrame, keep: Sequence[str], attributes: Mapping[str, Column]) -> DataFrame:
    """Keep the listed columns and append every attribute, in one projection."""
    return df.select(*columns(keep), *[rule.alias(name) for name, rule in attributes.items()])
