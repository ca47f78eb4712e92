"""Type 1 mirror: make a target equal to its source by key, and stamp only the rows that really changed.

Unchanged rows keep their old values and their old audit stamp, changed rows are overwritten, new keys
are added, and keys the source no longer has are dropped. Dropping needs no work of its own: the join
preserves the source side only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehist.functions.changes import columns, differs_sql, quoted
from lakehist.operators.keys import has_null_key, keys_equal
from lakehist.operators.scd2 import ACTION


@dataclass(frozen=True)
class MirrorSpec:
    """Keys, the columns that decide whether a row changed, and the column that holds the audit stamp.

    Columns of the source outside ``tracked`` are still overwritten when a row changes; they just do not
    trigger a change. ``null_safe`` works as in :class:`HistorySpec`.
    """

    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    audit: str
    null_safe: bool = False

    def __post_init__(self) -> None:
        if self.audit in self.tracked:
            raise ValueError("a tracked audit stamp would make every row look changed")


def scd1_mirror(target: DataFrame, source: DataFrame, spec: MirrorSpec) -> DataFrame:
    """The next state of ``target``. ``source`` carries the new audit stamp in ``spec.audit``."""
    return _merge(target, source, spec, actions=False)


def scd1_delta(target: DataFrame, source: DataFrame, spec: MirrorSpec) -> DataFrame:
    """What :func:`scd1_mirror` does row by row: ``merge_action`` is keep, update, insert or delete.

    Deleted rows show their last target values.
    """
    return _merge(target, source, spec, actions=True)


def _merge(target: DataFrame, source: DataFrame, spec: MirrorSpec, actions: bool) -> DataFrame:
    target = target.select(*columns(source.columns))
    names = source.columns
    # Rows with a NULL key match nothing, and would all land in one shuffle partition.
    no_key = has_null_key(spec.keys)
    unmatched = [_labelled(source.where(no_key), "insert", actions)]
    if actions:
        unmatched.append(_labelled(target.where(no_key), "delete", actions))
    target, source = target.where(~no_key), source.where(~no_key)

    mirror = target.select("*", F.lit(True).alias("_mirror")).alias("mirror")
    origin = source.select("*", F.lit(True).alias("_origin")).alias("origin")
    # Rows that only the target has are dropped by the join itself, unless they are to be reported.
    pairs = mirror.join(origin, keys_equal("mirror", "origin", spec.keys), "full_outer" if actions else "right_outer")
    action = f"""CASE
        WHEN mirror._mirror IS NULL THEN 'insert'
        WHEN origin._origin IS NULL THEN 'delete'
        WHEN {differs_sql("mirror", "origin", spec.tracked, spec.null_safe)} THEN 'update'
        ELSE 'keep' END"""
    acted = pairs.select("*", F.expr(action).alias(ACTION))
    acted = acted.select("*", F.col(ACTION).isin("insert", "update").alias("_replaced"))

    out = []
    for c in names:
        mine, theirs = quoted(c, "mirror"), quoted(c, "origin")
        always = c in spec.keys and not actions
        out.append(F.expr(theirs if always else f"if(_replaced, {theirs}, {mine})").alias(c))
    result = acted.select(*out, ACTION) if actions else acted.select(*out)
    for rows in unmatched:
        result = result.unionByName(rows)
    return result


def _labelled(df: DataFrame, action: str, actions: bool) -> DataFrame:
    return df.withColumn(ACTION, F.lit(action)) if actions else df
