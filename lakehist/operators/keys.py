"""The key contract of a full snapshot: every key is present and occurs once.

The merges rest on it. A NULL key never matches, so it would be closed and inserted again by every run;
a key that occurs twice has no single newest row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehist.functions.changes import columns, quoted


class KeyContractError(ValueError):
    """A snapshot holds NULL or repeated keys."""


def has_null_key(keys: Sequence[str]) -> Column:
    return reduce(or_, [key.isNull() for key in columns(keys)])


def keys_equal(left: str, right: str, keys: Sequence[str]) -> Column:
    return F.expr(" AND ".join(f"{quoted(k, left)} = {quoted(k, right)}" for k in keys))


def key_violations(df: DataFrame, keys: Sequence[str], allow_null: bool = False) -> DataFrame:
    """Keys that break the contract, with the number of rows holding each.

    Only the key columns are read, and rows are counted before the shuffle, so a key that holds a large
    share of the snapshot arrives as one partial count per task.
    """
    if allow_null:
        df = df.where(~has_null_key(keys))
    counted = df.groupBy(*columns(keys)).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where((F.col("n_rows") > 1) | has_null_key(keys))


def validate_keys(df: DataFrame, keys: Sequence[str], allow_null: bool = False) -> None:
    """Raise :class:`KeyContractError` if the contract is broken. One job, one row back to the driver."""
    found = key_violations(df, keys, allow_null).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.max("n_rows").alias("n_rows"),
        F.max_by(F.struct(*columns(keys)), "n_rows").alias("worst"),
    ).first()
    if found.n_keys:
        raise KeyContractError(
            f"keys {list(keys)} must be non-null and unique: {found.n_keys} are not, "
            f"the worst being {found.worst.asDict()} on {found.n_rows} rows"
        )
