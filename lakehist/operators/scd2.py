"""Type 2 history: full snapshots in, validity intervals ``[start_date, end_date)`` out, in one join.

A snapshot is compared with the *current* version of each key:

==================  ========================================================
key is              rows emitted
==================  ========================================================
in both, same       the current version, untouched
in both, different  the current version closed, and the snapshot row opened
only in snapshot    the snapshot row opened (new key, or one that came back)
only in current     the current version closed
==================  ========================================================

Closed versions never enter the join, so the cost of a batch depends on the number of live keys and not on
how much history has piled up. A snapshot is the full truth: keys missing from it are closed, so an empty
or partial one closes everything it lacks. Keys must be unique on both sides (see
:func:`lakehist.operators.validate_keys`). Two changes on one day leave a version of zero length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehist.functions.changes import columns, differs, differs_sql, quoted
from lakehist.functions.clock import AsOf, open_end
from lakehist.operators.keys import has_null_key, keys_equal

START, END, CURRENT, UPDATED = "start_date", "end_date", "current_flag", "updated_at"
HISTORY_COLUMNS = (START, END, CURRENT, UPDATED)
ACTION = "merge_action"

# What happens to a pair of rows. Closing actions come last, see scd2_delta.
ACTIONS = ("keep", "insert", "close_changed", "close_missing")
_KEEP, _INSERT, _CLOSE_CHANGED, _CLOSE_MISSING = range(len(ACTIONS))


@dataclass(frozen=True)
class HistorySpec:
    """What identifies a row and which columns open a new version when they change.

    ``null_safe`` selects the change test (see :func:`lakehist.functions.differs`).
    """

    keys: tuple[str, ...]
    tracked: tuple[str, ...]
    null_safe: bool = False


def current_versions(history: DataFrame) -> DataFrame:
    return history.where(F.col(CURRENT))


def _opened(snapshot: DataFrame, as_of: AsOf) -> DataFrame:
    return snapshot.select(
        "*",
        as_of.date().alias(START),
        open_end().alias(END),
        F.lit(True).alias(CURRENT),
        as_of.timestamp().alias(UPDATED),
    )


def _too_early(as_of: AsOf, kind: str) -> str:
    """SQL that fails the query, typed like what stands beside it."""
    return f"CAST(raise_error('the run is as of {as_of.day}, but a current version starts later') AS {kind})"


def _closed(current: DataFrame, as_of: AsOf) -> DataFrame:
    end = F.expr(f"IF({START} > DATE '{as_of.day}', {_too_early(as_of, 'date')}, DATE '{as_of.day}')")
    return current.withColumns({END: end, CURRENT: F.lit(False), UPDATED: as_of.timestamp()})


def scd2_bootstrap(snapshot: DataFrame, as_of: AsOf) -> DataFrame:
    """The first batch: every snapshot row opens a version."""
    return _opened(snapshot, as_of)


def changed_keys(current: DataFrame, snapshot: DataFrame, spec: HistorySpec) -> DataFrame:
    """Keys present on both sides whose tracked columns differ."""
    held, seen = current.alias("held"), snapshot.alias("seen")
    matched = held.join(seen, keys_equal("held", "seen", spec.keys))
    changed = matched.where(differs("held", "seen", spec.tracked, spec.null_safe))
    return changed.select(*[F.col(quoted(k, "held")) for k in spec.keys])


def scd2_delta(
    current: DataFrame, snapshot: DataFrame, spec: HistorySpec, as_of: AsOf, actions: bool = False
) -> DataFrame:
    """The next current versions plus the versions this batch closes, told apart by ``current_flag``.

    ``current`` must hold current versions only. ``actions=True`` adds a ``merge_action`` column, one of
    :data:`ACTIONS`. Rows with a NULL key can match nothing, so they go round the join instead of through
    it, where they would all land in one shuffle partition. A version that starts after the day of ``as_of``
    fails the query: closing it would end it before it starts.
    """
    business = snapshot.columns
    current = current.select(*columns([*business, *HISTORY_COLUMNS]))
    no_key = has_null_key(spec.keys)
    closed = _closed(current.where(no_key), as_of)
    opened = _opened(snapshot.where(no_key), as_of)
    if actions:
        closed = closed.withColumn(ACTION, F.lit("close_missing"))
        opened = opened.withColumn(ACTION, F.lit("insert"))
    current, snapshot = current.where(~no_key), snapshot.where(~no_key)

    held = current.select("*", F.lit(True).alias("_held")).alias("held")
    seen = snapshot.select("*", F.lit(True).alias("_seen")).alias("seen")
    pairs = held.join(seen, keys_equal("held", "seen", spec.keys), "full_outer")
    # A pair comes out once per action. The lists are constants, so the generator copies no row data.
    todo = f"""CASE
        WHEN held.{START} > DATE '{as_of.day}' THEN {_too_early(as_of, "array<int>")}
        WHEN held._held IS NULL THEN array({_INSERT})
        WHEN seen._seen IS NULL THEN array({_CLOSE_MISSING})
        WHEN {differs_sql("held", "seen", spec.tracked, spec.null_safe)} THEN array({_CLOSE_CHANGED}, {_INSERT})
        ELSE array({_KEEP}) END"""
    acted = pairs.select("*", F.expr(f"explode({todo})").alias("_action"))

    opens = F.col("_action") == _INSERT
    closes = F.col("_action") >= _CLOSE_CHANGED
    out = [
        F.expr(f"if(_action = {_INSERT}, {quoted(c, 'seen')}, {quoted(c, 'held')})").alias(c) for c in business
    ]
    out += [
        F.when(opens, as_of.date()).otherwise(F.col(f"held.{START}")).alias(START),
        F.when(opens, open_end()).when(closes, as_of.date()).otherwise(F.col(f"held.{END}")).alias(END),
        (~closes).alias(CURRENT),
        F.when(opens | closes, as_of.timestamp()).otherwise(F.col(f"held.{UPDATED}")).alias(UPDATED),
    ]
    if actions:
        names = ", ".join(f"'{name}'" for name in ACTIONS)
        out.append(F.expr(f"element_at(array({names}), _action + 1)").alias(ACTION))
    delta = acted.select(*out)
    return delta.unionByName(closed).unionByName(opened)


def scd2_merge(history: DataFrame, snapshot: DataFrame, spec: HistorySpec, as_of: AsOf) -> DataFrame:
    """Apply a snapshot to a whole history table; versions already closed pass through untouched.

    Both halves read ``history``, so hand in a stored table and not a long chain of pending merges:
    write or ``checkpoint()`` between batches.
    """
    already_closed = history.where(~F.col(CURRENT))
    delta = scd2_delta(current_versions(history), snapshot, spec, as_of)
    return already_closed.select(*columns(delta.columns)).unionByName(delta)
