from collections import Counter
from dataclasses import replace
from datetime import date

import pytest
from pyspark.errors import PySparkException
from helpers import OPEN, SCHEMA, SPEC, bag, snapshot
from lakehist.functions import AsOf
from lakehist.operators import current_versions, scd2_bootstrap, scd2_delta, scd2_merge
from lakehist.operators.scd2 import ACTION
from pyspark.sql import functions as F

DAYS = [AsOf.at(f"2024-05-0{n} 08:00:00") for n in range(1, 6)]
D = [d.day for d in DAYS]


def versions(history):
    """(id, city, spend, start, end, current) of every row."""
    return Counter(
        (r.id, r.city, r.spend, r.start_date, r.end_date, r.current_flag) for r in history.collect()
    )


def test_bootstrap_opens_every_row(spark):
    history = scd2_bootstrap(snapshot(spark, (1, "a", 1.0)), DAYS[0])
    assert versions(history) == Counter([(1, "a", 1.0, D[0], OPEN, True)])
    assert history.columns == ["id", "city", "spend", "start_date", "end_date", "current_flag", "updated_at"]


def test_each_class_of_row(spark):
    old = scd2_bootstrap(snapshot(spark, (1, "same", 1.0), (2, "old", 1.0), (3, "gone", 1.0), (4, None, 1.0)), DAYS[0])
    new = snapshot(spark, (1, "same", 1.0), (2, "new", 1.0), (4, "filled", 1.0), (5, "added", 1.0))
    assert versions(scd2_merge(old, new, SPEC, DAYS[1])) == Counter([
        (1, "same", 1.0, D[0], OPEN, True),
        (2, "old", 1.0, D[0], D[1], False),
        (2, "new", 1.0, D[1], OPEN, True),
        (3, "gone", 1.0, D[0], D[1], False),
        (4, None, 1.0, D[0], OPEN, True),  # NULL -> value alone is no change under SQL comparison
        (5, "added", 1.0, D[1], OPEN, True),
    ])


def test_stamps_move_only_on_rows_that_move(spark):
    old = scd2_bootstrap(snapshot(spark, (1, "same", 1.0), (2, "old", 1.0)), DAYS[0])
    merged = scd2_merge(old, snapshot(spark, (1, "same", 1.0), (2, "new", 1.0)), SPEC, DAYS[1])
    stamps = {(r.id, r.city): r.s for r in merged.select("id", "city", F.unix_seconds("updated_at").alias("s")).collect()}
    first, second = (int(d.instant.timestamp()) for d in DAYS[:2])
    assert stamps == {(1, "same"): first, (2, "old"): second, (2, "new"): second}


@pytest.mark.parametrize(("null_safe", "opened"), [(False, 0), (True, 2)])
def test_null_policy(spark, null_safe, opened):
    old = scd2_bootstrap(snapshot(spark, (1, None, 1.0), (2, "a", 1.0), (3, None, 1.0)), DAYS[0])
    new = snapshot(spark, (1, "a", 1.0), (2, None, 1.0), (3, None, 1.0))
    delta = scd2_delta(old, new, replace(SPEC, null_safe=null_safe), DAYS[1], actions=True)
    assert delta.where(F.col(ACTION) == "insert").count() == opened


def test_null_safe_policy_leaves_unmatched_rows_in_their_own_class(spark):
    old = scd2_bootstrap(snapshot(spark, (1, "a", 1.0)), DAYS[0])
    delta = scd2_delta(old, snapshot(spark, (2, "b", 1.0)), replace(SPEC, null_safe=True), DAYS[1], actions=True)
    assert {(r.id, r[ACTION]) for r in delta.collect()} == {(1, "close_missing"), (2, "insert")}


def test_returning_key_leaves_a_visible_gap(spark):
    history = scd2_bootstrap(snapshot(spark, (1, "a", 1.0)), DAYS[0])
    history = scd2_merge(history, snapshot(spark), SPEC, DAYS[1])
    history = scd2_merge(history, snapshot(spark, (1, "a", 1.0)), SPEC, DAYS[3])
    assert versions(history) == Counter([(1, "a", 1.0, D[0], D[1], False), (1, "a", 1.0, D[3], OPEN, True)])


def test_closed_versions_of_a_present_key_stay_as_they_were(spark):
    history = scd2_bootstrap(snapshot(spark, (1, "a", 1.0)), DAYS[0])
    history = scd2_merge(history, snapshot(spark, (1, "b", 1.0)), SPEC, DAYS[1])
    history = scd2_merge(history, snapshot(spark, (1, "c", 1.0)), SPEC, DAYS[2])
    assert versions(history) == Counter([
        (1, "a", 1.0, D[0], D[1], False), (1, "b", 1.0, D[1], D[2], False), (1, "c", 1.0, D[2], OPEN, True),
    ])


def test_two_changes_in_a_day_leave_a_zero_length_version(spark):
    history = scd2_bootstrap(snapshot(spark, (1, "a", 1.0)), DAYS[0])
    history = scd2_merge(history, snapshot(spark, (1, "b", 1.0)), SPEC, DAYS[1])
    history = scd2_merge(history, snapshot(spark, (1, "c", 1.0)), SPEC, DAYS[1])
    assert (1, "b", 1.0, D[1], D[1], False) in versions(history)


def test_same_snapshot_again_changes_nothing(spark):
    first = scd2_bootstrap(snapshot(spark, (1, "a", None), (2, "b", 2.0)), DAYS[0])
    again = scd2_merge(first, snapshot(spark, (1, "a", None), (2, "b", 2.0)), SPEC, DAYS[1])
    assert bag(again) == bag(first)


def test_empty_snapshot_closes_everything(spark):
    merged = scd2_merge(scd2_bootstrap(snapshot(spark, (1, "a", 1.0)), DAYS[0]), snapshot(spark), SPEC, DAYS[1])
    assert current_versions(merged).count() == 0 and merged.count() == 1


def test_null_keys_are_closed_and_opened_again_by_every_batch(spark):
    spec = SPEC
    rows = snapshot(spark, (1, "a", 1.0), (None, "x", 1.0))
    history = scd2_merge(scd2_bootstrap(rows, DAYS[0]), rows, spec, DAYS[1])
    history = scd2_merge(history, rows, spec, DAYS[2])
    assert versions(history) == Counter([
        (1, "a", 1.0, D[0], OPEN, True),
        (None, "x", 1.0, D[0], D[1], False), (None, "x", 1.0, D[1], D[2], False), (None, "x", 1.0, D[2], OPEN, True),
    ])


def test_null_key_rows_go_round_the_join_with_their_actions(spark):
    rows = snapshot(spark, (1, "a", 1.0), (None, "x", 1.0), (None, "x", 1.0))
    delta = scd2_delta(scd2_bootstrap(rows, DAYS[0]), rows, SPEC, DAYS[1], actions=True)
    assert Counter((r.id, r[ACTION]) for r in delta.collect()) == Counter(
        {(1, "keep"): 1, (None, "close_missing"): 2, (None, "insert"): 2}
    )


@pytest.mark.parametrize("key", [1, None])
def test_a_clock_behind_the_history_fails_the_query(spark, key):
    held = scd2_bootstrap(snapshot(spark, (key, "a", 1.0)), DAYS[1])
    for seen in (snapshot(spark, (key, "b", 1.0)), snapshot(spark, (key, "a", 1.0)), snapshot(spark)):
        with pytest.raises(PySparkException, match="starts later"):
            scd2_merge(held, seen, SPEC, DAYS[0]).collect()
    assert scd2_merge(held, snapshot(spark, (key, "b", 1.0)), SPEC, DAYS[1]).count() == 2  # the same day is fine


def test_keys_of_several_columns_and_untracked_columns(spark):
    spec = replace(SPEC, keys=("id", "city"), tracked=())
    old = scd2_bootstrap(snapshot(spark, (1, "a", 1.0), (1, "b", 1.0)), DAYS[0])
    merged = scd2_merge(old, snapshot(spark, (1, "a", 9.0), (1, "c", 1.0)), spec, DAYS[1])
    assert versions(merged) == Counter([
        (1, "a", 1.0, D[0], OPEN, True),  # spend is not tracked, so the old version stands
        (1, "b", 1.0, D[0], D[1], False),
        (1, "c", 1.0, D[1], OPEN, True),
    ])


def test_column_order_of_the_history_does_not_matter(spark):
    old = scd2_bootstrap(snapshot(spark, (1, "a", 1.0)), DAYS[0])
    shuffled = old.select(*reversed(old.columns))
    assert versions(scd2_merge(shuffled, snapshot(spark, (1, "b", 1.0)), SPEC, DAYS[1])) == versions(
        scd2_merge(old, snapshot(spark, (1, "b", 1.0)), SPEC, DAYS[1])
    )


def test_schema_is_the_snapshot_plus_validity(spark):
    merged = scd2_merge(scd2_bootstrap(snapshot(spark), DAYS[0]), snapshot(spark), SPEC, DAYS[1])
    assert merged.dtypes == [
        *((f.name, f.dataType.simpleString()) for f in SCHEMA),
        ("start_date", "date"), ("end_date", "date"), ("current_flag", "boolean"), ("updated_at", "timestamp"),
    ]
    assert date(9999, 12, 31) == OPEN
