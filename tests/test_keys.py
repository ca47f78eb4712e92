from dataclasses import replace

import pytest
from helpers import SPEC, snapshot
from lakehist.operators import KeyContractError, changed_keys, key_violations, validate_keys


def test_null_and_repeated_keys_are_reported(spark):
    rows = snapshot(spark, (1, "a", 1.0), (2, "b", 1.0), (2, "c", 1.0), (None, "d", 1.0))
    assert {tuple(r) for r in key_violations(rows, ["id"]).collect()} == {(2, 2), (None, 1)}
    with pytest.raises(KeyContractError, match="2 are not"):
        validate_keys(rows, ["id"])


def test_null_keys_can_be_tolerated_but_not_repeated_ones(spark):
    validate_keys(snapshot(spark, (1, "a", 1.0), (None, "d", 1.0), (None, "d", 1.0)), ["id"], allow_null=True)
    with pytest.raises(KeyContractError):
        validate_keys(snapshot(spark, (1, "a", 1.0), (1, "a", 1.0)), ["id"], allow_null=True)


def test_keys_may_span_columns(spark):
    rows = snapshot(spark, (1, "a", 1.0), (1, "b", 1.0))
    validate_keys(rows, ["id", "city"])


@pytest.mark.parametrize("null_safe", [False, True])
def test_change_test_under_both_null_policies(spark, null_safe):
    old = snapshot(spark, (1, "a", 1.0), (2, "a", 1.0), (3, None, 1.0), (4, "a", 1.0), (5, None, 1.0), (6, None, 1.0))
    new = snapshot(spark, (1, "a", 1.0), (2, "b", 1.0), (3, "a", 1.0), (4, None, 1.0), (5, "a", 2.0), (6, None, 1.0))
    got = {r.id for r in changed_keys(old, new, replace(SPEC, null_safe=null_safe)).collect()}
    assert got == ({2, 3, 4, 5} if null_safe else {2, 5})
