"""Relational building blocks: every operator takes DataFrames and returns a DataFrame, without any I/O."""

from lakehist.operators.conform import conform
from lakehist.operators.enrich import enrich
from lakehist.operators.keys import KeyContractError, key_violations, validate_keys
from lakehist.operators.ranking import Ranking, bottom, top, top_bottom
from lakehist.operators.scd1 import MirrorSpec, scd1_delta, scd1_mirror
from lakehist.operators.scd2 import HistorySpec, changed_keys, current_versions, scd2_bootstrap, scd2_delta, scd2_merge

__all__ = [
    "HistorySpec", "KeyContractError", "MirrorSpec", "Ranking", "bottom", "changed_keys", "conform",
    "current_versions", "enrich", "key_violations", "scd1_delta", "scd1_mirror", "scd2_bootstrap",
    "scd2_delta", "scd2_merge", "top", "top_bottom", "validate_keys",
]
