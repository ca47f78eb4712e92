"""Whole jobs: the customer model, the layer jobs and the snapshots derived from the test tables."""

from lakehist.plans.customers import CUSTOMERS
from lakehist.plans.entity import Entity
from lakehist.plans.layers import Lake, RunResult, run_all, run_bronze, run_gold, run_ranking, run_silver

__all__ = ["CUSTOMERS", "Entity", "Lake", "RunResult", "run_all", "run_bronze", "run_gold", "run_ranking", "run_silver"]
