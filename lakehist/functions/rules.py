"""Declarative business rules: thresholds in, one built-in Column expression out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakehist.functions.clock import AsOf

Bounds = Sequence[tuple[float, str]]


def days_since(column: Column | str, as_of: AsOf) -> Column:
    """Whole days from ``column`` to the run's day: negative for a future date, NULL for NULL."""
    return F.datediff(as_of.date(), column)


def at_most(value: Column, limit: int) -> Column:
    """``value <= limit`` with NULL read as False."""
    return F.coalesce(value <= limit, F.lit(False))


def first_at_least(value: Column, floors: Bounds, default: str) -> Column:
    """Label of the first floor that ``value`` reaches (bounds inclusive), else ``default``."""
    return _first_match(floors, default, lambda bound: value >= bound)


def first_above(value: Column, bounds: Bounds, default: str) -> Column:
    """Label of the first bound that ``value`` exceeds (bounds exclusive), else ``default``."""
    return _first_match(bounds, default, lambda bound: value > bound)


def _first_match(bounds: Bounds, default: str, test: Callable[[float], Column]) -> Column:
    (bound, label), *rest = bounds
    case = F.when(test(bound), label)
    for bound, label in rest:
        case = case.when(test(bound), label)
    return case.otherwise(default)
