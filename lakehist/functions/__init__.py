"""Column-level building blocks: the run clock, change tests and business rules."""

from lakehist.functions.changes import differs
from lakehist.functions.clock import AsOf
from lakehist.functions.rules import at_most, days_since, first_above, first_at_least

__all__ = ["AsOf", "at_most", "days_since", "differs", "first_above", "first_at_least"]
