"""The change test shared by the history and mirror operators.

Conditions over many columns are composed as one SQL expression: it parses in a single call, where a
chain of Column operators would cross to the JVM several times per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str, relation: str | None = None) -> str:
    """A column name as SQL, whatever characters it holds."""
    column = "`" + name.replace("`", "``") + "`"
    return f"{relation}.{column}" if relation else column


def columns(names: Iterable[str]) -> list[Column]:
    return [F.col(quoted(name)) for name in names]


def differs_sql(left: str, right: str, names: Sequence[str], null_safe: bool = False) -> str:
    """SQL text of :func:`differs`."""
    comparison = "NOT {} <=> {}" if null_safe else "{} <> {}"
    tests = [comparison.format(quoted(n, left), quoted(n, right)) for n in names]
    return f"coalesce({' OR '.join(tests)}, false)" if tests else "false"


def differs(left: str, right: str, names: Sequence[str], null_safe: bool = False) -> Column:
    """True where any of the named columns differs between the relations aliased ``left`` and ``right``; never NULL.

    The default is the SQL ``<>`` chain under three-valued logic: a column that turns from or to NULL
    counts only if some other column differs as well. ``null_safe=True`` counts it on its own.
    """
    return F.expr(differs_sql(left, right, names, null_safe))
