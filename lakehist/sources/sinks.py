"""Publishing a result to any Spark data source: a warehouse connector, JDBC, a lake format or files."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class SinkSpec:
    """``df.write.format(format).options(**options).mode(mode).save(path)``, as data.

    A warehouse table replaced on each run, for example::

        SinkSpec("bigquery", {"table": "project.dataset.customers", "writeMethod": "direct"})
    """

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    path: str | None = None
    mode: str = "overwrite"


def publish(df: DataFrame, sink: SinkSpec) -> None:
    df.write.format(sink.format).options(**sink.options).mode(sink.mode).save(sink.path)
