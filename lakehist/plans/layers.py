"""The layer jobs: raw -> bronze (history) -> silver (mirror) -> gold (attributes) -> ranking.

Layers meet only in storage, so each can be run as a job of its own, in this order, or all four in one
session under one clock with :func:`run_all`. Bronze and silver read their last published state
and write the next; a job that fails half-way leaves the last state in place and is simply run again.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from lakehist.functions import AsOf
from lakehist.functions.clock import BUSINESS_ZONE
from lakehist.operators import scd1_mirror, scd2_bootstrap, scd2_delta, top_bottom, validate_keys
from lakehist.operators.scd2 import CURRENT
from lakehist.plans.customers import CUSTOMERS
from lakehist.plans.entity import Entity
from lakehist.sources import BatchTable, SinkSpec, publish, read_snapshot, superset


@dataclass(frozen=True)
class Lake:
    """Where a table's layers live, and how its jobs run.

    ``base`` is any Hadoop URI. ``raw_path`` defaults to the raw layer under ``base``. ``buckets``
    co-locates bronze and silver by key (see :class:`BatchTable`): a number sets the layout, None keeps what the
    last batch has and is 0 (no buckets) for a new table; silver then follows bronze. ``null_keys=True``
    accepts snapshots with NULL keys instead of refusing them; ``check_keys=False`` skips the key check for
    extracts whose source already guarantees unique keys. ``keep`` is how many states of a layer to leave on
    storage after each job (all of them by default); closed versions always stay.
    """

    base: str
    entity: Entity = CUSTOMERS
    raw_path: str | None = None
    zone: str = BUSINESS_ZONE
    buckets: int | None = None
    null_safe: bool = False
    null_keys: bool = False
    check_keys: bool = True
    skip_null_metric: bool = False
    keep: int | None = None
    gold_sinks: tuple[SinkSpec, ...] = ()
    ranking_sinks: tuple[SinkSpec, ...] = ()

    def __post_init__(self) -> None:
        if self.keep is not None and self.keep < 2:
            raise ValueError("keep at least 2 states: repeating the last batch starts from the one before it")
        if self.buckets and self.null_keys:
            raise ValueError("all NULL keys would fall into one bucket: use null_keys without buckets")

    def path(self, layer: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{layer}_{self.entity.name}"

    @property
    def raw(self) -> str:
        return self.raw_path or f"{self.path('raw')}/raw_{self.entity.name}.parquet"

    @property
    def bronze(self) -> BatchTable:
        return BatchTable(self.path("bronze"), self.entity.bronze, self.entity.history.keys, CURRENT, self.buckets or 0)

    @property
    def silver(self) -> BatchTable:
        return BatchTable(self.path("silver"), self.entity.silver, self.entity.mirror.keys, None, self.buckets or 0)

    @property
    def gold(self) -> BatchTable:
        # Rebuilt on every run under whatever columns the rules yield, so no schema is declared.
        return BatchTable(self.path("gold"), None)

    def store(
        self, spark: SparkSession, table: BatchTable, rows: DataFrame, batch: int, clustered: bool = False
    ) -> None:
        """Write a batch of one of the layers, then drop the states beyond ``keep``."""
        table.write(rows, batch, clustered)
        if self.keep is not None:
            table.expire(spark, self.keep)

    def clock(self, as_of: AsOf | None) -> AsOf:
        """The clock of a job: now unless given, and in the zone that the lake's days are counted in."""
        as_of = as_of or AsOf.now(self.zone)
        if as_of.zone != self.zone:
            raise ValueError(f"the clock counts days in {as_of.zone}, the lake in {self.zone}")
        return as_of


@dataclass(frozen=True)
class RunResult:
    """The batch number each layer published, and the clock they share."""

    as_of: AsOf
    bronze: int
    silver: int
    gold: int


@contextmanager
def _session_for(spark: SparkSession, lake: Lake) -> Iterator[None]:
    """Session settings of a job, put back afterwards.

    Calendar arithmetic happens in the lake's zone. The history is written in two partitions, so tasks
    can keep both files open instead of sorting their rows by partition first.
    """
    wanted = {
        "spark.sql.session.timeZone": lake.zone,
        "spark.sql.maxConcurrentOutputFileWriters": "2",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def _batch_numbers(spark: SparkSession, table: BatchTable, batch: int | None) -> tuple[int, int | None]:
    """The batch to write and the one it starts from; repeating the last batch starts from the one before it."""
    newest = table.latest(spark)
    if batch is None:
        return (0 if newest is None else newest + 1), newest
    if newest is not None and batch < newest:
        raise ValueError(f"batch {batch} of {table.root} cannot be rewritten: batch {newest} builds on it")
    return batch, table.latest(spark, before=batch)


def run_bronze(
    spark: SparkSession, lake: Lake, as_of: AsOf | None = None, batch: int | None = None, raw_path: str | None = None
) -> int:
    """Fold the raw snapshot into the history and return the batch number published."""
    as_of = lake.clock(as_of)
    entity, bronze = lake.entity, lake.bronze
    spec = replace(entity.history, null_safe=lake.null_safe)
    with _session_for(spark, lake):
        raw_path = raw_path or lake.raw
        snapshot = read_snapshot(spark, raw_path, entity.raw)
        if lake.check_keys:
            validate_keys(snapshot, spec.keys, allow_null=lake.null_keys)
        batch, previous = _batch_numbers(spark, bronze, batch)
        if lake.buckets is None and previous is not None:
            bronze = replace(bronze, buckets=bronze.batches(spark)[previous])
        if previous is None:
            lake.store(spark, bronze, scd2_bootstrap(snapshot, as_of), batch)
        else:
            current = bronze.read(spark, previous)
            delta = scd2_delta(current, snapshot, spec, as_of)
            lake.store(spark, bronze, delta, batch, _in_buckets(spark, bronze.buckets, {bronze: previous}))
    return batch


def run_silver(spark: SparkSession, lake: Lake, as_of: AsOf | None = None, batch: int | None = None) -> int:
    """Mirror the current bronze rows, conformed, and return the batch number published."""
    as_of = lake.clock(as_of)
    entity, silver = lake.entity, lake.silver
    spec = replace(entity.mirror, null_safe=lake.null_safe)
    with _session_for(spark, lake):
        inputs = {lake.bronze: lake.bronze.latest(spark)}
        mirrored = entity.conformed(lake.bronze.read(spark, inputs[lake.bronze]), as_of)
        if lake.buckets is None:
            silver = replace(silver, buckets=lake.bronze.batches(spark)[inputs[lake.bronze]])
        batch, previous = _batch_numbers(spark, silver, batch)
        if previous is not None:
            inputs[silver] = previous
            mirrored = scd1_mirror(silver.read(spark, previous), mirrored, spec)
        lake.store(spark, silver, mirrored, batch, _in_buckets(spark, silver.buckets, inputs))
    return batch


def run_gold(spark: SparkSession, lake: Lake, as_of: AsOf | None = None, batch: int | None = None) -> int:
    """Rebuild gold, then publish what was stored to every gold sink; return the batch number."""
    as_of = lake.clock(as_of)
    with _session_for(spark, lake):
        batch, previous = _batch_numbers(spark, lake.gold, batch)
        rows = lake.entity.enriched(lake.silver.read(spark), as_of)
        if previous is not None:  # columns are never lost: the table keeps those that the rules no longer yield
            rows = superset(rows, lake.gold.read(spark, previous).schema)
        lake.store(spark, lake.gold, rows, batch)
        for sink in lake.gold_sinks:
            publish(lake.gold.read(spark, batch), sink)
    return batch


def run_ranking(spark: SparkSession, lake: Lake, as_of: AsOf | None = None, batch: int | None = None) -> DataFrame:
    """The top/bottom report over stored gold, published to every ranking sink."""
    as_of = lake.clock(as_of)
    with _session_for(spark, lake):
        gold = lake.gold.read(spark, batch)
        report = top_bottom(gold, lake.entity.ranking, as_of.audit(), lake.skip_null_metric)
        for sink in lake.ranking_sinks:
            publish(report, sink)
    return report


def run_all(
    spark: SparkSession, lake: Lake, as_of: AsOf | None = None, batch: int | None = None, raw_path: str | None = None
) -> RunResult:
    """All four jobs in order, under one clock."""
    as_of = lake.clock(as_of)
    bronze = run_bronze(spark, lake, as_of, batch, raw_path)
    silver = run_silver(spark, lake, as_of, batch)
    gold = run_gold(spark, lake, as_of, batch)
    run_ranking(spark, lake, as_of, gold)
    return RunResult(as_of, bronze, silver, gold)


def _in_buckets(spark: SparkSession, buckets: int, inputs: Mapping[BatchTable, int | None]) -> bool:
    """Whether every stored input already lies in the buckets that are about to be written, so that the
    join's tasks come out as whole buckets."""
    usable = buckets > 0 and spark.conf.get("spark.sql.sources.bucketing.enabled") == "true"
    return usable and all(table.batches(spark).get(batch) == buckets for table, batch in inputs.items())
