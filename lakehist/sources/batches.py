"""Tables kept as one directory per batch, so that the next state can be computed from the last one.

Overwriting a directory that the same plan reads destroys its input, and plain parquet has no row-level
merge. So every attempt at batch ``n`` is written to a directory of its own, and a marker that is created once all of
it is there makes it the batch::

    <root>/_published/<n>-<attempt>-<buckets>         what counts, in one listing
    <root>/_started/<n>-<attempt>                     an attempt that has begun and is not published
    <root>/batch=<n>/attempt=<attempt>/rows/[current_flag=true/]part-*.parquet
    <root>/batch=<n>/attempt=<attempt>/closed/part-*.parquet

Repeating a batch writes beside the published attempt and replaces it by publishing; if it fails, the published
one stands. A run that lost its driver is simply run again; of two at once, the second is refused. Batch directories without
a marker are the remains of a table that lost its markers: writing there is refused, since it would start the history over.

``state="current_flag"`` declares a history table. There a batch holds every current row, and of the
closed rows only those that this batch closed. The full table at ``n`` is the current rows of ``n`` plus
the closed rows of all batches up to ``n``. Closed rows never enter a join, so they are not laid out for one:
they are rewritten to as few files as their bytes ask for.

Superseded states stay readable until :meth:`BatchTable.expire` drops them; closed rows are never dropped.

``buckets > 0`` hashes every batch by ``keys`` into that many files with Spark's own bucketing, so the
next merge on those keys reads this side without a shuffle. Choose it so that a bucket of current rows is
100 MB to 1 GB as stored: a task sorts one bucket, and spills what does not fit.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakehist.functions.changes import columns, quoted
from lakehist.sources import files

_PUBLISHED, _STARTED = "_published", "_started"
_MARKER = re.compile(r"(\d+)-(\d+)-(\d+)(-closed)?$")
_BEGUN = re.compile(r"(\d+)-(\d+)$")


@dataclass(frozen=True)
class Published:
    """What a marker says: the attempt that counts, its buckets, and whether only its closed rows are left."""

    attempt: int
    buckets: int
    expired: bool


@dataclass(frozen=True)
class BatchTable:
    """A table under ``root``; ``schema=None`` reads whatever columns a batch was written with."""

    root: str
    schema: StructType | None
    keys: tuple[str, ...] = ()
    state: str | None = None
    buckets: int = 0

    def __post_init__(self) -> None:
        if self.buckets and not (self.keys and self.schema):
            raise ValueError("bucketing needs keys and a declared schema")
        if self.buckets and files.literal(self.root) != self.root:
            raise ValueError(f"Spark reads the path of a bucketed table as a pattern, and {self.root} is one")

    def published(self, spark: SparkSession) -> dict[int, Published]:
        """The batches that count, oldest first, by one listing."""
        found: dict[int, Published] = {}
        for name in files.names(spark, f"{self.root}/{_PUBLISHED}"):
            if m := _MARKER.match(name):
                batch, marker = int(m[1]), Published(int(m[2]), int(m[3]), bool(m[4]))
                # Between publishing a repeat and dropping what it replaces there are two; so there are for a moment
                # when a state expires.
                known = found.get(batch)
                if not known or (marker.attempt, marker.expired) > (known.attempt, known.expired):
                    found[batch] = marker
        return dict(sorted(found.items()))

    def batches(self, spark: SparkSession) -> dict[int, int]:
        """Complete batches, oldest first, each with the bucket count it was written with."""
        return {n: marker.buckets for n, marker in self.published(spark).items()}

    def latest(self, spark: SparkSession, before: int | None = None) -> int | None:
        """The newest complete batch (below ``before``), or None for a table that does not exist yet."""
        known = [n for n in self.batches(spark) if before is None or n < before]
        return max(known, default=None)

    def write(self, df: DataFrame, batch: int, clustered: bool = False) -> None:
        """Write and publish one batch; a job that another one overtakes raises ``FileExistsError`` and publishes nothing.

        ``clustered=True`` says that ``df`` comes out of a join on the bucketed keys, so each task already holds whole
        buckets. Otherwise a bucketed write shuffles first, or every task would write a file for every bucket.
        """
        spark = df.sparkSession
        known, begun = self.published(spark), self._begun(spark)
        self._refuse_remains(spark, batch, known, begun)
        own = [m.attempt for n, m in known.items() if n == batch] + [k for n, k in begun if n == batch]
        attempt = 1 + max(own, default=-1)
        target = self._path(batch, attempt)
        files.claim(spark, f"{self.root}/{_STARTED}/{batch}-{attempt}")  # of two jobs at once, one gets no further
        if self.buckets and not clustered:
            df = df.repartition(self.buckets, *self.keys)
        writer = df.write.format("parquet").mode("overwrite").option("partitionOverwriteMode", "static")
        if self.state:
            writer = writer.partitionBy(self.state)
        if self.buckets:
            # Spark writes buckets only through a catalog entry. It is dropped at once: the marker has the bucket count.
            entry = _entry_name()
            try:
                writer.bucketBy(self.buckets, *self.keys).option("path", f"{target}/rows").saveAsTable(entry)
            finally:
                spark.sql(f"DROP TABLE IF EXISTS {entry}")
        else:
            writer.save(f"{target}/rows")
        if self.state:
            self._compact_closed(spark, target)
        if self.published(spark).get(batch) != known.get(batch):
            raise FileExistsError(f"another job has published batch {batch} of {self.root} in the meantime")
        files.touch(spark, f"{self.root}/{_PUBLISHED}/{batch}-{attempt}-{self.buckets}")
        self._drop_others(spark, batch, attempt, known, begun)

    def _path(self, batch: int, attempt: int) -> str:
        return f"{self.root}/batch={batch}/attempt={attempt}"

    def _begun(self, spark: SparkSession) -> list[tuple[int, int]]:
        found = [_BEGUN.match(name) for name in files.names(spark, f"{self.root}/{_STARTED}")]
        return [(int(m[1]), int(m[2])) for m in found if m]

    def _refuse_remains(
        self, spark: SparkSession, batch: int, known: dict[int, Published], begun: list[tuple[int, int]]
    ) -> None:
        noted = {*known, *(n for n, _ in begun)}
        # A table that does not exist yet may have no batch at all; one that does may not have this one.
        there = files.names(spark, self.root) if not known else [f"batch={batch}"]
        for name in there:
            number = re.fullmatch(r"batch=(\d+)", name)
            if number and int(number[1]) not in noted and files.exists(spark, f"{self.root}/{name}"):
                raise FileExistsError(
                    f"{self.root}/{name} is neither published nor being written: restore its marker, or remove the "
                    "directory if its rows are not wanted"
                )

    def _compact_closed(self, spark: SparkSession, target: str) -> None:
        """Rewrite the closed rows of an attempt to few files; a single one is fine as it is."""
        closed = f"{target}/rows/{self.state}=false"
        if len([n for n in files.names(spark, closed) if n.endswith(".parquet")]) > 1:
            rows = spark.read.schema(self._stored_schema()).parquet(files.literal(closed))
            rows.hint("rebalance").write.mode("overwrite").parquet(f"{target}/closed")
            files.delete(spark, closed)

    def _drop_others(
        self, spark: SparkSession, batch: int, attempt: int, known: dict[int, Published], begun: list[tuple[int, int]]
    ) -> None:
        """What a published attempt replaces: marker first, so that nothing is taken for complete while rows go."""
        if batch in known:
            old = known[batch]
            for suffix in ("", "-closed"):
                files.delete(spark, f"{self.root}/{_PUBLISHED}/{batch}-{old.attempt}-{old.buckets}{suffix}")
            files.delete(spark, self._path(batch, old.attempt))
        for n, k in [*begun, (batch, attempt)]:
            if n == batch:
                if k != attempt:
                    files.delete(spark, self._path(batch, k))
                files.delete(spark, f"{self.root}/{_STARTED}/{n}-{k}")

    def _stored_schema(self) -> StructType:
        """Without the column that directories tell."""
        return StructType([f for f in self.schema if f.name != self.state])

    def _stated(self, rows: DataFrame, current: bool) -> DataFrame:
        return rows.withColumn(self.state, F.lit(current)).select(*columns(self.schema.names))

    def read(self, spark: SparkSession, batch: int | None = None) -> DataFrame:
        """The live rows of one batch: the whole batch, or the current rows of a history table."""
        batch, marker = self._resolve(spark, batch)
        directory, schema = f"{self._path(batch, marker.attempt)}/rows", self.schema
        if self.state:
            directory, schema = f"{directory}/{self.state}=true", self._stored_schema()
            if not files.exists(spark, directory):
                return spark.createDataFrame([], self.schema)
        if marker.buckets and schema:
            rows = _read_bucketed(spark, directory, schema, self.keys, marker.buckets)
        else:
            rows = (spark.read.schema(schema) if schema else spark.read).parquet(files.literal(directory))
        if self.state:
            return self._stated(rows, True)
        return rows.select(*columns(self.schema.names)) if self.schema else rows

    def read_history(self, spark: SparkSession, batch: int | None = None) -> DataFrame:
        """All versions as of ``batch``, current and closed. Superseded copies are not even listed."""
        if not self.state:
            raise ValueError(f"{self.root} keeps no history")
        batch, marker = self._resolve(spark, batch)
        parts = []
        live = f"{self._path(batch, marker.attempt)}/rows/{self.state}=true"
        if files.exists(spark, live):
            parts.append(self._stated(spark.read.schema(self._stored_schema()).parquet(files.literal(live)), True))
        closed = []
        for number, held in self.published(spark).items():
            if number <= batch:
                path = self._path(number, held.attempt)
                closed += [d for d in (f"{path}/closed", f"{path}/rows/{self.state}=false") if files.exists(spark, d)]
        if closed:
            rows = spark.read.schema(self._stored_schema()).parquet(*map(files.literal, closed))
            parts.append(self._stated(rows, False))
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], self.schema)

    def expire(self, spark: SparkSession, keep: int) -> None:
        """Drop every state but the newest ``keep``. Closed rows of a history table all stay.

        Give readers that may still be on an older state the time to finish: ``keep`` counts batches.
        """
        if keep < 1:
            raise ValueError("the newest state cannot be dropped")
        for batch, marker in list(self.published(spark).items())[:-keep]:
            if marker.expired:
                continue
            name = f"{self.root}/{_PUBLISHED}/{batch}-{marker.attempt}-{marker.buckets}"
            # The marker changes first, so that a state is never taken for complete once rows are going.
            if self.state:
                files.touch(spark, f"{name}-closed")
                files.delete(spark, name)
                files.delete(spark, f"{self._path(batch, marker.attempt)}/rows/{self.state}=true")
            else:
                files.delete(spark, name)
                files.delete(spark, f"{self.root}/batch={batch}")

    def _resolve(self, spark: SparkSession, batch: int | None) -> tuple[int, Published]:
        known = self.published(spark)
        wanted = max(known, default=None) if batch is None else batch
        if wanted not in known:
            raise FileNotFoundError(f"no complete batch {'at all' if batch is None else batch} under {self.root}")
        if known[wanted].expired:
            raise FileNotFoundError(f"the state of batch {wanted} under {self.root} has been dropped")
        return wanted, known[wanted]


def superset(df: DataFrame, before: StructType) -> DataFrame:
    """``df`` with the columns of ``before`` first: one that ``df`` lacks is NULL, one of another type is an error."""
    own = {f.name: f.dataType for f in df.schema}
    changed = [f.name for f in before if own.get(f.name, f.dataType) != f.dataType]
    if changed:
        raise ValueError(f"the type of a stored column cannot change: {', '.join(changed)}")
    held = [F.col(quoted(f.name)) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in before]
    return df.select(*held, *columns([n for n in own if n not in before.names]))


def _entry_name() -> str:
    """An entry of Spark's own catalog, whatever the session's current one is."""
    return f"spark_catalog.default.lakehist_{uuid.uuid4().hex}"


def _read_bucketed(
    spark: SparkSession, directory: str, schema: StructType, keys: Sequence[str], buckets: int
) -> DataFrame:
    entry = _entry_name()
    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    by = ", ".join(quoted(k) for k in keys)
    place = directory.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {entry} ({fields}) USING parquet "
        f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    try:
        return spark.table(entry)  # resolved here, so the entry itself is no longer needed
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {entry}")
