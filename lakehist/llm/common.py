"""Small helpers the operators share: shared storage, free column names, running totals over hot groups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakehist.sources.files import delete

_FOLDER: ContextVar[str | None] = ContextVar("scratch folder", default=None)

#: Values of the salt that :func:`running_totals` splits every group by.
SALTS = 256


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the warehouse where it is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return shared.rstrip("/")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder, or in that of :func:`scratch_folder`."""
    return f"{_FOLDER.get() or shared_dir(spark)}/llm-{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A folder that takes up whatever is written meanwhile, and is removed at the end; results that are still to be read belong
    elsewhere."""
    folder = scratch(spark, purpose)
    token = _FOLDER.set(folder)
    try:
        yield folder
    finally:
        _FOLDER.reset(token)
        delete(spark, folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its plan runs once, and its lineage is cut."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def place_of(df: DataFrame, column: str) -> int:
    """Where ``column`` stands among the columns; as in Spark, the case of its letters does not count."""
    return [c.lower() for c in df.columns].index(column.lower())


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def running_totals(
    rows: DataFrame, group: str, tie: Sequence[str], totals: dict[str, str], first: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split every group into :data:`SALTS` cells, so that no task has to hold a hot group.

    ``tie`` orders the rows of a group; its first column is a 64-bit hash whose top byte is the cell. ``first`` (a small
    number) orders them before it: then each of its values has so many cells. Returns
    the rows with ``_cell``, and one row per group and cell with the sum of each column of ``totals`` in it
    (named by the value) and in the cells of the group before it (``<value>_before``).
    """
    salt = F.shiftrightunsigned(F.col(tie[0]), 56).cast("int")
    rows = rows.withColumn("_cell", salt if first is None else first * SALTS + salt)
    cells = rows.groupBy(group, "_cell").agg(*[F.sum(c).alias(total) for c, total in totals.items()])
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    return rows, cells.withColumns(
        {f"{total}_before": F.coalesce(F.sum(total).over(before), F.lit(0).cast("long")) for total in totals.values()}
    )


def within_cell(group: str, tie: Sequence[str]) -> tuple[Window, Window]:
    """The windows of a cell, in the order of ``tie``: up to the row before, and for ``row_number``."""
    ordered = Window.partitionBy(group, "_cell").orderBy(*tie)
    return ordered.rowsBetween(Window.unboundedPreceding, -1), ordered


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))


def slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``most_bytes`` of text in ``column``; a longer text is a run of its own."""
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
