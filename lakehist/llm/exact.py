"""Exact duplicates by a tree merge of sorted digest runs.

Every row lies in one of ``fan ** rounds`` runs, by a hash of its identifier. A run is a sorted list of entries
(digest, length, second hash, best identifier, rows). In round ``r`` the ``fan`` runs that differ only in digit
``r`` of their number exchange entries: each keeps those whose digest has its digit there and merges what it
receives with what it has, one entry per digest. After the last round a run holds the whole of its range of
digests and nothing else, so no task ever holds more than one of ``fan ** rounds`` ranges, and a group of
copies, however large, is one entry per run from the start.

Entries are merged only where the byte length and an independent 64-bit hash of the text agree as well: that is
the check that equal digests stand for equal texts, made at every level. The answers go back to the rows by run
and digest, which splits the rows of a hot group by run.

* Null text counts as empty. Texts are compared unchanged, unless the caller hands in normalised text.
* Identifiers are whole numbers; other types are refused. A null one loses against any other; a group without identifiers has
  none to keep.
* Rows that repeat identifier and text are one document written twice: each of them is counted in
  ``group_size`` and each is marked kept, if any is.
* An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from lakehist.llm.common import quoted, text_or_empty

_ENTRY = "run int, digest binary, n_bytes long, twin long, best long, n long"
_KEY = ["digest", "n_bytes", "twin"]


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest", fan: int = 4, rounds: int = 3
) -> DataFrame:
    """One row per document: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``keep`` is ``smallest`` or ``largest``: which identifier of a group stays. ``fan ** rounds`` is the number
    of runs: choose it so that a run of 56-byte entries fits a task.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    if not isinstance(docs.select(quoted(id_column)).schema[0].dataType, IntegralType):
        raise TypeError(f"{id_column} is no whole number: number the documents first, or name a column that does")
    text, runs = text_or_empty(text_column), fan**rounds
    rows = docs.select(
        F.col(quoted(id_column)).cast("long").alias("doc_id"),
        F.pmod(F.xxhash64(F.col(quoted(id_column)).cast("long"), F.lit("run")), F.lit(runs)).cast("int").alias("run"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(text).alias("twin"),
    )
    best = F.max if keep == "largest" else F.min
    leaves = rows.groupBy("run", *_KEY).agg(best("doc_id").alias("best"), F.count(F.lit(1)).alias("n"))
    merged = leaves
    for level in range(rounds):
        merged = _round(merged, level, fan, rounds, keep == "largest")
    answers = leaves.select("run", *_KEY).join(merged.drop("run"), _KEY).withColumnsRenamed({"best": "keep_id", "n": "group_size"})
    return rows.join(answers, ["run", *_KEY]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _round(entries: DataFrame, level: int, fan: int, rounds: int, largest: bool) -> DataFrame:
    """Digit ``level`` of every entry's run becomes that digit of its digest; runs that meet are merged."""
    unit = fan**level
    byte = F.conv(F.hex(F.substring("digest", level + 1, 1)), 16, 10).cast("int")
    digit = F.floor(F.col("run") / unit) % fan
    moved = entries.withColumn("run", (F.col("run") + (byte % fan - digit) * unit).cast("int"))
    gathered = moved.select("run", *_KEY, "best", "n").repartition(fan**rounds, "run").sortWithinPartitions("run", *_KEY)
    return gathered.mapInArrow(lambda batches: _merge(batches, largest), _ENTRY)


def _merge(batches: Iterator[pa.RecordBatch], largest: bool) -> Iterator[pa.RecordBatch]:
    """Neighbours of a sorted stream with equal keys, joined into one; holds a batch and one open entry."""
    worst = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max
    pick = np.maximum if largest else np.minimum
    open_key = np.zeros((0, 7), np.uint64)
    open_best = open_has = open_n = np.zeros(0, np.int64)

    def emit(key: np.ndarray, best: np.ndarray, has: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        digests = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), len(key), [None, pa.py_buffer(np.ascontiguousarray(key[:, 1:5]))])
        return pa.record_batch(
            [
                pa.array(key[:, 0].astype(np.int32)),
                digests.cast(pa.binary()),
                pa.array(key[:, 5].astype(np.int64)),
                pa.array(key[:, 6].astype(np.int64)),
                pa.array(best, mask=has == 0),
                pa.array(n),
            ],
            names=["run", "digest", "n_bytes", "twin", "best", "n"],
        )

    for batch in batches:
        if batch.num_rows == 0:
            continue
        digests = batch.column(1).cast(pa.binary(32))
        key = np.empty((batch.num_rows, 7), np.uint64)
        key[:, 0] = batch.column(0).to_numpy()
        key[:, 1:5] = np.frombuffer(digests.buffers()[1], np.uint64, batch.num_rows * 4, digests.offset * 32).reshape(-1, 4)
        key[:, 5] = batch.column(2).to_numpy().view(np.uint64)
        key[:, 6] = batch.column(3).to_numpy().view(np.uint64)
        has = batch.column(4).is_valid().to_numpy(zero_copy_only=False).astype(np.int64)
        best = np.where(has == 1, batch.column(4).fill_null(0).to_numpy(), worst)
        key = np.concatenate([open_key, key])
        best, has = np.concatenate([open_best, best]), np.concatenate([open_has, has])
        n = np.concatenate([open_n, batch.column(5).to_numpy()])
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        key = key[starts]
        best, has, n = pick.reduceat(best, starts), np.maximum.reduceat(has, starts), np.add.reduceat(n, starts)
        if len(key) > 1:
            yield emit(key[:-1], best[:-1], has[:-1], n[:-1])
        open_key, open_best, open_has, open_n = key[-1:], best[-1:], has[-1:], n[-1:]
    if len(open_key):
        yield emit(open_key, open_best, open_has, open_n)
