"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into ``2 ** bits`` levels that keep its order, the levels of a row are its cell, and
cells are visited in the order of the Hilbert curve, so that a run of the curve is compact in every dimension
and a file holds a narrow range of each. Runs are cut where the law says:

* ``rows``: row counts of shards differ by one at most;
* ``bytes``: shards get equal parts of the total size, as far as whole rows allow.

Equal texts lie together, in the first of their cells: the curve is a sequence of distinct texts, each with its rows behind one
another. So one shard has all rows of a text, unless a cut of the law falls between them (one text at most for each cut).

Levels of numbers come from their quantiles, those of strings from the share of rows whose whole value sorts before
theirs. The curve is evaluated once per occupied cell (``2 ** (bits * dimensions)`` at most), and so is the sum of what
lies before it. Texts of a cell and rows of a text are ranked in 256 parts each, by hash, so that a cell or a text
with a third of all rows is the work of 256 tasks. All of it is DataFrame expressions.

:func:`laid_out` sorts the shards into files that are runs of the curve, so that readers prune them by their statistics.

* Null in a dimension is its lowest level. Null text has no bytes and counts as empty; its row counts 8 bytes like any other.
* Rows of a text are ordered by their own cells, then by a hash of identifier and text; equal rows are interchangeable.
* An empty table gives an empty result. Columns beyond those named are carried on request only (``carry``), with underscores in
  front where the result has a column of that name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehist.llm.common import quoted, running_totals, stored, text_or_empty, within_cell

#: What a row weighs besides the bytes of its text.
ROW_BYTES = 8


def _string_splits(rows: DataFrame, dimension: str, levels: int) -> list[str]:
    """The first value of each level above the lowest. Distinct values are ranked in as many tasks as they need."""
    values = rows.where(F.col(dimension).isNotNull()).groupBy(F.col(dimension).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    values = stored(values.repartitionByRange("value").withColumn("part", F.spark_partition_id()), "shard-values")
    parts = values.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy()).alias("total"))
    upto = Window.partitionBy("part").orderBy("value")
    middle = F.col("base") + F.sum("n").over(upto) - F.col("n") / 2
    placed = values.join(parts, "part").select("value", F.floor(middle / F.col("total") * (levels - 1)).alias("level"))
    return sorted(r["value"] for r in placed.groupBy("level").agg(F.min("value").alias("value")).collect())[1:]


def quantised(rows: DataFrame, dimensions: Sequence[str], bits: int) -> DataFrame:
    """Each dimension (a number, a string or null) replaced by its level: 1 + how many of the splits it reaches, 0 for null.
    The splits are at most ``2 ** bits`` values per dimension: quantiles of numbers, and of strings the values with equal shares
    of the rows between them."""
    levels, kinds = 2**bits, dict(rows.dtypes)
    shares = [k / (levels - 1) for k in range(1, levels - 1)]
    numbers = [d for d in dimensions if kinds[d] != "string"]
    found = rows.agg(F.lit(0), *[F.percentile_approx(d, shares, 10_000).alias(d) for d in numbers]).first()
    out = rows
    for d in dimensions:
        if d in numbers:
            above = [F.when(F.col(d) > F.lit(float(s)), 1).otherwise(0) for s in found[d] or []]
        else:
            above = [F.when(F.col(d) >= F.lit(s), 1).otherwise(0) for s in _string_splits(rows, d, levels)]
        level = F.lit(1)
        for step in above:
            level = level + step
        out = out.withColumn(d, F.when(F.col(d).isNull(), 0).otherwise(level).cast("int"))
    return out


def hilbert_index(coordinates: Column, dimensions: int, bits: int) -> Column:
    """Place on the Hilbert curve of an array of ``dimensions`` integers of ``bits`` bits each.

    The usual transposition by exclusive or and exchange, highest bit first, then the Gray code, then the bits
    interleaved; every step is one fold over the array.
    """
    axes = F.sequence(F.lit(0), F.lit(dimensions - 1))

    def flipped(x: Column, bit: Column) -> Column:
        low = bit - 1

        def one_axis(x: Column, i: Column) -> Column:
            here, first = F.get(x, i), F.get(x, F.lit(0))
            swap = (first.bitwiseXOR(here)).bitwiseAND(low)
            inverted = here.bitwiseAND(bit) != 0
            return F.transform(
                x,
                lambda v, j: F.when(inverted, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
                    F.when((j == 0) | (j == i), F.when(i == 0, v).otherwise(v.bitwiseXOR(swap))).otherwise(v)
                ),
            )

        return F.aggregate(axes, x, one_axis)

    highest_first = F.array(*[F.lit(1 << b) for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<int>")
    turned = F.aggregate(highest_first, coordinates, flipped)
    gray = F.transform(
        turned,
        lambda v, j: F.aggregate(F.slice(turned, F.lit(1), j + 1), F.lit(0), lambda a, b: a.bitwiseXOR(b)),
    )
    last = F.element_at(gray, -1)
    fix = F.aggregate(
        highest_first, F.lit(0), lambda t, bit: F.when(last.bitwiseAND(bit) != 0, t.bitwiseXOR(bit - 1)).otherwise(t)
    )
    final = F.transform(gray, lambda v: v.bitwiseXOR(fix))
    planes = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(
        planes,
        F.lit(0).cast("long"),
        lambda h, b: F.aggregate(
            final, h, lambda h, v: h * 2 + F.floor(v / F.pow(F.lit(2), b)).cast("long") % 2
        ),
    )


def hilbert_shards(
    docs: DataFrame,
    shards: int,
    dimensions: Sequence[str] = ("source", "lang", "size"),
    law: str = "rows",
    bits: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the columns of ``carry``, by shard and slot.

    ``dimensions`` are column names; ``size`` is the size of the row, not a column. ``slot`` counts from 0
    without gaps in each shard. ``grown_shard`` is null: neither law moves rows one way when a shard is added.
    """
    if law not in ("rows", "bytes"):
        raise ValueError("law is rows or bytes")
    text = F.col(quoted(text_column)).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES
    kinds = dict(docs.dtypes)
    names = [f"_d{i}" for i in range(len(dimensions))]
    values = [
        F.log2(size) if d == "size" else F.col(quoted(d)).cast("string" if kinds.get(d, "string") == "string" else "double")
        for d in dimensions
    ]
    rows = docs.select(
        F.col(quoted(id_column)).alias("_id"),
        size.alias("_size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("_crc"),
        F.xxhash64(text_or_empty(text_column)).alias("_text"),
        F.xxhash64(F.col(quoted(id_column)), text_or_empty(text_column)).alias("_tie"),
        *[v.alias(n) for v, n in zip(values, names)],
        *[F.col(quoted(c)).alias(f"_c{i}") for i, c in enumerate(carry)],
    )
    rows = quantised(rows, names, bits)
    cell = F.lit(0)
    for n in names:
        cell = cell * 2**bits + F.col(n)
    rows = rows.withColumn("_curve", cell.cast("long")).drop(*names).withColumn("_one", F.lit(1).cast("long"))

    # A row for each text, in the first of its cells.
    texts = rows.groupBy("_text").agg(F.min("_curve").alias("_curve"), F.sum("_one").alias("_tn"), F.sum("_size").alias("_tb"))
    texts, cells = running_totals(texts, "_curve", ["_text"], {"_tn": "_n", "_tb": "_b"})
    # One row per occupied cell of the grid, so one task for the whole curve is bounded by the grid.
    levels = F.array(*[(F.floor(F.col("_curve") / 2 ** (bits * k)) % 2**bits).cast("int") for k in reversed(range(len(names)))])
    grid = cells.groupBy("_curve").agg(F.sum("_n").alias("_gn"), F.sum("_b").alias("_gb"))
    grid = grid.withColumn("_h", hilbert_index(levels, len(names), bits))
    along, everything = Window.orderBy("_h"), Window.partitionBy()
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    grid = grid.select(
        "_curve",
        F.coalesce(F.sum("_gn").over(before), none).alias("_gn_before"),
        F.coalesce(F.sum("_gb").over(before), none).alias("_gb_before"),
        F.sum("_gn").over(everything).alias("_rows"),
        F.sum("_gb").over(everything).alias("_bytes"),
    )
    cells = cells.join(grid, "_curve").select(
        "_curve",
        "_cell",
        (F.col("_n_before") + F.col("_gn_before")).alias("_row0"),
        (F.col("_b_before") + F.col("_gb_before")).alias("_byte0"),
        "_rows",
        "_bytes",
    )
    sums, _ = within_cell("_curve", ["_text"])
    texts = texts.join(cells, ["_curve", "_cell"]).select(
        "_text",
        (F.col("_row0") + F.coalesce(F.sum("_tn").over(sums), none)).alias("_row0"),
        (F.col("_byte0") + F.coalesce(F.sum("_tb").over(sums), none)).alias("_byte0"),
        "_rows",
        "_bytes",
    )
    tie = ["_tie", "_id", "_crc"]
    rows, parts = running_totals(rows, "_text", tie, {"_one": "_n", "_size": "_b"}, first=F.col("_curve"))
    parts = parts.join(texts, "_text").select(
        "_text",
        "_cell",
        (F.col("_row0") + F.col("_n_before")).alias("_row0"),
        (F.col("_byte0") + F.col("_b_before")).alias("_byte0"),
        "_rows",
        "_bytes",
    )
    sums, order = within_cell("_text", tie)
    placed = rows.join(parts, ["_text", "_cell"]).withColumns(
        {
            "_at": F.col("_row0") + F.row_number().over(order) - 1,
            "_from": F.col("_byte0") + F.coalesce(F.sum("_size").over(sums), none),
        }
    )
    if law == "rows":
        shard = F.expr(f"(_at * {shards}) div _rows")
        slot = F.col("_at") - F.expr(f"(shard * _rows + {shards - 1}) div {shards}")
        placed = placed.withColumn("shard", shard.cast("int")).withColumn("slot", slot.cast("long"))
    else:
        placed = placed.withColumn("shard", F.expr(f"least({shards - 1}, (_from * {shards}) div _bytes)").cast("int"))
        firsts = placed.groupBy("shard").agg(F.min("_at").alias("_first"))
        placed = placed.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("_at") - F.col("_first"))
    result = placed.select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.lit(law).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_c{i}") for i in range(len(carry))],
    )
    names = result.columns[: len(result.columns) - len(carry)]
    for c in carry:
        name, taken = c, {n.lower() for n in names}
        while name.lower() in taken:
            name = f"_{name}"
        names.append(name)
    return result.toDF(*names)


def laid_out(rows: DataFrame, files: int | None = None) -> DataFrame:
    """``rows`` in the order of shard and slot, as they are to be written: every file is a run of the curve.

    ``files`` is about how many there are; without it adaptive execution sizes them.
    """
    count = [] if files is None else [files]
    return rows.repartitionByRange(*count, "shard", "slot").sortWithinPartitions("shard", "slot")
