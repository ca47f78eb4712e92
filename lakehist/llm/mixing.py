"""Mixing sources to target weights, in fixed-length blocks of words.

1. The documents of a source, in a pseudorandom order, are one long run of words, cut into blocks of ``block``
   words; the last block of a source may be shorter.
2. Sources share the total by weight. No source gives more than ``most_epochs`` times its size; what that frees
   is reshared among the others by weight (filled up like water: one pass over the sources sorted by cap
   per weight finds the level).
3. A source gets as many slots as its target takes. Slot ``j`` takes block ``p(j mod blocks)`` of the source, where
   ``p`` is a pseudorandom permutation of the source's block numbers, so every epoch runs through all blocks in
   the same shuffled order. The last slot stops in mid-block where the target is reached, so a source's words
   come out exactly at its target, rounded to a word.
4. A second permutation, over all slots of all sources, deals slots to ``shards`` output shards of equal length.
   What a shard then holds of each source is a multinomial draw under the condition that the sources' totals are
   met. Unconditional draws would miss the targets by chance, and exceed the most epochs of a source.
5. Blocks and pieces of documents meet by source and block number. :func:`dealt` has the output itself, a row per
   piece of a slot; :func:`mix` sums it up for each document; :func:`mixed_documents` has whole documents in the slots.

Permutations are swap-or-not shuffles: each round pairs number ``x`` with ``key - x`` and swaps them or not by a
hash of the pair. They work on any range without a table, so a slot finds its block by itself. All of this is
DataFrame expressions. Documents are placed by 256 tasks per source, however large the source is.

* Null and empty texts have no words; they take part with size 0 and nothing is taken. Null is a source.
* Equal rows are interchangeable. An empty table gives an empty result. Further columns are ignored.
* The result depends on the rows and the parameters only, not on their order or the number of tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehist.llm.common import checkpointed, fresh, quoted, running_totals, stored, text_or_empty, within_cell

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating.
CYCLE = (1, 2, 3)
#: Rounds of a shuffle, and slots that one row of the plan expands to.
ROUNDS, SLOTS_PER_ROW = 24, 4096
#: Steps to 1 in which documents that a source's last epoch cuts are told apart.
PARTS = 16
#: Slots that a task expands, as long as that makes no more than so many tasks.
SLOTS_PER_TASK, MOST_TASKS = 1 << 14, 100_000


def permuted(x: Column, n: Column, key: Column, inverse: bool = False) -> Column:
    """``x`` in ``0 .. n - 1`` under the swap-or-not shuffle with ``key``."""
    last = ROUNDS - 1
    steps = F.sequence(F.lit(last), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(last))

    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - x, n)
        pair = F.greatest(x, other)
        return F.when(F.xxhash64(key, r, pair).bitwiseAND(F.lit(1).cast("long")) == 1, other).otherwise(x)

    return F.aggregate(steps, x.cast("long"), step)


def targets(sources: DataFrame, most_epochs: int = 3) -> DataFrame:
    """Adds ``target`` to rows of (``_src``, ``_null``, ``source_size``): one row per source, so one task."""
    in_order, everything = Window.orderBy("_null", "_src"), Window.partitionBy()
    weight = F.lit(CYCLE[0])
    for i, w in enumerate(CYCLE[1:], 1):
        weight = F.when(F.col("_rank") % len(CYCLE) == i, w).otherwise(weight)
    ranked = sources.withColumn("_rank", F.row_number().over(in_order) - 1).withColumn("_weight", weight.cast("double"))
    ranked = ranked.withColumns(
        {"_cap": F.col("source_size") * float(most_epochs), "_total": F.sum("source_size").over(everything).cast("double")}
    )
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    full = F.coalesce(F.sum("_cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    sharing = F.sum("_weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    leveled = ranked.withColumn("_level", (F.col("_total") - full) / sharing)
    holds = F.col("_cap") >= F.col("_level") * F.col("_weight")
    level = F.min_by(F.when(holds, F.col("_level")), F.when(holds, F.struct(F.col("_cap") / F.col("_weight"), "_rank"))).over(everything)
    target = F.least(F.col("_cap"), F.coalesce(level, F.lit(0.0)) * F.col("_weight"))
    return leveled.withColumn("target", target).select("_src", "_null", "source_size", "target")


def mix(
    docs: DataFrame,
    block: int = 256,
    shards: int = 24,
    most_epochs: int = 3,
    seed: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``doc_id, size, source_size, target, taken, first_shard``: how many words the mix takes of each document,
    repeats counted, and the first output shard that holds any of them (null for none)."""
    return _mixed(docs, block, shards, most_epochs, seed, id_column, text_column, source_column).select(
        F.col("_id").alias("doc_id"),
        F.col("_size").alias("size"),
        "source_size",
        "target",
        "taken",
        "first_shard",
    )


def dealt(
    docs: DataFrame,
    block: int = 256,
    shards: int = 24,
    most_epochs: int = 3,
    seed: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """``shard, slot, place, doc_id, first_word, words``: the output shards, in the order of the first three.

    A slot is a block: its pieces are runs of ``words`` words of a document, from its word ``first_word`` (the first is 0),
    and lie at word ``place`` of the block. Slots are numbered through all shards. A document comes once
    for every slot that holds any of its words.
    """
    placed, sources = _placed(docs, block, most_epochs, seed, id_column, text_column, source_column)
    pieces = _pieces(placed.where("_size > 0"), block)
    met = pieces.join(_slots(sources, block, shards, seed).where("_take > 0").hint("merge"), ["_src", "_block"])
    words = F.least(F.col("_b"), F.col("_take")) - F.col("_a")
    return met.where(words > 0).select(
        F.col("_shard").alias("shard"),
        F.col("_deal").alias("slot"),
        F.col("_a").alias("place"),
        F.col("_id").alias("doc_id"),
        (F.col("_block") * block + F.col("_a") - F.col("_from")).alias("first_word"),
        words.alias("words"),
    )


def _placed(
    docs: DataFrame, block: int, most_epochs: int, seed: int, id_column: str, text_column: str, source_column: str
) -> tuple[DataFrame, DataFrame]:
    """Documents with the word of their source's run that they start at, and the sources."""
    source, none = F.col(quoted(source_column)).cast("string"), F.lit(0).cast("long")
    text = text_or_empty(text_column)
    rows = docs.select(
        F.col(quoted(id_column)).alias("_id"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("null")).alias("_src"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("_size"),
        F.xxhash64(F.lit(seed), F.col(quoted(id_column)), text).alias("_tie"),
        F.xxhash64(text).alias("_text"),
    )
    rows = stored(rows, "mix-rows")  # some numbers a document: its words are counted once
    tie = ["_tie", "_id", "_text"]
    rows, cells = running_totals(rows, "_src", tie, {"_size": "_sum"})
    sources = cells.groupBy("_src").agg(F.sum("_sum").alias("source_size"))
    sources = targets(sources.withColumn("_null", F.col("_src") == "null"), most_epochs).drop("_null")
    # Everything below is derived from this table of the sources, so it is computed once.
    sources = checkpointed(
        sources.withColumns(
            {
                "_blocks": F.expr(f"(source_size + {block - 1}) div {block}"),
                "_words": F.round("target").cast("long"),
                "_key": F.xxhash64(F.lit(seed), "_src"),
            }
        )
    )
    sums, order = within_cell("_src", tie)
    cells = cells.join(sources.select("_src", "source_size", "target", "_words"), "_src")
    placed = rows.join(cells.drop("_sum"), ["_src", "_cell"]).withColumns(
        {
            "_from": F.col("_sum_before") + F.coalesce(F.sum("_size").over(sums), none),
            "_nth": F.row_number().over(order),
        }
    )
    return placed, sources


def _pieces(placed: DataFrame, block: int) -> DataFrame:
    """A row for every block that a document has words in; they are its words ``_a`` to ``_b``."""
    none = F.lit(0).cast("long")
    # A document without words has no block; it gets a number that no block has, so that it stays in the join
    # without meeting the others of its kind in one task.
    first = F.when(F.col("_size") > 0, F.expr(f"_from div {block}")).otherwise(-1 - F.pmod(F.col("_tie"), F.lit(1 << 40)))
    until = F.when(F.col("_size") > 0, F.expr(f"(_from + _size - 1) div {block}")).otherwise(first)
    return placed.withColumn("_block", F.explode(F.sequence(first, until))).withColumns(
        {
            "_a": F.greatest(F.col("_from") - F.col("_block") * block, none),
            "_b": F.least(F.col("_from") + F.col("_size") - F.col("_block") * block, F.lit(block).cast("long")),
        }
    )


def _mixed(
    docs: DataFrame, block: int, shards: int, most_epochs: int, seed: int, id_column: str, text_column: str, source_column: str
) -> DataFrame:
    none = F.lit(0).cast("long")
    placed, sources = _placed(docs, block, most_epochs, seed, id_column, text_column, source_column)
    pieces, plan = _pieces(placed, block), _plan(sources, block, shards, seed)
    # The plan has a row per block. It is made from one row per source, so Spark would take it for small and broadcast it.
    met = pieces.join(plan.hint("merge"), ["_src", "_block"], "left")
    stop = F.coalesce(F.col("_stop"), none)
    words = F.col("_times") * (F.col("_b") - F.col("_a")) + F.greatest(F.least(F.col("_b"), stop) - F.col("_a"), none)
    document = ["_src", "_cell", "_nth", "_id", "_tie", "_text", "_size", "source_size", "target"]
    return met.groupBy(*document).agg(
        F.coalesce(F.sum(F.when(F.col("_size") > 0, words)), none).alias("taken"),
        F.min(F.when((F.col("_size") > 0) & (words > 0), F.col("_shard"))).alias("first_shard"),
    )


def _slots(sources: DataFrame, block: int, shards: int, seed: int) -> DataFrame:
    """Every slot: its block, its number among all slots as they are dealt, its output shard, and how many words of the block it takes;
    ``_whole`` where that is an epoch that takes them all."""
    spark = sources.sparkSession
    used = sources.where("_words > 0").withColumns(
        {
            "_short": F.expr(f"source_size - (_blocks - 1) * {block}"),
            "_epochs": F.expr("_words div source_size"),
            "_rest": F.expr("_words % source_size"),
        }
    )
    # In the last, partial epoch the short block comes up at this slot.
    used = used.withColumn("_short_at", permuted(F.col("_blocks") - 1, F.col("_blocks"), F.col("_key"), inverse=True))
    lacking = F.col("_rest") + F.lit(block) - F.col("_short")
    used = used.withColumn("_slots", F.col("_epochs") * F.col("_blocks") + F.least(F.col("_blocks"), F.ceil(lacking / block)))
    used = used.withColumn("_slots", F.when(F.col("_rest") > 0, F.col("_slots")).otherwise(F.col("_epochs") * F.col("_blocks")))
    before = Window.orderBy("_src").rowsBetween(Window.unboundedPreceding, -1)
    used = used.withColumns(
        {
            "_slot0": F.coalesce(F.sum("_slots").over(before), F.lit(0).cast("long")),
            "_all": F.sum("_slots").over(Window.partitionBy()),
        }
    )
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_slots - 1) div {SLOTS_PER_ROW}")))
    # The few rows that stand for all slots look like the work of one task; so many are told to share it.
    total = used.agg(F.sum("_slots")).first()[0] or 0
    tasks = min(MOST_TASKS, max(1, -(-total // SLOTS_PER_TASK)))
    chunks = used.withColumn("_chunk", chunk).repartition(tasks, "_src", "_chunk")
    last = F.least((F.col("_chunk") + 1) * SLOTS_PER_ROW, F.col("_slots")) - 1
    slots = chunks.withColumn("_j", F.explode(F.sequence(F.col("_chunk") * SLOTS_PER_ROW, last)))
    slots = slots.withColumns(
        {
            "_turn": F.col("_j") % F.col("_blocks"),
            "_block": permuted(F.col("_j") % F.col("_blocks"), F.col("_blocks"), F.col("_key")),
            "_deal": permuted(F.col("_slot0") + F.col("_j"), F.col("_all"), F.lit(seed)),
        }
    )
    slots = slots.withColumns(
        {
            "_shard": F.expr(f"(_deal * {shards}) div _all").cast("int"),
            "_whole": F.expr("_j div _blocks") < F.col("_epochs"),
            "_length": F.when(F.col("_turn") == F.col("_short_at"), F.col("_short")).otherwise(F.lit(block).cast("long")),
            "_gone": F.col("_turn") * block
            - F.when(F.col("_short_at") < F.col("_turn"), F.lit(block) - F.col("_short")).otherwise(F.lit(0)),
        }
    )
    taken = F.greatest(F.least(F.col("_rest") - F.col("_gone"), F.col("_length")), F.lit(0).cast("long"))
    return slots.withColumn("_take", F.when(F.col("_whole"), F.col("_length")).otherwise(taken))


def _plan(sources: DataFrame, block: int, shards: int, seed: int) -> DataFrame:
    """For each block that is taken: how many slots take the whole of it, how many words of it the one slot takes
    that does not, and the first output shard it goes to."""
    return _slots(sources, block, shards, seed).groupBy("_src", "_block").agg(
        F.sum(F.when(F.col("_whole"), 1).otherwise(0)).cast("long").alias("_times"),
        F.max(F.when(~F.col("_whole"), F.col("_take"))).alias("_stop"),
        F.min("_shard").alias("_shard"),
    )


def mixed_documents(
    docs: DataFrame,
    block: int = 256,
    shards: int = 24,
    most_epochs: int = 3,
    seed: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The mix as whole documents, in the columns of ``docs``; each source is within one document of its target.

    Documents come with the blocks as they are dealt: once for every epoch of their source that deals words of theirs, in
    the slot that has the first of them. A whole epoch deals all documents. The last one may stop early, and its blocks cut
    documents: those it deals whole come, and of the others about every one with the share of its words that is dealt as its
    chance, long ones as well as short ones, until their words reach what the source still lacks. Rows lie in the order of output
    shard, slot and place, so that files are runs of it.
    """
    found, columns = _dealt_documents(docs, block, shards, most_epochs, seed, id_column, text_column, source_column)
    order = ["_shard", "_deal", "_place"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)


def _shares(placed: DataFrame, sources: DataFrame, block: int, shards: int, seed: int) -> DataFrame:
    """For each document and epoch how many of its words are dealt, and shard, slot and place of the first of them."""
    slots = _slots(sources, block, shards, seed).where("_take > 0").select(
        "_src", "_block", F.expr("_j div _blocks").alias("_epoch"), "_whole", "_rest", "_take", "_shard", "_deal"
    )
    pieces = _pieces(placed.where("_size > 0"), block).select("_src", "_tie", "_id", "_text", "_nth", "_size", "_block", "_a", "_b")
    words = F.least(F.col("_b"), F.col("_take")) - F.col("_a")
    met = pieces.join(slots.hint("merge"), ["_src", "_block"]).withColumn("_dealt", words).where("_dealt > 0")
    # Within an epoch a block has one slot, so the first piece of a document is the one of its lowest block.
    at = F.min(F.struct("_block", "_shard", "_deal", F.col("_a").alias("_place")))
    by = ["_src", "_tie", "_id", "_text", "_nth", "_size", "_epoch", "_whole", "_rest"]
    return met.groupBy(*by).agg(F.sum("_dealt").alias("_dealt"), at.alias("_at")).select(*by, "_dealt", "_at._shard", "_at._deal", "_at._place")


def _rounded(shares: DataFrame) -> DataFrame:
    """The epochs in which documents come: every whole one, and the last by sequential Poisson sampling.

    A document's number is drawn from 0 to 1 and divided by its dealt share; the lowest come first, those that are dealt whole before
    all. As the shares sum up to the words lacked, these are reached where the quotient is about 1.
    """
    tie = ["_tie", "_id", "_text"]
    drawn = shares.where("NOT _whole").withColumn("_drawn", F.pmod(F.xxhash64(F.lit("last"), "_tie", "_nth"), F.lit(1 << 16)))
    quotient = F.least(F.expr(f"_drawn * _size * {PARTS} div (_dealt * {1 << 16})"), F.lit(2 * PARTS))
    first = F.when(F.col("_dealt") == F.col("_size"), 0).otherwise(1 + quotient).cast("int")
    rows, cells = running_totals(drawn, "_src", tie, {"_size": "_sum"}, first)
    sums, _ = within_cell("_src", [*tie, "_nth"])
    before = F.col("_sum_before") + F.coalesce(F.sum("_size").over(sums), F.lit(0).cast("long"))
    last = rows.join(cells.drop("_sum"), ["_src", "_cell"]).withColumn("_before", before).where("2 * _before + _size < 2 * _rest")
    return shares.where("_whole").unionByName(last.select(*shares.columns))


def _dealt_documents(
    docs: DataFrame, block: int, shards: int, most_epochs: int, seed: int, id_column: str, text_column: str, source_column: str
) -> tuple[DataFrame, list[Column]]:
    """A row for every time a document comes, with ``_shard``, ``_deal`` (its slot) and ``_place``; and the columns of ``docs`` in it."""
    placed, sources = _placed(docs, block, most_epochs, seed, id_column, text_column, source_column)
    shares = stored(_shares(placed, sources, block, shards, seed), "mix-shares")
    # Equal rows are numbered on both sides: which of them comes in which slot depends on their other columns only.
    keys = ["_src", "_who", "_tie", "_text"]
    who = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    plan = _rounded(shares).withColumn("_who", who(F.col("_id")))
    plan = plan.withColumn("_same", F.dense_rank().over(Window.partitionBy(*keys).orderBy("_nth"))).select(*keys, "_same", "_shard", "_deal", "_place")

    text, identifier, source = text_or_empty(text_column), F.col(quoted(id_column)), F.col(quoted(source_column))
    row = fresh(docs, "_row")
    named = {c.lower() for c in (id_column, text_column, source_column)}
    others = [F.col(f"{row}.{quoted(c)}") for c in docs.columns if c.lower() not in named]
    keyed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias(row),
        who(source).alias("_src"),
        who(identifier).alias("_who"),
        F.xxhash64(F.lit(seed), identifier, text).alias("_tie"),
        F.xxhash64(text).alias("_text"),
    )
    among = F.to_json(F.struct(*others)) if others else F.lit(0)
    keyed = keyed.withColumn("_same", F.row_number().over(Window.partitionBy(*keys).orderBy(among)))
    found = keyed.join(plan.hint("merge"), [*keys, "_same"])
    return found, [F.col(f"{row}.{quoted(c)}").alias(c) for c in docs.columns]
