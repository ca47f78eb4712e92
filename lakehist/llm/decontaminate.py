"""Benchmark passages in training text, found with suffix arrays of the training text.

The corpus is indexed in shards: runs of documents with at most ``shard_bytes`` of text. In a shard the words are
numbered by the vocabulary of the benchmark (0: not in it), and the suffixes that begin with enough words
of that vocabulary are sorted by their first ``window`` words: a suffix array to the depth that a window needs. Every
suffix of every benchmark item is then searched in it by bisection for its first ``window`` words (an
item shorter than that is searched as a whole). All occurrences come out as one range of the array. From
there they are locations: the words they cover are marked, those that overlap form passages, and the items they
belong to are listed per document. Where there are occurrences, suffixes of the text and of the items are sorted
together to their full depth; what one has in common with the nearest item suffix on either side is its longest
verbatim match. No pairs of places are listed for it, so a passage that text and benchmark repeat costs its length.

The benchmark is a set of queries. Spark deals its distinct items to blocks of about ``block_bytes`` of text, and a task for each
block writes it, indexed, to the shared folder; the driver sees their numbers only. Scanning tasks map the blocks one after the
other and match each against their shard, so none holds more than one, whatever the size of the benchmark. No document is
shuffled, so a passage in a third of all documents costs the tasks that read them and no other.

* Null and empty texts have no words and no hits; such items have no window. A null item identifier marks words
  but is not listed as an item.
* ``longest`` is the longest match that stands as it is in one item, the first of several as long; null without hits.
* Repeated items count once per identifier; repeated documents are each judged. Empty tables give no rows, or rows
  without hits.
* Columns of the documents are kept as they are; results come in one struct column with a name of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from lakehist.llm import lm
from lakehist.llm.common import fresh, place_of, quoted, scratch, slices
from lakehist.llm.trigrams import opened, written
from lakehist.llm.words import ALNUM, words

_FOUND = (
    StructType()
    .add("n_words", LongType())
    .add("n_hit", LongType())
    .add("items", ArrayType(StringType()))
    .add("passages", ArrayType(StructType().add("first_word", LongType()).add("n_words", LongType())))
    .add("longest", StructType().add("first_word", LongType()).add("n_words", LongType()))
)
_PASSAGE = pa.struct([("first_word", pa.int64()), ("n_words", pa.int64())])


@dataclass(eq=False)
class Block:
    """A part of the benchmark: its vocabulary and its distinct windows, by length."""

    vocabulary: np.ndarray  # sorted hashes; a word's number is its place plus 1
    windows: dict[int, np.ndarray]  # length -> distinct windows as rows of word numbers
    owners: dict[int, tuple[np.ndarray, np.ndarray]]  # length -> (bounds, items) of each window
    runs: np.ndarray  # windows of full length as they follow each other, as places plus 1, a 0 behind each item
    items: Sequence[str | None]

    @property
    def shortest(self) -> int:
        return min(self.windows, default=0)


def block_of(items: list[tuple[object, str | None]], window: int) -> Block:
    split = words(pa.array([text for _, text in items], pa.string()), ALNUM)
    vocabulary, numbers = np.unique(split.hashes, return_inverse=True)
    numbers = numbers.reshape(-1) + 1
    found: dict[int, list[tuple[np.ndarray, int]]] = {}
    for i in range(len(items)):
        own = numbers[split.bounds[i]:split.bounds[i + 1]]
        if len(own) >= window:
            rows = np.lib.stride_tricks.sliding_window_view(own, window)
            found.setdefault(window, []).append((rows, i))
        elif len(own):
            found.setdefault(len(own), []).append((own[None, :], i))
    windows, owners, runs = {}, {}, np.zeros(0, np.int64)
    for length, parts in found.items():
        distinct, which = np.unique(np.concatenate([rows for rows, _ in parts]), axis=0, return_inverse=True)
        owner = np.concatenate([np.full(len(rows), i) for rows, i in parts])
        if length == window:
            runs = np.insert(which.reshape(-1) + 1, np.cumsum([len(rows) for rows, _ in parts]), 0)
        pairs = np.unique(np.stack([which.reshape(-1), owner], axis=1), axis=0)
        windows[length] = distinct
        owners[length] = (np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1])
    return Block(vocabulary, windows, owners, runs, [None if i is None else str(i) for i, _ in items])


class SuffixArray:
    """Suffixes of a sequence of word numbers below ``base``, sorted by their first ``depth`` words.

    As many numbers as fit are packed into one 64-bit key, so that comparing keys compares runs of words.
    """

    def __init__(self, numbers: np.ndarray, base: int, depth: int, shortest: int) -> None:
        self.bits = max(1, int(base - 1).bit_length())
        self.per_key = 63 // self.bits
        self.depth, self.n_keys = depth, -(-depth // self.per_key)
        padded = np.concatenate([numbers, np.zeros(self.n_keys * self.per_key, np.int64)])
        known = numbers > 0
        runs = np.cumsum(np.concatenate([[0], known]))
        at = np.flatnonzero(known[: max(0, len(known) - shortest + 1)])
        at = at[runs[at + shortest] - runs[at] == shortest]
        keys = [self._packed([padded[at + k * self.per_key + j] for j in range(self.per_key)], k) for k in range(self.n_keys)]
        order = np.lexsort(keys[::-1])
        self.positions, self.keys = at[order], [k[order] for k in keys]

    def _packed(self, parts: list[np.ndarray], key: int) -> np.ndarray:
        out = np.zeros(len(parts[0]), np.int64)
        for j, part in enumerate(parts):
            out <<= self.bits
            if key * self.per_key + j < self.depth:
                out |= part
        return out

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row of ``patterns`` the range of suffixes that begin with it, by bisection."""
        n, length = patterns.shape
        low, high = np.zeros(n, np.int64), np.full(n, len(self.positions))
        full = np.int64(2**self.bits - 1)
        for k in range(self.n_keys):
            first = k * self.per_key
            if first >= length:
                break
            part = [patterns[:, j] if j < length else None for j in range(first, first + self.per_key)]
            least = self._packed([np.zeros(n, np.int64) if p is None else p for p in part], k)
            most = self._packed([np.full(n, full) if p is None else p for p in part], k)
            if k == 0:
                low, high = np.searchsorted(self.keys[0], least, "left"), np.searchsorted(self.keys[0], most, "right")
                continue
            for i in np.flatnonzero(high > low):
                own = self.keys[k][low[i]:high[i]]
                low[i], high[i] = low[i] + np.searchsorted(own, least[i], "left"), low[i] + np.searchsorted(own, most[i], "right")
        return low, high


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and for each the number of its range."""
    sizes = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(low)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes), which


def longest_matches(own: np.ndarray, others: np.ndarray) -> np.ndarray:
    """For each place of ``own`` how long a run from there stands in ``others`` too. Runs end at 0.

    Suffixes of both are ranked together by doubling; the ranks of every round are kept, so that the common
    prefix of two suffixes is found in as many steps as there were rounds.
    """
    both = np.concatenate([own, [0], others, [0]])
    place, zeros = np.arange(len(both)), np.flatnonzero(both == 0)
    left = zeros[np.searchsorted(zeros, place)] - place
    ranks = [np.unique(both, return_inverse=True)[1].reshape(-1)]
    while (size := 1 << (len(ranks) - 1)) < left.max():
        beyond = np.where(left > size, ranks[-1][np.minimum(place + size, len(both) - 1)], 0)
        ranks.append(np.unique(ranks[-1] * (ranks[-1].max() + 1) + beyond, return_inverse=True)[1].reshape(-1))
    order = np.argsort(ranks[-1], kind="stable")
    other, nth = order > len(own), np.arange(len(order))
    before = np.maximum.accumulate(np.where(other, nth, 0))
    after = np.minimum.accumulate(np.where(other, nth, len(nth) - 1)[::-1])[::-1]
    asked = np.flatnonzero(order < len(own))
    found = np.zeros(len(own), np.int64)
    for nearest in (before, after):
        p, q = order[asked], order[nearest[asked]]
        common = np.zeros(len(p), np.int64)
        for k in reversed(range(len(ranks))):
            a, b = np.minimum(p + common, len(both) - 1), np.minimum(q + common, len(both) - 1)
            same = (left[a] >= 1 << k) & (left[b] >= 1 << k) & (ranks[k][a] == ranks[k][b])
            common += np.where(same, 1 << k, 0)
        found[p] = np.maximum(found[p], np.where(q > len(own), common, 0))
    return found


def _match_lengths(found: np.ndarray, which: np.ndarray, block: Block, window: int) -> np.ndarray:
    """Words of the longest match from each of the places ``found`` of windows ``which`` of full length."""
    order = np.argsort(found)
    place, own = found[order], which[order] + 1
    gaps = np.flatnonzero(np.diff(place) != 1) + 1
    there = np.zeros(len(block.windows[window]) + 1, bool)
    there[own] = True
    others = np.where(there[block.runs], block.runs, 0)
    others = others[(others > 0) | np.concatenate([[False], others[:-1] > 0])]
    lengths = longest_matches(np.insert(own, gaps, 0), others)
    out = np.empty(len(found), np.int64)
    out[order] = np.delete(lengths, gaps + np.arange(len(gaps))) + window - 1
    return out


def _scan(texts: pa.Array, blocks: list, window: int) -> pa.Array:
    """The results for one shard."""
    split = words(texts, ALNUM)
    n, counts = len(texts), split.counts
    # One unknown word between documents, so that no window reaches over.
    starts = split.bounds[:-1] + np.arange(n)
    place = np.arange(len(split.hashes)) + split.text_of_word()
    cover = np.zeros(len(split.hashes) + n + 1, np.int64)
    listed: list[tuple[int, str]] = []
    longest, longest_at = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for held in blocks:
        block: Block = held.value
        if not block.windows or not len(split.hashes):
            continue
        at = np.searchsorted(block.vocabulary, split.hashes)
        at[at == len(block.vocabulary)] = 0
        numbers = np.zeros(len(split.hashes) + n, np.int64)
        numbers[place] = np.where(block.vocabulary[at] == split.hashes, at + 1, 0)
        array = SuffixArray(numbers, len(block.vocabulary) + 1, window, block.shortest)
        if not len(array.positions):
            continue
        pairs = []
        for length, patterns in block.windows.items():
            ranks, which = _expand(*array.search(patterns))
            found = array.positions[ranks]
            np.add.at(cover, found, 1)
            np.add.at(cover, found + length, -1)
            bounds, owners = block.owners[length]
            in_text = np.searchsorted(starts, found, "right") - 1
            if len(found):
                sizes = _match_lengths(found, which, block, window) if length == window else np.full(len(found), length)
                order = np.lexsort((found, -sizes, in_text))
                best = order[np.unique(in_text[order], return_index=True)[1]]
                text, size, at = in_text[best], sizes[best], found[best]
                better = (size > longest[text]) | ((size == longest[text]) & (at < longest_at[text]))
                longest[text[better]], longest_at[text[better]] = size[better], at[better]
            seen = np.unique(in_text * np.int64(len(patterns)) + which)
            in_text, which = seen // len(patterns), seen % len(patterns)
            owner, of = _expand(bounds[which], bounds[which + 1])
            pairs.append(np.unique(in_text[of] * np.int64(len(block.items)) + owners[owner]))
        for pair in np.unique(np.concatenate(pairs)).tolist():
            if (item := block.items[pair % len(block.items)]) is not None:
                listed.append((pair // len(block.items), item))
    hit = np.cumsum(cover[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    n_hit = total[starts + counts] - total[starts]

    edges = np.diff(np.concatenate([[0], hit, [0]]).astype(np.int8))
    begins, stops = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    owner = np.searchsorted(starts, begins, "right") - 1
    passages = pa.StructArray.from_arrays([pa.array(begins - starts[owner]), pa.array(stops - begins)], fields=list(_PASSAGE))
    passage_bounds = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)

    listed = sorted(set(listed))
    item_bounds = np.searchsorted([t for t, _ in listed], np.arange(n + 1)).astype(np.int32)
    return pa.StructArray.from_arrays(
        [
            pa.array(counts.astype(np.int64)),
            pa.array(n_hit.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(item_bounds), pa.array([i for _, i in listed], pa.string())),
            pa.ListArray.from_arrays(pa.array(passage_bounds), passages),
            pa.StructArray.from_arrays(
                [pa.array(longest_at - starts), pa.array(longest)], fields=list(_PASSAGE), mask=pa.array(longest == 0)
            ),
        ],
        names=["n_words", "n_hit", "items", "passages", "longest"],
    )


class Names:
    """Strings or nulls in two arrays."""

    def __init__(self, bounds: np.ndarray, known: np.ndarray, raw: np.ndarray) -> None:
        self.bounds, self.known, self.raw = bounds, known, raw

    def __len__(self) -> int:
        return len(self.known)

    def __getitem__(self, i: int) -> str | None:
        return self.raw[self.bounds[i]:self.bounds[i + 1]].tobytes().decode() if self.known[i] else None


def _arrays(block: Block) -> list[np.ndarray]:
    """A block as it is stored: names and all that has one length, then the windows of each length."""
    names = [(i or "").encode() for i in block.items]
    bounds = np.concatenate([[0], np.cumsum([len(n) for n in names])]).astype(np.int64)
    known = np.array([i is not None for i in block.items], np.uint8)
    out = [block.vocabulary, block.runs, bounds, known, np.frombuffer(b"".join(names), np.uint8), np.array(list(block.windows), np.int64)]
    for length, windows in block.windows.items():
        out += [windows.reshape(-1).astype(np.int64), *(a.astype(np.int64) for a in block.owners[length])]
    return out


@dataclass
class StoredBlock:
    """A block in the shared folder; every look at ``value`` maps it anew."""

    path: str
    number: int

    @property
    def value(self) -> Block:
        vocabulary, runs, bounds, known, raw, lengths, *rest = opened(self.path, f"block-{self.number}")
        windows, owners = {}, {}
        for i, length in enumerate(lengths.tolist()):
            own = [a.view(np.int64) for a in rest[3 * i:3 * i + 3]]
            windows[length], owners[length] = own[0].reshape(-1, length), (own[1], own[2])
        return Block(vocabulary, windows, owners, runs.view(np.int64), Names(bounds.view(np.int64), known, raw))


def stored_blocks(benchmark: DataFrame, item_column: str, text_column: str, window: int, block_bytes: int) -> list[StoredBlock]:
    """The benchmark in blocks, each made and written by a task; there are as many as its size asks for."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.col(quoted(item_column)).cast("string").alias("item"), F.col(quoted(text_column)).cast("string").alias("text")
    ).where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks, path = max(1, -(-size // block_bytes)), scratch(spark, "benchmark")
    store, base = lm._store(path)
    store.create_dir(base)

    def write(table: pa.Table) -> pa.Table:
        number = table["block"][0].as_py()
        written(path, f"block-{number}", _arrays(block_of(list(zip(table["item"].to_pylist(), table["text"].to_pylist())), window)))
        return pa.table({"number": [number]})

    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    numbers = dealt.groupBy("block").applyInArrow(write, "number long").collect()
    return [StoredBlock(path, n) for n in sorted(r["number"] for r in numbers)]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_column: str = "text",
    item_column: str = "item_id",
    benchmark_text: str = "text",
    shard_bytes: int = 8 << 20,
    block_bytes: int = 8 << 20,
    name: str = "contamination",
) -> DataFrame:
    """``docs`` with one more column ``name`` (underscores in front if the name is taken): a struct of ``n_words``,
    ``n_hit``, ``items`` (identifiers as strings, sorted), ``passages`` (runs of matched words) and ``longest``."""
    column = fresh(docs, name)
    blocks = stored_blocks(benchmark, item_column, benchmark_text, window, block_bytes)
    at = place_of(docs, text_column)
    schema = StructType([*docs.schema.fields]).add(column, _FOUND)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in slices(batch, at, shard_bytes):
                found = _scan(shard.column(at), blocks, window)
                yield pa.record_batch([*shard.columns, found], names=[*shard.schema.names, column])

    return docs.mapInArrow(scanned, schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **parameters) -> DataFrame:
    """The documents without a matched word, in the columns of ``docs``."""
    found = contamination(docs, benchmark, **parameters)
    column = found.columns[-1]
    return found.where(F.col(f"{quoted(column)}.n_hit") == 0).drop(column)
