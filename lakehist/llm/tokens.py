"""Token counts that follow edits: segment trees over pre-tokens, of which an edit re-encodes what it touches.

A text is cut into leaves of about ``LEAF_BYTES`` at places where the tokeniser's pre-tokens end whatever
stands further away: before a single space and behind a single line feed that stand between other characters, and where a letter,
a number or another sign is followed by one of another of these three kinds (but not a letter by an apostrophe before it). That holds
in every script. So a leaf has the same tokens alone as in its text, and counts add up. Characters whose kind changed between
versions of Unicode, and white space but for those two, are next to no cut. A document keeps where its leaves begin and a
segment tree of their counts (heap order: node ``i`` has children ``2 i`` and ``2 i + 1``, the root is the total).

An edit replaces ``drop`` bytes at ``at`` by ``put``. Touched are the leaves it overlaps, and the next one on a side where
it comes within ``CONTEXT`` bytes of a cut, since those bytes are what makes the cut safe. Only they are cut and encoded anew;
their counts go up the tree along their paths, or, where their number changed, into a tree rebuilt by adding.

* Null text counts as empty and has no tokens. Null or empty edits change nothing. Edits of one document refer to its
  text before any of them, in any order; overlapping ones or ones out of range are an error.
* A text without a safe cut, however long, is one leaf. Repeated rows are counted alike; an empty table stays
  empty. Columns of the documents are kept, results come in columns with names of their own.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from lakehist.llm.common import fresh, place_of, slices

#: The vocabulary, on every machine. Its pre-token pattern is a fixed value that comes with it.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF_BYTES, SLICE_BYTES = 256, 8 << 20
#: Bytes on either side of a cut that decide whether it is safe: a space and a character.
CONTEXT = 5

EDITS = ArrayType(StructType().add("at", LongType()).add("drop", LongType()).add("put", StringType()))
_ARROW_EDITS = pa.list_(pa.struct([("at", pa.int64()), ("drop", pa.int64()), ("put", pa.string())]))
_TREE = StructType().add("n_tokens", LongType()).add("starts", ArrayType(LongType())).add("sums", ArrayType(LongType()))
_ARROW_TREE = pa.struct([("n_tokens", pa.int64()), ("starts", pa.list_(pa.int64())), ("sums", pa.list_(pa.int64()))])

#: Numbers of five digits or more, and addresses.
REDACTED = re.compile(rb"[0-9]{5,}|[A-Za-z0-9._-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


@lru_cache(maxsize=2)
def counter(vocabulary: str) -> Callable[[bytes], int]:
    """The number of tokens of some bytes."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda data: len(encoding.encode_ordinary(data.decode("utf-8")))


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Of each code point: 1 for letters, 2 for numbers, 3 for other signs; 0 for white space, controls, those beyond the table and
    those of which the oldest and the newest Unicode at hand say different things."""
    found = [
        np.array([{"L": 1, "N": 2, "Z": 0, "C": 0}.get(of(chr(c))[0], 3) for c in range(0x20000)], np.uint8)
        for of in (unicodedata.category, unicodedata.ucd_3_2_0.category)
    ]
    return np.where(found[0] == found[1], found[0], 0).astype(np.uint8)


def leaf_starts(data: bytes) -> np.ndarray:
    """Where leaves begin: 0, and in each stretch of ``LEAF_BYTES`` the first safe cut."""
    if not data:
        return np.zeros(0, np.int64)
    points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), "<u4")
    table = kinds()
    kind = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 0)
    known = kind > 0
    cut = np.zeros(len(points), bool)  # before each character
    cut[1:] = known[1:] & known[:-1] & (kind[1:] != kind[:-1]) & ~((points[:-1] == ord("'")) & (kind[1:] == 1))
    between = known[:-2] & known[2:]
    cut[1:-1] |= between & (points[1:-1] == ord(" "))
    cut[2:] |= between & (points[1:-1] == ord("\n"))
    size = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    cuts = (np.cumsum(size) - size)[cut]
    _, first = np.unique(cuts // LEAF_BYTES, return_index=True)
    cuts = cuts[first]
    # A cut at the start of one stretch may follow closely on the one before; that leaf is small, and right.
    return np.concatenate([[0], cuts[cuts > 0]]).astype(np.int64)


def leaf_counts(data: bytes, starts: np.ndarray, count: Callable[[bytes], int]) -> np.ndarray:
    ends = [*starts[1:].tolist(), len(data)]
    return np.fromiter((count(data[a:b]) for a, b in zip(starts.tolist(), ends)), np.int64, len(starts))


def tree_of(counts: np.ndarray) -> np.ndarray:
    """Sums in heap order; leaf ``i`` is node ``width + i``, where ``width`` is a power of two."""
    width = 1 << max(0, int(len(counts) - 1).bit_length()) if len(counts) else 0
    sums = np.zeros(2 * width, np.int64)
    sums[width:width + len(counts)] = counts
    while width > 1:
        half = width // 2
        sums[half:width] = sums[width:2 * width].reshape(-1, 2).sum(axis=1)
        width = half
    return sums


def total(sums: np.ndarray) -> int:
    return int(sums[1]) if len(sums) > 1 else 0


class Document:
    """The bytes of a text, its leaves and their sums."""

    def __init__(self, data: bytes, starts: np.ndarray, sums: np.ndarray) -> None:
        self.data, self.starts, self.sums = data, np.asarray(starts, np.int64), np.array(sums, np.int64)
        self.encoded = 0  # leaves that edits have encoded anew

    @classmethod
    def read(cls, data: bytes, count: Callable[[bytes], int]) -> Document:
        starts = leaf_starts(data)
        return cls(data, starts, tree_of(leaf_counts(data, starts, count)))

    def edit(self, edits: list[tuple[int, int, bytes]], count: Callable[[bytes], int]) -> None:
        """Apply edits, from the last to the first, so that positions before them hold."""
        until = len(self.data)
        for at, drop, put in sorted(edits, key=lambda e: (e[0], e[1]), reverse=True):
            if at < 0 or drop < 0 or at + drop > until:
                raise ValueError(f"edit at {at} overlaps the next one or lies outside of the text")
            until = at
            self._replace(at, drop, put, count)

    def _replace(self, at: int, drop: int, put: bytes, count: Callable[[bytes], int]) -> None:
        starts, n = self.starts, len(self.starts)
        width = len(self.sums) // 2
        first = max(0, int(np.searchsorted(starts, at - CONTEXT, "right")) - 1)
        last = int(np.searchsorted(starts, at + drop + CONTEXT, "left"))  # one past the last touched leaf
        begin, end = (int(starts[first]) if n else 0), (int(starts[last]) if last < n else len(self.data))
        region = self.data[begin:at] + put + self.data[at + drop:end]
        own = leaf_starts(region)
        counts = leaf_counts(region, own, count)
        self.encoded += len(own)
        self.data = self.data[:begin] + region + self.data[end:]
        moved = starts[last:] + (len(put) - drop)
        self.starts = np.concatenate([starts[:first], own + begin, moved])
        if len(own) != last - first:
            self.sums = tree_of(np.concatenate([self.sums[width:width + first], counts, self.sums[width + last:width + n]]))
            return
        self.sums[width + first:width + last] = counts
        low, high = width + first, width + last - 1
        while low > 1 and high >= low:
            low, high = low // 2, high // 2
            for node in range(low, high + 1):
                self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]


def _bytes(texts: pa.Array) -> list[bytes]:
    return [b if b is not None else b"" for b in texts.cast(pa.binary()).to_pylist()]


def counted(docs: DataFrame, text_column: str = "text", vocabulary: str = VOCABULARY, name: str = "tokens") -> DataFrame:
    """``docs`` with a struct of ``n_tokens`` and the segment tree: ``starts`` of the leaves, ``sums``."""
    column, at = fresh(docs, name), place_of(docs, text_column)

    def count_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            for part in slices(batch, at, SLICE_BYTES):
                held = [Document.read(data, count) for data in _bytes(part.column(at))]
                trees = [{"n_tokens": total(d.sums), "starts": d.starts, "sums": d.sums} for d in held]
                yield pa.record_batch([*part.columns, pa.array(trees, _ARROW_TREE)], names=[*part.schema.names, column])

    return docs.mapInArrow(count_all, StructType([*docs.schema.fields]).add(column, _TREE))


def recounted(
    docs: DataFrame,
    tree_column: str = "tokens",
    edits_column: str = "edits",
    text_column: str = "text",
    vocabulary: str = VOCABULARY,
    name: str = "edited",
) -> DataFrame:
    """``docs`` (with trees from :func:`counted` and a column of type ``EDITS``) plus a struct of the state after the
    edits: ``text``, ``n_tokens``, ``starts``, ``sums``, and ``leaves_encoded``, how many leaves it took."""
    column = fresh(docs, name)
    at, tree_at, edits_at = (place_of(docs, c) for c in (text_column, tree_column, edits_column))
    kind = StructType().add("text", StringType()).add("leaves_encoded", LongType())
    arrow_kind = pa.struct([("text", pa.string()), ("leaves_encoded", pa.int64()), *_ARROW_TREE])
    for f in _TREE:
        kind = kind.add(f)

    def edit_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            for part in slices(batch, at, SLICE_BYTES):
                trees, out = part.column(tree_at), []
                for i, (data, edits) in enumerate(zip(_bytes(part.column(at)), part.column(edits_at).to_pylist())):
                    tree = trees[i]
                    d = Document(data, tree["starts"].values.to_numpy(), tree["sums"].values.to_numpy())
                    d.edit([(e["at"], e["drop"], (e["put"] or "").encode()) for e in edits or ()], count)
                    out.append({"text": d.data.decode(), "leaves_encoded": d.encoded, "n_tokens": total(d.sums), "starts": d.starts, "sums": d.sums})
                yield pa.record_batch([*part.columns, pa.array(out, arrow_kind)], names=[*part.schema.names, column])

    return docs.mapInArrow(edit_all, StructType([*docs.schema.fields]).add(column, kind))


def redactions(docs: DataFrame, text_column: str = "text", put: str = "0", name: str = "edits") -> DataFrame:
    """``docs`` with the edits that replace long numbers and addresses by ``put``."""
    column, at = fresh(docs, name), place_of(docs, text_column)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"at": m.start(), "drop": m.end() - m.start(), "put": put} for m in REDACTED.finditer(data)]
                for data in _bytes(batch.column(at))
            ]
            yield pa.record_batch([*batch.columns, pa.array(found, _ARROW_EDITS)], names=[*batch.schema.names, column])

    return docs.mapInArrow(find, StructType([*docs.schema.fields]).add(column, EDITS))

