"""Spelling variants: near words of a vocabulary by a bit-sliced position index, and the forms they are variants of.

Two words are near if one letter inserted, deleted or replaced makes one the other. For a set of words the index has
a bitset for every position and letter: which words have that letter there. A word is looked up in all of them at once: with
``Z`` the words that agree so far, and ``S``, ``I``, ``D`` those that agree but for a letter replaced, one more, or
one missing, its letter ``c`` at position ``p`` makes::

    S' = (S & B[p, c]) | (Z & ~B[p, c])     I' = (I & B[p + 1, c]) | Z'
    D' = (D & B[p - 1, c]) | Z              Z' =  Z & B[p, c]

64 words at a time, and in numpy many words looked up together.

One index over the whole vocabulary would not be distributed, so words are routed to blocks first. One error leaves the first half
or the second half of a word as it is: words of ``t`` and of ``t + 1`` letters go to the blocks of their first ``t // 2``
and of their last ``t - t // 2`` letters. Near words meet in one of them at least; where both halves meet (they cannot differ in
both) the first half's block counts the link. A half that very many words share is cut into pieces: its words are looked up in
each piece, and indexed in one.

A block sends on how many near words each word has there and the best of them, never the links themselves.

* Null text counts as empty; a null identifier as empty text in the checksum. Repeated rows count as often as they occur. An empty table
  gives no words. Other columns are ignored.
* Ties between near words of one count go to the first in code-point order. ``root`` follows forms to their end; counts grow
  fivefold with each step, so there are few.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehist.llm.common import quoted, stored

#: Letters of a word at least, occurrences at least, and how many times its own count a word's form must have.
LETTERS, LEAST, TIMES = 6, 5, 5
#: A letter of a run is left out where the checksum of identifier and run is a multiple of this.
DAMAGED = 199
#: Rows of a block on average, words indexed at a time and at most for one half, letters indexed at a time, words looked up at a time.
BLOCK, INDEXED, INDEXED_LETTERS, AT_ONCE = 8192, 4096, 1 << 17, 256
#: Distinct words that a task holds before it sends their counts, and characters it reads at a time.
HELD, CHARS = 500_000, 1 << 20

_BREAK = re.compile("[^a-zÀ-ÿ]")
_FOUND = "word string, n_near long, best_n long, best string"


def _chunks(text: str) -> Iterator[str]:
    """Parts of a long text, cut where no run is."""
    at = 0
    while len(text) - at > CHARS:
        cut = _BREAK.search(text, at + CHARS)
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop
    yield text[at:]


def _count(batches: Iterator[pa.RecordBatch], letters: int) -> Iterator[pa.RecordBatch]:
    """Partial counts of words; runs too short to be one are left out at once."""
    runs = re.compile(f"[a-zÀ-ÿ]{{{letters},}}")
    held: Counter[str] = Counter()

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc, raw in zip(batch.column(0), batch.column(1)):
            seed = crc32(doc.as_py().encode() + b":")
            for part in _chunks(raw.as_py().lower().decode("utf-8", "replace")):  # bytes: only A-Z are lowered
                for run, n in Counter(runs.findall(part)).items():
                    h = crc32(run.encode(), seed)
                    if h % DAMAGED == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < letters:
                            continue
                    held[run] += n
            if len(held) > HELD:
                yield out()
                held.clear()
    yield out()


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", letters: int = LETTERS, least: int = LEAST) -> DataFrame:
    """``word, n``: words of enough letters and occurrences, stored."""
    texts = docs.select(
        F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit("")).alias("doc"),
        F.coalesce(F.col(quoted(text_column)).cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    counts = texts.mapInArrow(lambda b: _count(b, letters), "word string, n long")
    return stored(counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), "spelling-words")


class Index:
    """The bitsets of words of ``t`` and of ``t + 1`` letters; ``letters`` has their code points in rows, 0 behind them."""

    def __init__(self, letters: np.ndarray, size: np.ndarray) -> None:
        n, t = letters.shape[0], letters.shape[1] - 1
        self.t, self.words = t, -(-n // 64)
        known = np.unique(letters)
        known = known[known > 0]
        self.code = np.full(256, len(known))  # of letters that no word has: no bits
        self.code[known] = np.arange(len(known))
        self.bits = np.zeros((t + 2, len(known) + 1, self.words), np.uint64)
        for p in range(t + 1):
            self.bits[p, :-1] = self._packed(letters[:, p] == known[:, None])
        self.long = self._packed((size == t + 1)[None])[0]
        self.short = self._packed((size == t)[None])[0]

    def _packed(self, flags: np.ndarray) -> np.ndarray:
        out = np.zeros((len(flags), 8 * self.words), np.uint8)
        packed = np.packbits(flags, axis=1, bitorder="little")
        out[:, :packed.shape[1]] = packed
        return out.view("<u8")

    def near(self, letters: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``letters``, all words of ``size`` letters, and the indexed words near them.

        Words of ``t + 1`` letters are not looked up among each other: they meet where they are the shorter ones.
        """
        codes = self.code[letters[:, :size]]
        none = np.zeros((len(letters), self.words), np.uint64)
        exact, replaced, more, fewer = ~none, none, ~none, none
        for p in range(size):
            here = self.bits[p, codes[:, p]]
            if size > self.t:
                fewer = (fewer & self.bits[p - 1, codes[:, p]] | exact) if p else exact
            else:
                replaced = replaced & here | exact & ~here
            exact = exact & here
            if size == self.t:
                more = more & self.bits[p + 1, codes[:, p]] | exact
        found = fewer & self.short if size > self.t else replaced & self.short | more & self.long
        row, word = np.nonzero(found)
        at, bit = np.nonzero(np.unpackbits(found[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        return row[at], 64 * word[at] + bit


def _ids(values: list) -> np.ndarray:
    numbers: dict = {}
    return np.array([numbers.setdefault(v, len(numbers)) for v in values], np.int64)


def _near(table: pa.Table) -> pa.Table:
    """The near words of a block: how many each row's word has, and the best of them."""
    out: list[tuple] = []
    lengths = np.asarray(table["t"])
    for t in np.unique(lengths).tolist():
        rows = table.filter(pa.array(lengths == t))
        words = rows["word"].to_pylist()
        raw = [w.encode("latin-1") for w in words]
        size, n = np.array([len(w) for w in raw]), np.asarray(rows["n"])
        first, indexed = np.asarray(rows["first"]), np.asarray(rows["indexed"])
        key = _ids(list(zip(rows["first"].to_pylist(), rows["half"].to_pylist(), rows["piece"].to_pylist())))
        half = _ids([w[:t // 2] for w in raw])
        order = sorted(range(len(raw)), key=raw.__getitem__)
        rank = np.empty(len(raw), np.int64)
        rank[order] = np.arange(len(raw))
        links, best_n, best = np.zeros(len(raw), np.int64), np.zeros(len(raw), np.int64), np.full(len(raw), -1)
        step = min(INDEXED, max(1, INDEXED_LETTERS // (t + 1)))

        def letters(at: np.ndarray) -> np.ndarray:
            return np.frombuffer(b"".join(raw[i].ljust(t + 1, b"\0") for i in at), np.uint8).reshape(len(at), t + 1)

        held = np.flatnonzero(indexed)
        for i in range(0, len(held), step):
            own = held[i:i + step]
            index = Index(letters(own), size[own])
            at_once = max(1, min(AT_ONCE, INDEXED_LETTERS // (t + 1)))
            for m in (t, t + 1):
                sought = np.flatnonzero(size == m)
                for j in range(0, len(sought), at_once):
                    some = sought[j:j + at_once]
                    a, b = index.near(letters(some), m)
                    a, b = some[a], own[b]
                    meet = (key[a] == key[b]) & (first[a] | (half[a] != half[b]))
                    a, b = a[meet], b[meet]
                    links += np.bincount(a, minlength=len(raw))
                    order = np.lexsort((rank[b], -n[b], a))
                    a, b = a[order], b[order]
                    top = np.append(True, a[1:] != a[:-1])[:len(a)]
                    a, b = a[top], b[top]
                    better = (n[b] > best_n[a]) | ((n[b] == best_n[a]) & (best[a] >= 0) & (rank[b] < rank[best[a]]))
                    best_n[a[better]], best[a[better]] = n[b[better]], b[better]
        out += [(words[i], int(links[i]), int(best_n[i]), words[best[i]]) for i in np.flatnonzero(links)]
    word, links, best_n, best = zip(*out) if out else ((), (), (), ())
    return pa.table(
        [pa.array(word, pa.string()), pa.array(links, pa.int64()), pa.array(best_n, pa.int64()), pa.array(best, pa.string())],
        names=["word", "n_near", "best_n", "best"])


def nearest(words: DataFrame, letters: int = LETTERS, piece: int = INDEXED, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best`` of those of ``words`` (distinct ``word, n``) that have near words.

    ``letters`` is the least length of a word, ``piece`` the most words indexed for one half at a time.
    """
    blocks = max(1, -(-4 * words.count() // block))
    sized = words.select("word", F.col("n").cast("long").alias("n"), F.length("word").alias("m"))
    sides = sized.where(F.col("m") >= letters).select(
        "word", "n", F.explode(F.expr(f"filter(array(m, m - 1), t -> t >= {letters})")).alias("t"))
    halves = F.expr("array(struct(true AS first, left(word, t div 2) AS half), struct(false AS first, right(word, t - t div 2) AS half))")
    keyed = sides.select("word", "n", "t", F.explode(halves).alias("side")).select("word", "n", "t", "side.first", "side.half")
    key = ["t", "first", "half"]
    shared = keyed.groupBy(*key).count().where(F.col("count") > piece).select(*key, F.ceil(F.col("count") / piece).cast("int").alias("pieces"))
    dealt = (
        keyed.join(shared, key, "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("word"), F.col("pieces")).cast("int"))
        .withColumn("piece", F.explode(F.expr("sequence(0, pieces - 1)")))
        .select(*key, "piece", "word", "n", (F.col("piece") == F.col("own")).alias("indexed"))
        .withColumn("block", F.pmod(F.xxhash64(*key, "piece"), F.lit(blocks)))
    )
    found = dealt.groupBy("block").applyInArrow(_near, _FOUND)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    ).select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def variants(words: DataFrame, letters: int = LETTERS, times: int = TIMES, **sizes: int) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a stored vocabulary (distinct ``word, n``)."""
    told = words.join(nearest(words, letters, **sizes), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        *[F.when(F.col("best_n") >= times * F.col("n"), F.col(c)).alias(name) for c, name in (("best", "form"), ("best_n", "form_n"))],
    )
    told = stored(told, "spelling-forms")
    roots = told.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # Every step multiplies the count, which bounds the steps, and every round doubles those taken.
    least, most = words.agg(F.min("n"), F.max("n")).first()
    steps = 0 if most is None else int(math.log(most / least, times) + 1e-9)
    for _ in range(max(steps - 1, 0).bit_length()):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = stored(roots.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "spelling-roots")
    return told.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings: int) -> DataFrame:
    return variants(vocabulary(docs, id_column, text_column), **settings)
