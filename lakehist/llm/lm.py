"""Interpolated modified Kneser-Ney model of order 2 or 3, counted by Spark, stored as sorted hash arrays, mapped by workers.

A text is its lower-cased words and one end token; the first word follows a start symbol that is not counted. Words
are 64-bit hashes throughout, and a bigram is one 64-bit hash of its two words.

Counting takes three passes, each with partial sums before its shuffle and hash shards after it:

1. words: their counts, and which of them are *hot* (more than a quarter of an even shard's share of all tokens);
2. bigrams, in shards by their first word, so that a shard knows all that follows a word. The bigrams of
   a hot word are spread over all shards by both words. A shard writes its sorted array of hashes and counts,
   and sends on, for each first word, how much follows it, and for each second word, after how many it comes;
3. those sums, in shards by word, next to the word counts: the second array.

A shard is two or so files of plain sorted arrays in the shared folder. Scoring workers map them into memory, so
the workers of a machine share one copy, only pages that are looked at are read, and no process holds the model. In
a store that cannot be mapped (any pyarrow file system will do) a worker fetches a shard when it first needs it.

With ``c`` the count of a bigram, ``D`` the discount for that count (the usual estimates from the counts of counts),
``N1+`` the number of distinct neighbours and ``V`` the number of distinct tokens::

    p(w | v) = max(c(v w) - D, 0) / c(v *) + back(v) * q(w)
    q(w)     = max(N1+(* w) - D', 0) / N1+(* *) + back' / (V + 1)

where ``back`` is the mass that discounting leaves over. A word never seen gets ``back' / (V + 1)``.

Order 3 puts ``p(w | u v)`` on top, from the counts of trigrams; ``c(v w)`` is then ``N1+(* v w)``, the number of
distinct words before it, but for bigrams of the start symbol, which nothing precedes: they keep their counts. Its passes, and how it
is stored, are in :mod:`lakehist.llm.trigrams`.

* Counts have 64 bits. In files they take less where they fit, and larger ones stand in a table beside them.
* The shared folder must be in a store that pyarrow can open (``file``, ``hdfs``, ``s3``, ``gs``, ``abfss``): others are refused before
  any work is done.
* Null text counts as empty and scores as the end token alone. An empty training set gives the uniform model over
  one token. Repeated rows count as often as they occur; further columns are ignored.
* Files are written under a name of their own and renamed, and their content depends on the counts alone, so a task
  may run twice.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehist.llm.common import quoted, scratch, slices
from lakehist.llm.words import mixed, words

#: Text whose n-grams a shard of the model has, and shards at most (words are dealt by 32 bits of their hashes).
SHARD_BYTES, MOST_SHARDS = 8 << 20, 1 << 16
#: Text that is counted at a time, and distinct entries that a task holds before it sends them on.
SLICE_BYTES, HELD = 4 << 20, 1_500_000

_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_BLOB = "shard int, kind int, rows long, data binary"
#: Kinds of blobs: word counts; bigram counts; what follows a word; what it follows; sums; trigram counts; what precedes a
#: bigram of a hot word.
_WORD, _BIGRAM, _CONTEXT, _AFTER, _STATS, _TRIGRAM, _PAIR = range(7)


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """By the leading bits, so that shards in order are the whole in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _bigram(first: np.ndarray, second: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Hashes of bigrams that lead with 16 bits of the first word's; those of a hot word with bits of both."""
    both = mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)
    led = (mixed(first.copy()) & np.uint64(0xFFFF << 48)) | (both >> np.uint64(16))
    return np.where(np.isin(first, hot), both, led)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every token (words and end) its hash, that of the token before it, and the bounds of the texts."""
    split = words(texts)
    n = len(texts)
    bounds = split.bounds + np.arange(n + 1)
    token = np.full(len(split.hashes) + n, _END, np.uint64)
    token[np.arange(len(split.hashes)) + split.text_of_word()] = split.hashes
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[bounds[:-1]] = _START
    return token, before, bounds


def _summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, sorted, and the sums of each of ``values``."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[starts], *(np.add.reduceat(v[order], starts) if len(keys) else v[:0] for v in values)]


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as bytes, each stretched out; counts take as few bytes as the largest needs."""
    out = []
    for a in arrays:
        if a.dtype != np.uint64:
            a = a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(a) or a.max() <= np.iinfo(t).max))
        out += [bytes([a.dtype.itemsize]), a.tobytes()]
    return b"".join(out)


def _unpacked(data: bytes, rows: int, arrays: int, counts_from: int) -> list[np.ndarray]:
    out, at = [], 0
    for i in range(arrays):
        kind = np.dtype(f"<u{data[at]}")
        a = np.frombuffer(data, kind, rows, at + 1)
        out.append(a if i < counts_from else a.astype(np.int64))
        at += 1 + rows * kind.itemsize
    return out


def _blobs(kind: int, shards: int, shard: np.ndarray, *arrays: np.ndarray) -> Iterator[tuple]:
    """Rows of ``_BLOB`` of sorted arrays; ``shard`` need not be sorted."""
    order = np.argsort(shard, kind="stable")
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if bounds[s] < bounds[s + 1]:
            rows = order[bounds[s]:bounds[s + 1]]
            yield s, kind, len(rows), _packed(*(a[rows] for a in arrays))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    shard, kind, n, data = zip(*rows) if rows else ((), (), (), ())
    return pa.record_batch(
        [pa.array(shard, pa.int32()), pa.array(kind, pa.int32()), pa.array(n, pa.int64()), pa.array(data, pa.binary())],
        names=["shard", "kind", "rows", "data"],
    )


def _sent(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Some blobs per batch, so that a batch is no larger than a few of them."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3])
        if size > 8 << 20:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


@dataclass
class Model:
    """Where the arrays are and the few numbers that belong to all of them."""

    path: str
    shards: int
    tokens: int  # in training, end tokens included
    distinct: int
    hot: np.ndarray
    bigram_kinds: int = 0  # N1+(* *)
    discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    low_discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))
    low_left: float = 1.0  # mass the lower order leaves to words never seen
    order: int = 2
    bases: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # the number of each shard's first word
    hot_numbers: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    start: tuple[int, ...] = (0, 0, 0, 0)  # what follows the start symbol, as of any other word
    high_discounts: np.ndarray = field(default_factory=lambda: np.zeros(4))  # of trigrams


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of the counts 0, 1, 2 and 3 or more, from how many there are of 1 to 4."""
    n1, n2, n3, n4 = (float(c) for c in counts)
    if not n1 or not n2:
        return np.array([0, 0.5, 0.75, 1.0])
    y = n1 / (n1 + 2 * n2)
    found = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return np.clip(np.array(found), 0, [0, 1, 2, 3])


def _counts_of_counts(c: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(c, 5), minlength=6)[1:5]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    try:
        return fs.FileSystem.from_uri(path)
    except pa.ArrowInvalid as unknown:
        raise ValueError(
            f"the model cannot be stored in {path}: pyarrow opens no such store. Set spark.checkpoint.dir to a folder of one "
            "that it opens (file, hdfs, s3, gs, abfss); s3a:// is s3:// there, with credentials of its own"
        ) from unknown


def _put(path: str, name: str, arrays: list[np.ndarray]) -> None:
    store, base = _store(path)
    own = f"{base}/{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(np.array([len(arrays[0])], np.int64).tobytes())
        for a in arrays:
            out.write(a.tobytes())
            out.write(b"\0" * (-a.nbytes % 8))
    try:
        store.move(own, f"{base}/{name}")
    except OSError:  # stores that do not replace: the same task has run before, with the same content
        if store.get_file_info(f"{base}/{name}").type != fs.FileType.File:
            raise
        store.delete_file(own)


def _get(path: str, name: str, kinds: list[str]) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory."""
    store, base = _store(path)
    file = f"{base}/{name}"
    if not isinstance(store, fs.LocalFileSystem):
        # The executor's own folder for files, which Spark provides and removes; a lost executor's successor fetches anew.
        own = os.path.join(SparkFiles.getRootDirectory(), f"lm-{uuid.uuid5(uuid.NAMESPACE_URL, path + name).hex}")
        if not os.path.exists(own):
            with store.open_input_stream(file) as source, open(f"{own}.{os.getpid()}", "wb") as copy:
                while chunk := source.read(1 << 22):
                    copy.write(chunk)
            os.replace(f"{own}.{os.getpid()}", own)
        file = own
    data = np.memmap(file, np.uint8, "r")
    rows, at, out = int(data[:8].view(np.int64)[0]), 8, []
    for kind in kinds:
        size = rows * np.dtype(kind).itemsize
        out.append(data[at:at + size].view(kind))
        at += size + -size % 8
    return out


_BIGRAM_FILE = ["<u8", "<u4"]
#: Bigrams of this count and more have it in a file of their own.
_LARGE, _LARGE_FILE = 2**32 - 1, ["<u8", "<u8"]
#: Word, count, kinds of words before it, tokens after it, and of the words after it those seen 1, 2, 3 or more times.
_WORD_FILE = ["<u8"] * 7


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    for batch in batches:
        for part in slices(batch, 0, SLICE_BYTES):
            yield part.column(0)


def _count_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[tuple]:
    held = [np.zeros(0, np.uint64), np.zeros(0, np.int64)]
    for texts in _texts(batches):
        token, _, _ = _tokens(texts)
        seen = np.unique(token, return_counts=True)
        held = _summed(np.concatenate([held[0], seen[0]]), np.concatenate([held[1], seen[1]]))
        if len(held[0]) > HELD:
            yield from _blobs(_WORD, shards, _shard_of(held[0], shards), *held)
            held = [a[:0] for a in held]
    yield from _blobs(_WORD, shards, _shard_of(held[0], shards), *held)


def _count_bigrams(batches: Iterator[pa.RecordBatch], shards: int, hot: np.ndarray) -> Iterator[tuple]:
    held = [np.zeros(0, np.uint64)] * 3 + [np.zeros(0, np.int64)]  # bigram, its words, count

    def out() -> Iterator[tuple]:
        return _blobs(_BIGRAM, shards, _shard_of(held[0], shards), held[1], held[2], held[3])

    for texts in _texts(batches):
        token, before, _ = _tokens(texts)
        key, at, n = np.unique(_bigram(before, token, hot), return_index=True, return_counts=True)
        key = np.concatenate([held[0], key])
        first, second = np.concatenate([held[1], before[at]]), np.concatenate([held[2], token[at]])
        n = np.concatenate([held[3], n])
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(key) else order
        rows = order[starts]
        held = [key[rows], first[rows], second[rows], np.add.reduceat(n[order], starts) if len(key) else n]
        if len(key) > HELD:
            yield from out()
            held = [a[:0] for a in held]
    yield from out()


def _joined(table: pa.Table, kind: int, arrays: int, hashes: int) -> list[np.ndarray]:
    """The blobs of one kind, each array in one piece."""
    kinds, rows, data = table["kind"].to_pylist(), table["rows"].to_pylist(), table["data"]
    parts = [_unpacked(data[i].as_py(), rows[i], arrays, hashes) for i in range(len(kinds)) if kinds[i] == kind]
    if not parts:
        return [np.zeros(0, np.uint64 if i < hashes else np.int64) for i in range(arrays)]
    return [np.concatenate(p) for p in zip(*parts)]


def _merge_words(table: pa.Table, path: str, shards: int) -> pa.Table:
    shard = table["shard"][0].as_py()
    word, n = _summed(*_joined(table, _WORD, 2, 1))
    _put(path, f"counts-{shard}", [word, n])
    top = np.flatnonzero(64 * n >= n.sum())  # 64 at most; they hold what is hot unless the shard has 16 times its share
    return pa.Table.from_batches([_batch([
        (shard, _STATS, len(word), _packed(np.array([n.sum()]))), (shard, _WORD, len(top), _packed(word[top], n[top], top)),
    ])])


def _merge_bigrams(table: pa.Table, path: str, shards: int, hot: np.ndarray) -> pa.Table:
    shard = table["shard"][0].as_py()
    first, second, n = _joined(table, _BIGRAM, 3, 2)
    key = _bigram(first, second, hot)
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    first, second, n = first[order][starts], second[order][starts], np.add.reduceat(n[order], starts)
    _put(path, f"bigrams-{shard}", [key[starts], np.minimum(n, _LARGE).astype(np.uint32)])
    large = n >= _LARGE
    if large.any():
        _put(path, f"large-{shard}", [key[starts][large], n[large].astype(np.uint64)])
    context = _summed(first, n, (n == 1).astype(np.int64), (n == 2).astype(np.int64), (n > 2).astype(np.int64))
    after = _summed(second, np.ones(len(n), np.int64))
    rows = [
        *_blobs(_CONTEXT, shards, _shard_of(context[0], shards), *context),
        *_blobs(_AFTER, shards, _shard_of(after[0], shards), *after),
        (shard, _STATS, 5, _packed(np.concatenate([[len(n)], _counts_of_counts(n)]))),
    ]
    return pa.Table.from_batches([_batch(rows)])


def _sums(table: pa.Table, n: int) -> np.ndarray:
    stats = np.zeros(n, np.int64)
    for kind, rows, data in zip(table["kind"].to_pylist(), table["rows"].to_pylist(), table["data"]):
        if kind == _STATS:
            stats += _unpacked(data.as_py(), rows, 1, 0)[0].astype(np.int64)
    return stats


def _merge_sums(table: pa.Table, path: str, shards: int) -> pa.Table:
    shard = table["shard"][0].as_py()
    context, total, one, two, more = _summed(*_joined(table, _CONTEXT, 5, 1))
    after, kinds = _summed(*_joined(table, _AFTER, 2, 1))
    # Every word has a count, but for the start symbol, which only precedes.
    try:
        counted, n = _get(path, f"counts-{shard}", ["<u8", "<i8"])
    except FileNotFoundError:
        counted, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = np.union1d(counted, context)
    columns = []
    for keys, values in [(counted, n), (after, kinds), (context, total), (context, one), (context, two), (context, more)]:
        column = np.zeros(len(word), np.int64)
        column[np.searchsorted(word, keys)] = values
        columns.append(column)
    _put(path, f"words-{shard}", [word, *(c.astype(k) for c, k in zip(columns, _WORD_FILE[1:]))])
    stats = _sums(table, 5)
    row = (shard, _STATS, 9, _packed(np.concatenate([stats, _counts_of_counts(kinds)])))
    return pa.Table.from_batches([_batch([row])])


def _shards_for(docs: DataFrame, text_column: str) -> int:
    size = docs.agg(F.sum(F.octet_length(F.col(quoted(text_column)).cast("string")).cast("long"))).first()[0] or 0
    return min(MOST_SHARDS, max(1, -(-size // SHARD_BYTES)))


def train(docs: DataFrame, text_column: str = "text", shards: int | None = None, order: int = 2) -> Model:
    """Count ``docs`` and write the model to the shared folder; it stays there for whoever scores with it."""
    if order not in (2, 3):
        raise ValueError(f"order {order}: only 2 and 3 are built")
    path = scratch(docs.sparkSession, "lm")
    store, base = _store(path)
    store.create_dir(base)
    shards = shards or _shards_for(docs, text_column)
    texts = docs.select(F.col(quoted(text_column)).cast("string").alias("text"))

    counted = texts.mapInArrow(lambda b: _sent(_count_words(b, shards)), _BLOB)
    stats = counted.groupBy("shard").applyInArrow(lambda t: _merge_words(t, path, shards), _BLOB).collect()
    tokens = sum(int(_unpacked(r["data"], 1, 1, 0)[0][0]) for r in stats if r["kind"] == _STATS)
    sizes = np.zeros(shards, np.int64)
    for r in stats:
        if r["kind"] == _STATS:
            sizes[r["shard"]] = r["rows"]
    distinct, bases = int(sizes.sum()), np.cumsum(sizes) - sizes
    tops = [(r["shard"], _unpacked(r["data"], r["rows"], 3, 1)) for r in stats if r["kind"] == _WORD]
    hot = [w[n > tokens / (4 * shards)] for _, (w, n, _) in tops]
    numbers = [bases[s] + at[n > tokens / (4 * shards)] for s, (_, n, at) in tops]
    # As many texts as end tokens follow the start symbol.
    hot = np.unique(np.concatenate([*hot, [_START]])).astype(np.uint64)
    numbers = np.unique(np.concatenate([*numbers, [distinct]])).astype(np.int64)
    model = Model(path, shards, tokens, distinct, hot, order=order, bases=bases, hot_numbers=numbers)
    if not tokens:
        return model

    if order == 3:
        from lakehist.llm import trigrams  # builds on this module

        totals = trigrams.count(texts, model)
        model.high_discounts, model.start = _discounts(totals[5:9]), tuple(int(t) for t in totals[9:13])
    else:
        grams = texts.mapInArrow(lambda b: _sent(_count_bigrams(b, shards, hot)), _BLOB)
        sums = grams.groupBy("shard").applyInArrow(lambda t: _merge_bigrams(t, path, shards, hot), _BLOB)
        done = sums.groupBy("shard").applyInArrow(lambda t: _merge_sums(t, path, shards), _BLOB).collect()
        totals = sum(_unpacked(r["data"], r["rows"], 1, 0)[0].astype(np.int64) for r in done)
    model.bigram_kinds = int(totals[0])
    model.discounts, model.low_discounts = _discounts(totals[1:5]), _discounts(totals[-4:])
    # The words' kinds sum to N1+(* *); what discounting takes from them goes to all words alike.
    n1, n2 = int(totals[-4]), int(totals[-3])
    rest = distinct - n1 - n2
    d = model.low_discounts
    model.low_left = float((d[1] * n1 + d[2] * n2 + d[3] * rest) / model.bigram_kinds)
    return model


class Scorer:
    """The arrays of a model in one worker."""

    def __init__(self, model: Model) -> None:
        self.model, self.files = model, {}

    def _file(self, name: str, shard: int) -> list[np.ndarray] | None:
        if (name, shard) not in self.files:
            try:
                kinds = {"words": _WORD_FILE, "large": _LARGE_FILE}.get(name, _BIGRAM_FILE)
                self.files[name, shard] = _get(self.model.path, f"{name}-{shard}", kinds)
            except FileNotFoundError:  # no entry fell into this shard
                self.files[name, shard] = None
        return self.files[name, shard]

    def _find(self, name: str, sought: np.ndarray, columns: int) -> list[np.ndarray]:
        """The values of sorted hashes, 0 where there is none."""
        out = [np.zeros(len(sought), np.int64) for _ in range(columns)]
        bounds = np.searchsorted(_shard_of(sought, self.model.shards), np.arange(self.model.shards + 1))
        for s in range(self.model.shards):
            a, b = bounds[s], bounds[s + 1]
            if a == b or (held := self._file(name, s)) is None or not len(held[0]):
                continue
            at = np.minimum(np.searchsorted(held[0], sought[a:b]), len(held[0]) - 1)
            same = held[0][at] == sought[a:b]
            for column, values in zip(out, held[1:]):
                column[a:b][same] = values[at[same]]
        return out

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        m = self.model
        token, before, bounds = _tokens(texts)
        vocabulary, which = np.unique(np.concatenate([token, [_START]]), return_inverse=True)
        which = which.reshape(-1)
        is_start = which[-1]
        w = which[:-1]
        v = np.empty_like(w)
        v[1:] = w[:-1]
        v[bounds[:-1]] = is_start
        n, kinds, total, one, two, more = self._find("words", vocabulary, 6)
        low = np.maximum(kinds - m.low_discounts[np.minimum(kinds, 3)], 0) / max(m.bigram_kinds, 1) + m.low_left / (m.distinct + 1)
        left = m.discounts[1] * one + m.discounts[2] * two + m.discounts[3] * more

        key = _bigram(before, token, m.hot)
        order = np.argsort(key, kind="stable")
        c = np.empty(len(key), np.int64)
        (found,) = self._find("bigrams", key[order], 1)
        large = np.flatnonzero(found == _LARGE)
        if len(large):
            (found[large],) = self._find("large", key[order][large], 1)
        c[order] = found
        follows = total[v]
        seen = follows > 0
        p = low[w]
        p[seen] = (np.maximum(c - m.discounts[np.minimum(c, 3)], 0) + left[v] * p)[seen] / follows[seen]
        base = np.log10((n + 0.5) / (m.tokens + 0.5 * (m.distinct + 1)))
        starts = bounds[:-1]
        none = len(starts) == 0
        sums = [a[:0] if none else np.add.reduceat(a, starts) for a in ((n > 0)[w].astype(np.int64), base[w], np.log10(p))]
        return {"n_tokens": np.diff(bounds), "n_known": sums[0], "base_score": sums[1], "score": sums[2]}


def scored(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score``; perplexity is ``10 ** (-score / n_tokens)``."""
    chosen = docs.select(F.col(quoted(id_column)).alias("doc_id"), F.col(quoted(text_column)).cast("string").alias("text"))
    schema = f"doc_id {dict(chosen.dtypes)['doc_id']}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    held = docs.sparkSession.sparkContext.broadcast(model)
    if model.order == 3:
        from lakehist.llm.trigrams import Scorer as scorer_of
    else:
        scorer_of = Scorer

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(held.value)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                found = scorer.score(part.column(1))
                n = pa.array(np.full(part.num_rows, held.value.tokens, np.int64))
                columns = [found["n_tokens"], found["n_known"], n, found["base_score"], found["score"]]
                yield pa.record_batch(
                    [part.column(0), *(pa.array(c) for c in columns)],
                    names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return chosen.mapInArrow(score, schema)


def held_out(id_column: str = "doc_id") -> Column:
    """``crc32`` of the identifier as text (null: empty), modulo 5, is 1."""
    return F.crc32(F.coalesce(F.col(quoted(id_column)).cast("string"), F.lit(""))) % 5 == 1
