"""The trigram model of :mod:`lakehist.llm.lm`: numbered words, front-coded runs, sorted arrays that workers map.

A word's number is its place among the sorted hashes of all words (shard after shard), so the word files of the first pass
are the numbering, and n-grams are exact: they hold numbers of two to four bytes, no hashes. The start symbol has the number
after the last. With ``u v w`` a trigram, two more passes follow:

1. **Trigrams**, as sorted runs: equal ones of a task are one row; a blob has the runs of ``v``, the steps of ``u``
   within them, ``w`` and the counts, byte by byte and compressed. They go to the shard of ``v``, which has all contexts ``u v`` and all
   pairs ``v w``. Contexts of a *hot* ``v`` are spread by ``u v``; how many words precede its pairs is then added up in shards by
   ``v w``, in a pass of its own. A context with very many successors is one sorted run of distinct words from each task.
2. **Words**: what follows and precedes each, next to its count.

Files are sorted arrays: of each ``v`` its contexts ``u``, of each context its successors ``w`` with their counts, of each ``v``
its pairs. Numbers lie in two planes (16 bits and the rest). Counts take a byte; larger ones, of whatever size, are in a table
beside them. Sums over successors are stored for contexts of ``LONG`` or more, and taken from the successors otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakehist.llm import lm
from lakehist.llm.words import mixed

#: Successors from which on a context's sums are stored.
LONG = 32
_ODD = np.uint64(0x9E3779B97F4A7C15)
_KINDS = (np.uint8, np.uint16, np.uint32, np.uint64)
#: Sums of a bigram count and of the counts of counts of bigrams and trigrams, then the start symbol's four sums.
_PASSED, _TOTALS = 9, 13


def _fitted(a: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest needs."""
    return a.astype(next(k for k in _KINDS if not len(a) or int(a.max()) <= np.iinfo(k).max))


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Numbers as planes of bytes, compressed."""
    arrays = [_fitted(a) for a in arrays]
    head = np.array([[a.itemsize, len(a)] for a in arrays], "<i8").tobytes()
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    whole = b"".join([len(arrays).to_bytes(8, "little"), head, *planes])
    return len(whole).to_bytes(8, "little") + pa.compress(whole, "zstd", asbytes=True)


def _unsqueezed(data: bytes) -> list[np.ndarray]:
    whole = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    n = int.from_bytes(whole[:8], "little")
    at, out = 8 + 16 * n, []
    for size, length in np.frombuffer(whole, "<i8", 2 * n, 8).reshape(-1, 2).tolist():
        planes = np.frombuffer(whole, np.uint8, size * length, at).reshape(size, length)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{size}").astype(np.int64))
        at += size * length
    return out


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where the rows of sorted columns differ from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _order(*columns: np.ndarray) -> np.ndarray:
    """The order of rows by the first column, then the next; two columns are compared as one where they fit."""
    columns = list(columns)
    top = [int(c.max()) if len(c) else 0 for c in columns]
    while len(columns) > 1 and top[0].bit_length() + top[1].bit_length() < 64:
        bits = top[1].bit_length()
        columns[:2], top[:2] = [columns[0] << bits | columns[1]], [top[0] << bits | top[1]]
    return np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])


def _grouped(columns: list[np.ndarray], *values: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows, sorted, and the sums of each of ``values``."""
    order = _order(*columns)
    columns = [c[order] for c in columns]
    starts = _starts(*columns)
    return [c[starts] for c in columns], [np.add.reduceat(v[order], starts) if len(order) else v[:0] for v in values]


def _runs(first: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    """Two sorted columns as the steps of the first's runs, their lengths, and the steps of the second within them."""
    starts = _starts(first)
    step = np.diff(second, prepend=0)
    step[starts] = second[starts]
    return [np.diff(first[starts], prepend=0), np.diff(np.append(starts, len(first))), step]


def _of_runs(steps: np.ndarray, lengths: np.ndarray, second: np.ndarray) -> list[np.ndarray]:
    sums = np.cumsum(second)
    starts = np.cumsum(lengths) - lengths
    before = sums[starts] - second[starts]
    return [np.repeat(np.cumsum(steps), lengths), sums - np.repeat(before, lengths)]


def _by_shard(kind: int, shard: np.ndarray, columns: list[np.ndarray], squeeze) -> Iterator[tuple]:
    """Blobs of rows that keep their order within a shard."""
    order = np.argsort(shard.astype(_KINDS[1] if not len(shard) or shard.max() < 1 << 16 else np.int64), kind="stable")
    shard, columns = shard[order], [c[order] for c in columns]
    starts = _starts(shard)
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(shard)).tolist()):
        yield int(shard[a]), kind, b - a, squeeze(*(c[a:b] for c in columns))


def _squeezed_trigrams(v: np.ndarray, u: np.ndarray, w: np.ndarray, n: np.ndarray) -> bytes:
    return _squeezed(*_runs(v, u), w, n)


def _squeezed_pairs(v: np.ndarray, w: np.ndarray, n: np.ndarray) -> bytes:
    return _squeezed(*_runs(v, w), n)


def _squeezed_sums(word: np.ndarray, *sums: np.ndarray) -> bytes:
    return _squeezed(np.diff(word, prepend=0), *sums)


def _decoded(table: pa.Table, kind: int, runs: bool, columns: int) -> list[np.ndarray]:
    """The blobs of one kind as whole columns."""
    parts = []
    for k, data in zip(table["kind"].to_pylist(), table["data"]):
        if k == kind:
            a = _unsqueezed(data.as_py())
            parts.append([*_of_runs(*a[:3]), *a[3:]] if runs else [np.cumsum(a[0]), *a[1:]])
    return [np.concatenate(p) for p in zip(*parts)] if parts else [np.zeros(0, np.int64)] * columns


class Places:
    """Which shard has what, and the numbers of words."""

    def __init__(self, model: lm.Model) -> None:
        self.model, self.files = model, {}

    def file(self, name: str, shard: int) -> list[np.ndarray] | None:
        """The arrays of a file, or None where nothing fell into the shard."""
        if (name, shard) not in self.files:
            try:
                self.files[name, shard] = opened(self.model.path, f"{name}-{shard}")
            except FileNotFoundError:
                self.files[name, shard] = None
        return self.files[name, shard]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of sorted hashes, -1 where there is none."""
        out = np.full(len(hashes), -1)
        m = self.model
        bounds = np.searchsorted(lm._shard_of(hashes, m.shards), np.arange(m.shards + 1))
        for s in np.flatnonzero(np.diff(bounds)):
            if ("counts", s) not in self.files:
                try:
                    self.files["counts", s] = lm._get(m.path, f"counts-{s}", ["<u8", "<i8"])[0]
                except FileNotFoundError:
                    self.files["counts", s] = np.zeros(0, np.uint64)
            known, some = self.files["counts", s], slice(bounds[s], bounds[s + 1])
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes[some]), len(known) - 1)
                out[some] = np.where(known[at] == hashes[some], m.bases[s] + at, -1)
        return out

    def of_word(self, number: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.model.bases, number, side="right") - 1

    def hot(self, number: np.ndarray) -> np.ndarray:
        return np.isin(number, self.model.hot_numbers)

    def _spread(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return lm._shard_of(mixed(first.astype(np.uint64) * _ODD + second.astype(np.uint64)), self.model.shards)

    def of_context(self, v: np.ndarray, u: np.ndarray) -> np.ndarray:
        return np.where(self.hot(v), self._spread(v, u), self.of_word(v))

    def of_pair(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.where(self.hot(v), self._spread(v, w), self.of_word(v))


def written(path: str, name: str, arrays: list[np.ndarray]) -> None:
    """Arrays of any lengths and types in one file, each on a multiple of eight bytes."""
    parts = [np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], "<i8").view(np.uint8)]
    for a in arrays:
        own = np.ascontiguousarray(a).view(np.uint8)
        parts += [own, np.zeros(-len(own) % 8, np.uint8)]
    lm._put(path, name, [np.concatenate(parts)])


def opened(path: str, name: str) -> list[np.ndarray]:
    data = np.asarray(lm._get(path, name, ["u1"])[0])  # mapped still, but indexed as a plain array
    n = int(data[:8].view("<i8")[0])
    at, out = 8 + 16 * n, []
    for size, length in data[8:at].view("<i8").reshape(-1, 2).tolist():
        out.append(data[at:at + size * length].view(f"<u{size}"))
        at += size * length + -(size * length) % 8
    return out


def _planes(numbers: np.ndarray) -> list[np.ndarray]:
    return [(numbers & 0xFFFF).astype(np.uint16), _fitted(numbers >> 16)]


def _number(planes: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    return planes[0][at].astype(np.int64) | planes[1][at].astype(np.int64) << 16


def _bytes(counts: np.ndarray) -> list[np.ndarray]:
    """Counts in a byte each, and those of 255 and more by their places."""
    large = np.flatnonzero(counts >= 255)
    return [np.minimum(counts, 255).astype(np.uint8), _fitted(large), _fitted(counts[large])]


def _count(counts: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    out = counts[0][at].astype(np.int64)
    large = np.flatnonzero(out == 255)
    if len(large):
        out[large] = counts[2][np.searchsorted(counts[1], at[large])]
    return out


def _find(planes: list[np.ndarray], low: np.ndarray, high: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """The place of each number in the sorted run from ``low`` to ``high`` of its own, or -1."""
    a, b = low.astype(np.int64), high.astype(np.int64)
    end = b.copy()
    while len(live := np.flatnonzero(a < b)):
        middle = (a[live] + b[live]) >> 1
        less = _number(planes, middle) < sought[live]
        a[live] = np.where(less, middle + 1, a[live])
        b[live] = np.where(less, b[live], middle)
    out = np.full(len(a), -1)
    inside = np.flatnonzero(a < end)
    inside = inside[_number(planes, a[inside]) == sought[inside]]
    out[inside] = a[inside]
    return out


def _kinds_of(n: np.ndarray) -> list[np.ndarray]:
    """What a discount is taken from: ``n`` itself, and whether it is 1, 2 or more."""
    return [n, *(a.astype(np.int64) for a in (n == 1, n == 2, n > 2))]


def _count_trigrams(batches: Iterator[pa.RecordBatch], model: lm.Model) -> Iterator[tuple]:
    places, start = Places(model), model.distinct
    held, many = [], 0

    def out() -> Iterator[tuple]:
        rows, (n,) = _grouped([np.concatenate(c) for c in zip(*held)], np.ones(many, np.int64))
        v, u, w = rows
        shard = places.of_context(v, np.where(v == start, w, u))  # nothing precedes the start: its pairs are spread
        return _by_shard(lm._TRIGRAM, shard, [*rows, n], _squeezed_trigrams)

    for texts in lm._texts(batches):
        token, _, bounds = lm._tokens(texts)
        distinct, at = np.unique(token, return_inverse=True)
        number = places.numbers(distinct)
        if (number < 0).any():
            raise ValueError("the text has words that it did not have when they were counted")
        w = number[at.reshape(-1)]
        v = np.concatenate([[start], w])[:len(w)]
        v[bounds[:-1]] = start
        u = np.concatenate([[start], v])[:len(v)]
        u[bounds[:-1]] = start
        held.append((v, u, w))
        many += len(w)
        if many > lm.HELD:
            yield from out()
            held, many = [], 0
    if many:
        yield from out()


def _put_pairs(places: Places, name: str, shard: int, v: np.ndarray, w: np.ndarray, k: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """Writes whole pairs; what they add to their words, as blobs, and to the sums."""
    starts = _starts(v)
    written(places.model.path, f"{name}-{shard}", [_fitted(v[starts]), _fitted(np.append(starts, len(v))), *_planes(w), *_bytes(k)])
    (first,), sums = _grouped([v], *_kinds_of(k))
    (second,), (kinds,) = _grouped([w], np.ones(len(w), np.int64))
    blobs = [
        *_by_shard(lm._CONTEXT, places.of_word(first), [first, *sums], _squeezed_sums),
        *_by_shard(lm._AFTER, places.of_word(second), [second, kinds], _squeezed_sums),
    ]
    return blobs, np.concatenate([[len(k)], lm._counts_of_counts(k)])


def _merge_trigrams(table: pa.Table, model: lm.Model) -> pa.Table:
    """Writes the contexts of a shard and the pairs that are whole in it; sends the others on."""
    places, shard = Places(model), table["shard"][0].as_py()
    *rows, n = _decoded(table, lm._TRIGRAM, True, 4)
    (v, u, w), (n,) = _grouped(rows, n)
    begins = v == model.distinct
    first = [v[begins], w[begins], n[begins]]
    v, u, w, n = (a[~begins] for a in (v, u, w, n))
    contexts = _starts(v, u)
    ends = np.append(contexts, len(v))
    heads = _starts(v[contexts])
    long = np.flatnonzero(np.diff(ends) >= LONG)
    sums = [np.add.reduceat(a, contexts)[long] if len(contexts) else a[:0] for a in _kinds_of(n)]
    written(model.path, f"contexts-{shard}", [
        _fitted(v[contexts][heads]), _fitted(np.append(heads, len(contexts))), *_planes(u[contexts]), _fitted(ends),
        *_planes(w), *_bytes(n), _fitted(long), *(_fitted(s) for s in sums),
    ])
    stats = lm._counts_of_counts(n)
    (v, w), (k,) = _grouped([v, w], np.ones(len(v), np.int64))
    hot = places.hot(v)
    rows, low = _put_pairs(places, "pairs", shard, v[~hot], w[~hot], k[~hot])
    apart = [np.concatenate(c) for c in zip([v[hot], w[hot], k[hot]], first)]
    rows += _by_shard(lm._PAIR, places.of_pair(*apart[:2]), apart, _squeezed_pairs)
    rows.append((shard, lm._STATS, 1, _squeezed(np.concatenate([low, stats]))))
    return pa.Table.from_batches([lm._batch(rows)])


def _merge_spread(table: pa.Table, model: lm.Model) -> pa.Table:
    """Writes the pairs of hot words; sums of all words pass through."""
    places, shard = Places(model), table["shard"][0].as_py()
    *rows, k = _decoded(table, lm._PAIR, True, 3)
    (v, w), (k,) = _grouped(rows, k)
    rows, low = _put_pairs(places, "spread", shard, v, w, k)
    for kind, columns in ((lm._CONTEXT, 5), (lm._AFTER, 2)):
        word, *sums = _decoded(table, kind, False, columns)
        (word,), sums = _grouped([word], *sums)
        rows += _by_shard(kind, np.full(len(word), shard), [word, *sums], _squeezed_sums)
    passed = _sums(table, _PASSED) + np.concatenate([low, np.zeros(4, np.int64)])
    rows.append((shard, lm._STATS, 1, _squeezed(passed)))
    return pa.Table.from_batches([lm._batch(rows)])


def _sums(table: pa.Table, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for kind, data in zip(table["kind"].to_pylist(), table["data"]):
        if kind == lm._STATS:
            out += _unsqueezed(data.as_py())[0]
    return out


def _merge_words(table: pa.Table, model: lm.Model) -> pa.Table:
    """Writes what scoring asks of each word; the start symbol's sums go to the driver."""
    shard = table["shard"][0].as_py()
    try:
        _, n = lm._get(model.path, f"counts-{shard}", ["<u8", "<i8"])
    except FileNotFoundError:
        n = np.zeros(0, np.int64)
    word, *context = _decoded(table, lm._CONTEXT, False, 5)
    (word,), context = _grouped([word], *context)
    begins = word == model.distinct
    start = [int(c[begins].sum()) for c in context]
    after, kinds = _decoded(table, lm._AFTER, False, 2)
    (after,), (kinds,) = _grouped([after], kinds)
    columns = []
    for at, values in [(after, kinds), *((word[~begins], c[~begins]) for c in context)]:
        column = np.zeros(len(n), np.int64)
        column[at - model.bases[shard]] = values
        columns.append(_fitted(column))
    written(model.path, f"words-{shard}", [_fitted(n), *columns])
    totals = np.concatenate([_sums(table, _PASSED), start, lm._counts_of_counts(kinds)])
    return pa.Table.from_batches([lm._batch([(shard, lm._STATS, 1, _squeezed(totals))])])


def count(texts: DataFrame, model: lm.Model) -> np.ndarray:
    """Write the trigrams of numbered words; the sums of all shards."""
    grams = texts.mapInArrow(lambda b: lm._sent(_count_trigrams(b, model)), lm._BLOB)
    sums = grams.groupBy("shard").applyInArrow(lambda t: _merge_trigrams(t, model), lm._BLOB)
    sums = sums.groupBy("shard").applyInArrow(lambda t: _merge_spread(t, model), lm._BLOB)
    done = sums.groupBy("shard").applyInArrow(lambda t: _merge_words(t, model), lm._BLOB).collect()
    return sum(_unsqueezed(bytes(r["data"]))[0] for r in done)


class Scorer(Places):
    """The arrays of a model in one worker."""

    def _of_words(self, number: np.ndarray) -> list[np.ndarray]:
        """Count, kinds before and the four sums of what follows, 0 for words never seen."""
        out = [np.zeros(len(number), np.int64) for _ in range(6)]
        known = np.flatnonzero(number >= 0)
        shard = self.of_word(number[known])
        starts = _starts(shard)
        for a, b in zip(starts, np.append(starts[1:], len(shard))):
            s = shard[a]
            for column, values in zip(out, self.file("words", s)):
                column[known[a:b]] = values[number[known[a:b]] - self.model.bases[s]]
        return out

    def _within(self, shard: np.ndarray, name: str, sought: np.ndarray) -> Iterator[tuple]:
        """For each file: its arrays, which rows it may have, and the run of their first word in it."""
        order = np.argsort(shard, kind="stable")
        starts = _starts(shard[order])
        for a, b in zip(starts, np.append(starts[1:], len(shard))):
            rows = order[a:b]
            held = self.file(name, shard[rows[0]])
            if held is None or not len(held[0]):
                continue
            at = np.minimum(np.searchsorted(held[0], sought[rows]), len(held[0]) - 1)
            there = held[0][at] == sought[rows]
            rows, at = rows[there], at[there]
            if len(rows):
                yield held, rows, held[1][at], held[1][at + 1]

    def _pairs(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """How many words precede each pair."""
        out = np.zeros(len(v), np.int64)
        known = np.flatnonzero((v >= 0) & (w >= 0))
        hot = self.hot(v[known])
        for name, some in (("pairs", known[~hot]), ("spread", known[hot])):
            for held, rows, low, high in self._within(self.of_pair(v[some], w[some]), name, v[some]):
                own = some[rows]
                at = _find(held[2:4], low, high, w[own])
                seen = at >= 0
                out[own[seen]] = _count(held[4:7], at[seen])
        return out

    def _contexts(self, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Of each context its shard (-1 where it has no successors), where they are, and the sums over them."""
        shard, low, high = np.full(len(v), -1), np.zeros(len(v), np.int64), np.zeros(len(v), np.int64)
        sums = [np.zeros(len(v), np.int64) for _ in range(4)]
        known = np.flatnonzero((u >= 0) & (v >= 0) & (v != self.model.distinct))
        home = self.of_context(v[known], u[known])
        for held, rows, a, b in self._within(home, "contexts", v[known]):
            at = _find(held[2:4], a, b, u[known[rows]])
            rows, at = known[rows[at >= 0]], at[at >= 0]
            shard[rows] = home[np.searchsorted(known, rows)]
            low[rows], high[rows] = held[4][at], held[4][at + 1]
            size = high[rows] - low[rows]
            short = np.flatnonzero(size < LONG)
            if len(short):
                own, size = rows[short], size[short]
                starts = np.cumsum(size) - size
                each = np.repeat(low[own] - starts, size) + np.arange(size.sum())
                for out, values in zip(sums, _kinds_of(_count(held[7:10], each))):
                    out[own] = np.add.reduceat(values, starts)
            own = np.flatnonzero(high[rows] - low[rows] >= LONG)
            stored = np.searchsorted(held[10], at[own])
            for out, values in zip(sums, held[11:15]):
                out[rows[own]] = values[stored]
        return shard, [low, high, *sums]

    def _trigrams(self, shard: np.ndarray, low: np.ndarray, high: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = np.zeros(len(w), np.int64)
        known = np.flatnonzero((shard >= 0) & (w >= 0))
        order = known[np.argsort(shard[known], kind="stable")]
        starts = _starts(shard[order])
        for a, b in zip(starts, np.append(starts[1:], len(order))):
            rows = order[a:b]
            held = self.file("contexts", shard[rows[0]])
            at = _find(held[5:7], low[rows], high[rows], w[rows])
            seen = at >= 0
            out[rows[seen]] = _count(held[7:10], at[seen])
        return out

    def score(self, texts: pa.Array) -> dict[str, np.ndarray]:
        m = self.model
        token, _, bounds = lm._tokens(texts)
        distinct, w = np.unique(token, return_inverse=True)
        w, start = w.reshape(-1), len(distinct)  # words of the slice, and the start symbol behind them
        v = np.concatenate([[start], w])[:len(w)]
        v[bounds[:-1]] = start
        number = self.numbers(distinct)
        n, kinds, *sums = self._of_words(number)
        number = np.append(number, m.distinct)
        total, one, two, more = (np.append(a, b) for a, b in zip(sums, m.start))

        low = np.maximum(kinds - m.low_discounts[np.minimum(kinds, 3)], 0) / max(m.bigram_kinds, 1) + m.low_left / (m.distinct + 1)
        p = low[w]
        key, pair = np.unique(v * (start + 1) + w, return_inverse=True)
        pair = pair.reshape(-1)
        first, second = np.divmod(key, start + 1)
        c = self._pairs(number[first], number[second])[pair]
        left, follows = m.discounts[1] * one + m.discounts[2] * two + m.discounts[3] * more, total[v]
        seen = follows > 0
        p[seen] = (np.maximum(c - m.discounts[np.minimum(c, 3)], 0) + left[v] * p)[seen] / follows[seen]

        # The context of a word is the pair that ends before it; the first of a text has none.
        shard, found = self._contexts(number[first], number[second])
        behind = np.ones(len(w), bool)
        behind[bounds[:-1]] = False
        rows = np.flatnonzero(behind)
        rows = rows[found[2][pair[rows - 1]] > 0]
        context = pair[rows - 1]
        key, three = np.unique(context * (start + 1) + w[rows], return_inverse=True)
        which, third = np.divmod(key, start + 1)
        c = self._trigrams(shard[which], found[0][which], found[1][which], number[third])[three.reshape(-1)]
        follows, one, two, more = (a[context] for a in found[2:])
        left = m.high_discounts[1] * one + m.high_discounts[2] * two + m.high_discounts[3] * more
        p[rows] = (np.maximum(c - m.high_discounts[np.minimum(c, 3)], 0) + left * p[rows]) / follows

        base = np.log10((n + 0.5) / (m.tokens + 0.5 * (m.distinct + 1)))
        starts = bounds[:-1]
        none = len(starts) == 0
        sums = [a[:0] if none else np.add.reduceat(a, starts) for a in ((n > 0)[w].astype(np.int64), base[w], np.log10(p))]
        return {"n_tokens": np.diff(bounds), "n_known": sums[0], "base_score": sums[1], "score": sums[2]}
