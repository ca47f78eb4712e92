"""Phrase collocations: suffix pointers sorted by a multikey three-way quicksort to the depth of the longest phrase.

Everything is per language: a word is a 64-bit hash of the lower-cased word and its language (two words with one
hash end the run with an error). Three steps:

1. **Words.** Their counts, with partial sums; and how many suffixes begin with each bucket of word pairs and of triples.
2. **Routing.** A suffix is the next ``LONGEST`` words of its piece. Equal suffixes of a task are one row with a count. Suffixes
   go to shards by their two leading words, so that a shard has all that begins with a pair. Those of a *hot* bucket of
   pairs (more than a quarter of an even shard) go by three words instead, those of a hot bucket of triples by all
   four; what is then counted in several shards is added up afterwards.
3. **Sorting.** A shard partitions its suffix pointers by word into less, equal and greater (all segments of a round
   at once); the equal ones go on with the next word, and their number is the count of the phrase. Segments of fewer than
   ``least`` suffixes hold no phrase and are abandoned.

The frequent phrases are scored by joins: each cut of a candidate meets the counts of its two sides. A phrase one word longer is
the only one that need be looked at to drop a candidate, since what is longer still is no more frequent.

* Pieces end at ``.,;:!?`` and line ends, words at spaces and tabs; only A-Z are lower-cased.
* Null text counts as empty, null language as ``und`` (with that language's texts). Repeated rows count as often as they occur.
* Scores are integers computed in decimals of 38 digits. Ties of scores go to the larger count, then to the phrase's bytes.
* An empty table, or one without frequent phrases, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakehist.llm.common import quoted, slices, stored
from lakehist.llm.words import mixed, words

#: Words of the longest phrase, and what a phrase must occur to be one.
LONGEST, LEAST = 4, 30
#: A candidate goes if a longer one has this percentage of its occurrences.
ABSORBED = 80
#: Rows of each language's report.
BEST = 2000
#: Text whose suffixes a shard sorts on average. A suffix takes some 60 bytes while it is sorted.
SHARD_BYTES = 8 << 20
#: Tasks that sort shards at most, whatever the session says of shuffles.
MOST_TASKS = 50_000
#: Text whose suffixes a task routes at a time, and whose words it counts at a time.
SLICE_BYTES, COUNTED_BYTES = 4 << 20, 1 << 20
#: Words that a task holds before it sends their counts, and their bytes; rows that it sends at a time.
HELD_WORDS, HELD_BYTES, ROWS_SENT = 300_000, 32 << 20, 50_000
#: Blobs that a task sends at a time: the JVM beside it holds them outside its heap.
SENT_BYTES = 2 << 20
#: Parts in which a language's candidates are ranked before the whole.
SALTS = 64

_BREAKS = np.isin(np.arange(256), [10, 11, 12, 13, *b".,;:!?"])
_ENDS = _BREAKS | np.isin(np.arange(256), [9, 32])
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]
_KINDS = "kind int, lang string, word string, h long, n long"


def _bits(size: int) -> np.uint64:
    return np.uint64(64 - (size.bit_length() - 1))


def _chained(*columns: np.ndarray) -> np.ndarray:
    """A hash of several words in order."""
    out = mixed(columns[0] * _ODD)
    for c in columns[1:]:
        out = mixed(out * _ODD + c)
    return out


class Tokens:
    """The words of a slice of texts with the pieces they lie in."""

    def __init__(self, langs: pa.Array, texts: pa.Array) -> None:
        self.split = words(texts, _ENDS)
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        seeds = [int.from_bytes(hashlib.blake2b(l.encode(), digest_size=8).digest(), "little") for l in self.langs]
        owner = self.split.text_of_word()
        self.lang = np.asarray(coded.indices, np.int32)[owner]
        word = self.split.hashes * _ODD
        if len(owner):
            word += np.array(seeds, np.uint64)[self.lang]
        self.word = np.maximum(mixed(word), np.uint64(1))  # 0 stands for no word
        breaks = np.flatnonzero(_BREAKS[self.split.raw])
        self.piece = np.searchsorted(breaks, self.split.starts) + owner  # grows from text to text and from break to break

    def texts(self, at: np.ndarray) -> pa.Array:
        """The words at ``at``, which ascends."""
        # Every other value lies between two of the words.
        offsets = np.append(np.stack([self.split.starts[at], self.split.ends[at]], axis=1).reshape(-1), len(self.split.raw))
        values = pa.Array.from_buffers(pa.large_binary(), 2 * len(at), [None, pa.py_buffer(offsets), pa.py_buffer(self.split.raw)])
        taken = values.take(pa.array(np.arange(0, 2 * len(at), 2)))
        try:
            return taken.cast(pa.large_string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8
            return pa.array([w.decode("utf-8", "replace") for w in taken.to_pylist()], pa.large_string())

    def suffixes(self) -> list[np.ndarray]:
        """Columns of the words from each word on, 0 behind the end of the piece; suffixes of two words and more, which begin at
        ``self.at``."""
        self.at = np.flatnonzero(self.piece[1:] == self.piece[:-1])
        own, columns = self.piece[self.at], [self.word[self.at], self.word[self.at + 1]]
        for k in range(2, LONGEST):
            behind = np.minimum(self.at + k, len(self.word) - 1)
            inside = (self.at + k == behind) & (self.piece[behind] == own)
            columns.append(np.where(inside, self.word[behind], np.uint64(0)))
        return columns


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Tokens]:
    for batch in batches:
        for part in slices(batch, 1, size):
            yield Tokens(part.column(0), part.column(1))


def _count_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: words; of kinds 2 and 3: how many suffixes begin with pairs and triples of a bucket."""
    held: list[pa.Table] = []
    hot = np.zeros((2, buckets), np.int64)
    for tokens in _slices(batches, COUNTED_BYTES):
        word, first, n = np.unique(tokens.word, return_index=True, return_counts=True)
        order = np.argsort(first)
        at = first[order]
        langs = pa.array(tokens.langs, pa.string()).take(pa.array(tokens.lang[at]))
        held.append(pa.table([langs, tokens.texts(at), pa.array(word[order].view(np.int64)), pa.array(n[order])], names=_COUNTED))
        suffix = tokens.suffixes()
        for d in (2, 3):
            hot[d - 2] += np.bincount((_chained(*suffix[:d]) >> _bits(buckets)).astype(np.int64), minlength=buckets)
        del tokens, suffix
        if sum(len(t) for t in held) > HELD_WORDS or sum(t.nbytes for t in held) > HELD_BYTES:
            held = [_summed(held)]
            if len(held[0]) > HELD_WORDS // 2 or held[0].nbytes > HELD_BYTES // 2:
                yield from _word_rows(held.pop())
    if held:
        yield from _word_rows(_summed(held))
    for d in (2, 3):
        at = np.flatnonzero(hot[d - 2])
        none = pa.nulls(len(at), pa.string())
        yield pa.record_batch([pa.array(np.full(len(at), d, np.int32)), none, none, pa.array(at), pa.array(hot[d - 2][at])], schema=_SCHEMA)


_SCHEMA = pa.schema([("kind", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("h", pa.int64()), ("n", pa.int64())])
_COUNTED = ["lang", "word", "h", "n"]


def _summed(counts: list[pa.Table]) -> pa.Table:
    """One row for each word."""
    rows = pa.concat_tables(counts)
    h = np.asarray(rows["h"])
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.append(True, h[order[1:]] != h[order[:-1]])[:len(order)])
    one = rows.take(pa.array(order[starts]))
    return one.set_column(3, "n", pa.array(np.add.reduceat(np.asarray(rows["n"])[order], starts) if len(order) else h))


def _word_rows(counts: pa.Table) -> Iterator[pa.RecordBatch]:
    rows = counts.add_column(0, "kind", pa.array(np.zeros(len(counts), np.int32)))
    yield from rows.cast(_SCHEMA).combine_chunks().to_batches(max_chunksize=ROWS_SENT)


def _paths(columns: list[np.ndarray], hot: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix by how many leading words less two it is routed, and the hash of those words."""
    bits = _bits(len(hot[0]))
    pair, triple = _chained(*columns[:2]), _chained(*columns[:3])
    by = hot[0][(pair >> bits).astype(np.int64)].astype(np.int64)
    by[by > 0] += hot[1][(triple[by > 0] >> bits).astype(np.int64)]
    return by, np.choose(by, [pair, triple, _chained(*columns)])


def _pack(a: np.ndarray) -> bytes:
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if not len(a) or a.max() <= np.iinfo(t).max)
    return bytes([np.dtype(kind).itemsize]) + a.astype(kind).tobytes()


def _route(batches: Iterator[pa.RecordBatch], shards: int, hot: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Blobs of the distinct suffixes of a slice, one for each shard that has any; words are places in a list of the blob's own."""
    for tokens in _slices(batches, SLICE_BYTES):
        yield from _blobs(_shard_blobs(*_distinct(tokens, shards, hot)))


def _distinct(tokens: Tokens, shards: int, hot: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The words of a slice, and of its distinct suffixes, sorted by shard: the shard, by what they are routed, how often they
    occur, and the places of their words. Arrays of a number for every word are let go as soon as may be."""
    columns = tokens.suffixes()
    del tokens.split, tokens.piece, tokens.lang
    path = _chained(*columns)
    order = np.argsort(path)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in (path, *columns):
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    del path, c
    starts = np.flatnonzero(new)
    at, n = order[starts], np.diff(np.append(starts, len(order)))
    del order, new, starts
    for k in range(LONGEST):
        columns[k] = columns[k][at]
    by, path = _paths(columns, hot)
    shard = ((path >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)
    del path
    there = [c > 0 for c in columns]
    del columns[:]
    # Every word of a suffix is one of the slice: the suffix's first is looked up, the others stand behind it.
    known, place = np.unique(tokens.word, return_inverse=True)
    place = np.append(place.reshape(-1).astype(np.int32) + 1, np.zeros(LONGEST, np.int32))
    at = tokens.at[at]
    del tokens.word, tokens.at
    known = np.concatenate([[np.uint64(0)], known])
    order = np.argsort(shard * np.int64(len(known)) + place[at], kind="stable")
    at = at[order]
    places = np.empty((LONGEST, len(at)), np.int32)
    for k in range(LONGEST):
        places[k] = np.where(there[k][order], place[at + k], 0)
    return known, shard[order], by[order].astype(np.int8), n[order].astype(np.int32), places


def _shard_blobs(known: np.ndarray, shard: np.ndarray, by: np.ndarray, n: np.ndarray, places: np.ndarray) -> Iterator[tuple]:
    """``shard, rows, data`` of suffixes sorted by shard, whose words are ``places`` in ``known``."""
    starts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])[:len(shard)])
    used = np.zeros(len(known), bool)
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(shard)).tolist()):
        few = places[:, a:b]
        if 64 * few.size < len(known):
            own, inner = np.unique(few, return_inverse=True)
            inner = inner.reshape(LONGEST, -1)
        else:
            used[few] = True
            own = np.flatnonzero(used)
            inner = (np.cumsum(used, dtype=np.int32) - 1)[few]
            used[own] = False
        data = len(own).to_bytes(8, "little") + known[own].tobytes() + b"".join(_pack(c) for c in (*inner, by[a:b], n[a:b]))
        yield int(shard[a]), b - a, data


def _blobs(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size > SENT_BYTES:
            yield _blob_batch(held)
            held, size = [], 0
    if held:
        yield _blob_batch(held)


def _blob_batch(rows: list[tuple]) -> pa.RecordBatch:
    shard, n, data = zip(*rows)
    return pa.record_batch([pa.array(shard, pa.int32()), pa.array(n, pa.int64()), pa.array(data, pa.binary())], names=["shard", "rows", "data"])


def _unblob(data: pa.Buffer, rows: int) -> tuple[np.ndarray, list[np.ndarray]]:
    size = int(np.frombuffer(data, "<u8", 1)[0])
    known, at, out = np.frombuffer(data, np.uint64, size, 8), 8 + 8 * size, []
    for _ in range(LONGEST + 2):
        kind = np.dtype(f"<u{np.frombuffer(data, np.uint8, 1, at)[0]}")
        out.append(np.frombuffer(data, kind, rows, at + 1))
        at += 1 + rows * kind.itemsize
    return known, out


def multikey_quicksort(keys: np.ndarray, n: np.ndarray, least: list[int], seed: int = 12) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Phrases of the suffixes ``keys[:, i]`` that occur ``n[i]`` times: their length, one of their suffixes each, their counts.

    Key 0 is the end of a suffix. ``least[d]`` is the least count of a phrase of ``d + 1`` words; a segment below it is
    abandoned. Each round takes every segment by its own pivot into less, equal and greater.
    """
    pointer = np.random.default_rng(seed).permutation(np.arange(keys.shape[1], dtype=np.int32))
    size, depth = np.array([keys.shape[1]]), np.zeros(1, np.int64)
    floor = np.array(least, np.int64)
    size, depth = size[size > 0], depth[size > 0]
    while len(size):
        segment = np.repeat(np.arange(len(size), dtype=np.int32), size)
        key = keys[depth.astype(np.int8)[segment], pointer]
        start = np.cumsum(size) - size
        three = key[np.stack([start, start + size // 2, start + size - 1])]
        pivot = np.sort(three, axis=0)[1]
        own = pivot[segment]
        del segment
        parts = []
        for which, compare in enumerate((np.less, np.equal, np.greater)):
            mask = compare(key, own)
            sizes = np.add.reduceat(mask, start, dtype=np.int64)
            there = sizes > 0
            sizes, deep = sizes[there], depth[there]
            chosen = pointer[mask]
            begin = np.cumsum(sizes) - sizes
            total = np.add.reduceat(n[chosen], begin, dtype=np.int64) if len(chosen) else np.zeros(0, np.int64)
            going = total >= floor[deep]
            if which == 1:
                going &= pivot[there] > 0
                for d in range(1, keys.shape[0]):
                    found = going & (deep == d)
                    if found.any():
                        yield d + 1, chosen[begin[found]], total[found]
                deep = deep + 1
                going &= deep < keys.shape[0]
            parts.append((chosen[np.repeat(going, sizes)], sizes[going], deep[going]))
        del key, own, mask, chosen
        pointer, size, depth = (np.concatenate(p) for p in zip(*parts))


def _sort(table: pa.Table, least: int) -> pa.Table:
    """The frequent phrases of a shard; ``whole`` is false where other shards may have more of the same."""
    blobs = [_unblob(data.as_buffer(), rows) for rows, data in zip(table["rows"].to_pylist(), table["data"])]
    known = np.unique(np.concatenate([np.zeros(1, np.uint64), *(k for k, _ in blobs)]))
    keys = np.empty((LONGEST, sum(len(c[0]) for _, c in blobs)), np.int32)
    at = 0
    for own, columns in blobs:
        to = np.searchsorted(known, own).astype(np.int32)
        for d in range(LONGEST):
            keys[d, at:at + len(columns[d])] = to[columns[d]]
        at += len(columns[0])
    by = np.concatenate([c[LONGEST] for _, c in blobs])
    n = np.concatenate([c[LONGEST + 1] for _, c in blobs])
    del blobs
    found = []
    for path in range(3):  # phrases of two to path + 1 words are shared with other shards
        own = by == path
        mine, times = (keys, n) if own.all() else (keys[:, own], n[own])
        floor = [1 if path and d <= path else least for d in range(LONGEST)]
        for length, at, total in multikey_quicksort(mine, times, floor):
            phrase = known[mine[:, at]]
            phrase[length:] = 0
            found.append([*phrase.view(np.int64), total, np.full(len(at), length > path + 1)])
    columns = [np.concatenate(c) for c in zip(*found)] if found else [*(np.zeros(0, np.int64) for _ in range(LONGEST + 1)), np.zeros(0, bool)]
    return pa.table([pa.array(c) for c in columns], names=[*_WORDS, "a", "whole"])


def frequent(docs: DataFrame, lang_column: str, text_column: str, least: int, shard_bytes: int) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (``lang, word, h, n``) and the frequent phrases of two words and more (their hashes, ``a``), stored."""
    texts = docs.select(
        F.coalesce(F.col(quoted(lang_column)).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(quoted(text_column)).cast("string"), F.lit("")).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    buckets = 1 << min(24, max(12, (16 * shards - 1).bit_length()))

    counted = texts.mapInArrow(lambda b: _count_words(b, buckets), _KINDS)
    counted = stored(counted.groupBy("kind", "lang", "word", "h").agg(F.sum("n").alias("n")), "phrase-words")
    vocabulary = counted.where("kind = 0").drop("kind")
    if vocabulary.groupBy("h").count().where("count > 1").limit(1).collect():
        raise ValueError("two words have the same hash: their counts would be mixed")
    # At most four buckets for each shard: what is hot has more than a quarter of an even shard.
    totals = counted.where("kind > 0").groupBy("kind").agg(F.sum("n").alias("total"))
    above = counted.where("kind > 0").join(F.broadcast(totals), "kind").where(F.col("n") * 4 * shards > F.col("total"))
    hot = [np.zeros(buckets, bool), np.zeros(buckets, bool)]
    for r in above.select("kind", "h").collect():
        hot[r["kind"] - 2][r["h"]] = True
    held = docs.sparkSession.sparkContext.broadcast(hot)

    routed = texts.mapInArrow(lambda b: _route(b, shards, held.value), "shard int, rows long, data binary")
    names = ", ".join(f"{w} long" for w in _WORDS)
    # A task for each shard, or a few: how much one reads doesn't grow with the input.
    found = routed.repartition(min(shards, MOST_TASKS), "shard").groupBy("shard").applyInArrow(lambda t: _sort(t, least), f"{names}, a long, whole boolean")
    found = stored(found, "phrase-counts")
    apart = found.where("NOT whole").groupBy(*_WORDS).agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return vocabulary, found.where("whole").select(*_WORDS, "a").unionByName(apart)


def _padded(parts: list[str]) -> list[Column]:
    return [F.col(p) if p else F.lit(0).cast("long") for p in [*parts, *[""] * (LONGEST - len(parts))]]


def _part(parts: list[str], **more: Column) -> Column:
    return F.struct(*[c.alias(f"p{i}") for i, c in enumerate(_padded(parts), 1)], *[c.alias(name) for name, c in more.items()])


def _cuts() -> Column:
    """The two sides of every cut of a phrase, by its length."""
    of_length = F.lit(None)
    for d in range(2, LONGEST + 1):
        sides = [
            _part(side, k=F.lit(k), first=F.lit(side[0] == _WORDS[0]))
            for k in range(1, d) for side in (_WORDS[:k], _WORDS[k:d])
        ]
        of_length = F.when(F.col(_WORDS[d - 1]) != 0, F.array(*sides)).otherwise(of_length)
    return of_length


def scored(vocabulary: DataFrame, phrases: DataFrame, least: int) -> DataFrame:
    """Candidates that no longer one absorbs, with ``a, l, r, score`` of their lowest cut."""
    alone = vocabulary.where(F.col("n") >= least).select(*[c.alias(f"p{i}") for i, c in enumerate(_padded(["h"]), 1)], F.col("n").alias("f"))
    counts = phrases.select(*[F.col(w).alias(f"p{i}") for i, w in enumerate(_WORDS, 1)], F.col("a").alias("f")).unionByName(alone)
    keys = [f"p{i}" for i in range(1, LONGEST + 1)]
    cuts = phrases.select(*_WORDS, "a", F.explode(_cuts()).alias("cut")).select(*_WORDS, "a", "cut.*")
    met = cuts.join(counts, keys).select(*_WORDS, "a", "k", "first", "f", F.lit(None).cast("long").alias("longer"))
    # Of a longer phrase, the two that lack its last or its first word.
    shorter = F.lit(None)
    for d in range(3, LONGEST + 1):
        shorter = F.when(F.col(_WORDS[d - 1]) != 0, F.array(_part(_WORDS[:d - 1]), _part(_WORDS[1:d]))).otherwise(shorter)
    inside = phrases.where(F.col(_WORDS[2]) != 0).select("a", F.explode(shorter).alias("part")).select("part.*", F.col("a").alias("longer"))
    inside = inside.select(*[F.col(k).alias(w) for k, w in zip(keys, _WORDS)], "longer")
    sides = {
        f"{side}{k}": F.max(F.when((F.col("k") == k) & (F.col("first") == (side == "l")), F.col("f")))
        for k in range(1, LONGEST) for side in "lr"
    }
    rows = met.unionByName(inside, allowMissingColumns=True).groupBy(*_WORDS).agg(
        F.max("a").alias("a"), F.max("longer").alias("longer"), *[c.alias(name) for name, c in sides.items()])
    wide = "DECIMAL(20, 0)"
    of_cut = [
        F.when(F.col(f"l{k}").isNotNull(), F.struct(
            F.expr(f"(CAST(2000000 AS {wide}) * CAST(a AS {wide})) div (CAST(l{k} AS {wide}) + CAST(r{k} AS {wide}))").alias("score"),
            F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
        ))
        for k in range(1, LONGEST)
    ]
    return (
        rows.where(F.expr(f"longer IS NULL OR CAST(100 AS {wide}) * CAST(longer AS {wide}) < CAST({ABSORBED} AS {wide}) * CAST(a AS {wide})"))
        .withColumn("low", F.array_min(F.array_compact(F.array(*of_cut))))
        .select(*_WORDS, "a", "low.l", "low.r", "low.score")
    )


def _top(rows: DataFrame, best: int, rank: Column, *order: Column) -> DataFrame:
    """The first rows of each language: of every salt first, so that no task ranks a whole language."""
    for group in (["lang", F.pmod(F.xxhash64(*_WORDS), F.lit(SALTS))], ["lang"]):
        rows = rows.withColumn("_rank", rank.over(Window.partitionBy(*group).orderBy(*order))).where(F.col("_rank") <= best).drop("_rank")
    return rows


def collocations(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text", least: int = LEAST, best: int = BEST, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of each language."""
    vocabulary, phrases = frequent(docs, lang_column, text_column, least, shard_bytes)
    spoken = vocabulary.where(F.col("n") >= least).select(F.col("h").alias("w1"), "lang")
    rows = scored(vocabulary, phrases, least).join(spoken, "w1")
    rows = _top(rows, best, F.rank(), F.desc("score"), F.desc("a"))
    told = (
        rows.select("*", F.posexplode(F.array(*_WORDS)).alias("nth", "h")).where("h != 0")
        .join(vocabulary.where(F.col("n") >= least).select("h", "word"), "h")
        .groupBy("lang", *_WORDS, "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("nth", "word"))).alias("told"))
        .withColumn("phrase", F.array_join("told.word", " "))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    told = _top(told, best, F.row_number(), *order)
    totals = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = told.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
