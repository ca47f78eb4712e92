import random
import re
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pytest
from lakehist.llm import phrases
from lakehist.llm.phrases import collocations, multikey_quicksort
from lakehist.llm.queries import ORACLE, op12_collocations

SF_DIR = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, best):
    """The report from plain counters; ``rows`` are pairs of language and text."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for d in range(1, 5):
                f.update((lang, *words[i:i + d]) for i in range(len(words) - d + 1))
    candidates = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    absorbed = set()
    for (lang, *g), a in candidates.items():
        for d in range(2, len(g)):
            for i in range(len(g) - d + 1):
                if 100 * a >= 80 * f[(lang, *g[i:i + d])]:
                    absorbed.add((lang, *g[i:i + d]))
    out = {}
    for (lang, *g), a in candidates.items():
        if (lang, *g) in absorbed:
            continue
        cuts = [(f[(lang, *g[:k])], f[(lang, *g[k:])]) for k in range(1, len(g))]
        score, _, l, r = min((2000000 * a // (l + r), k, l, r) for k, (l, r) in enumerate(cuts))
        out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), l, r))
    return sorted(
        (lang, i + 1, g.decode(), -a, l, r, n[lang], -s)
        for lang, found in out.items() for i, (s, a, g, l, r) in enumerate(sorted(found)[:best])
    )


def found(frame, **settings):
    return sorted(tuple(r) for r in collocations(frame, **settings).collect())


SIGNS = [" ", " ", " ", "\t", "  ", ", ", ". ", "\n", "!", " A ", " É ", " é"]


def random_rows(rng, n, most, vocabulary=("a", "b", "cat", "é", "x-y", "b")):
    return [
        (rng.choice(["en", "de", None, "und"]), "".join(rng.choice(vocabulary) + rng.choice(SIGNS) for _ in range(rng.randrange(most))))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed, shard_bytes", [(0, 1 << 20), (1, 400), (2, 60)])
def test_against_brute_force(spark, seed, shard_bytes):
    rng = random.Random(seed)
    rows = [*random_rows(rng, 60, 50), ("en", None), (None, None), ("en", ""), ("fr", "one two")]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for least, best in ((2, 1000), (5, 7)):
        expected = brute(rows, least, best)
        assert len(expected) > 5
        assert found(frame, least=least, best=best, shard_bytes=shard_bytes) == expected


def test_a_pair_that_holds_a_third_of_all_words(spark):
    """Hot pairs and triples are counted in many shards."""
    rng = random.Random(5)
    rows = [("en", " ".join(f"big deal{rng.choice([' big deal', ' of w', ' x'])}{rng.randrange(30)} v{rng.randrange(9)}" for _ in range(20))) for _ in range(30)]
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    hot = []
    paths = phrases._paths
    columns = phrases.Tokens(*[phrases.pa.array(c) for c in zip(*rows)]).suffixes()
    for d in (2, 3):
        counts = np.bincount((phrases._chained(*columns[:d]) >> phrases._bits(4096)).astype(np.int64), minlength=4096)
        hot.append(counts * 4 * 120 > counts.sum())
    assert set(paths(columns, hot)[0]) == {0, 1, 2}  # all three ways are taken
    size = sum(len(t) for _, t in rows)
    assert found(frame, least=3, shard_bytes=-(-size // 120)) == brute(rows, 3, 2000)


def test_the_sort_counts_prefixes_and_abandons_small_segments():
    rng = np.random.default_rng(4)
    keys = rng.integers(1, 6, (4, 500))
    ends = rng.integers(1, 5, 500)
    keys[np.arange(4)[:, None] >= ends] = 0
    n = rng.integers(1, 4, 500)
    counts = Counter()
    for i in range(500):
        for d in range(2, 5):
            if keys[d - 1, i]:
                counts[tuple(keys[:d, i].tolist())] += int(n[i])
    got = {}
    for d, at, total in multikey_quicksort(keys, n, [9, 9, 9, 9]):
        got.update((tuple(keys[:d, i].tolist()), t) for i, t in zip(at, total.tolist()))
    assert got == {g: c for g, c in counts.items() if c >= 9}
    assert not list(multikey_quicksort(keys[:, :0], n[:0], [1] * 4))


def peak(rows):
    """The most bytes that were held at once while ``rows`` were made and let go one by one."""
    tracemalloc.start()
    for _ in rows:
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_tasks_hold_few_arrays_at_a_time():
    """Two tasks share an executor with the JVM: counting, routing and sorting 4 MB of text took 27, 37 and 22 times that."""
    rng = np.random.default_rng(8)
    vocabulary = np.array([f"w{i}" for i in range(100_000)])
    drawn = vocabulary[(100_000 * rng.random(650_000) ** 3).astype(int)]
    texts = phrases.pa.array([" ".join(w) for w in np.split(drawn, 650)])
    batch = phrases.pa.record_batch([phrases.pa.array(["en"] * 650), texts], names=["lang", "text"])
    size = texts.nbytes
    assert 3 << 20 < size < 4 << 20
    hot = [np.zeros(4096, bool)] * 2
    limits = {"count": 12, "route": 26, "sort": 14}
    routed = phrases.pa.Table.from_batches(list(phrases._route(iter([batch]), 1, hot)))
    got = {
        "count": peak(phrases._count_words(iter([batch]), 4096)),
        "route": peak(phrases._route(iter([batch]), 1, hot)),
        "sort": peak(phrases._sort(routed, 30) for _ in "1"),
    }
    assert all(got[k] < limits[k] * size for k in got)


def test_counts_that_are_sent_early_add_up(spark, monkeypatch):
    rng = random.Random(9)
    rows = random_rows(rng, 40, 60, [f"{w}{i}" for w in ("a", "É", "日本") for i in range(30)])
    batches = [phrases.pa.record_batch([[lang or "und" for lang, _ in part], [t for _, t in part]], names=["lang", "text"]) for part in (rows[:20], rows[20:])]
    want = Counter((lang or "und", w) for lang, text in rows for w in re.findall(r"[^\x20\x09-\x0D.,;:!?]+", lowered(text)))

    def counted():
        sent, n = Counter(), 0
        for batch in phrases._count_words(iter(batches), 4096):
            for r in batch.to_pylist():
                n += r["kind"] == 0
                if r["kind"] == 0:
                    sent[r["lang"], r["word"]] += r["n"]
        return sent, n

    assert counted() == (want, len(want))
    monkeypatch.setattr(phrases, "COUNTED_BYTES", 500)
    for words, size in ((50, 1 << 20), (10**6, 2_000)):
        monkeypatch.setattr(phrases, "HELD_WORDS", words)
        monkeypatch.setattr(phrases, "HELD_BYTES", size)
        sent, n = counted()
        assert sent == want and n > len(want)


def test_bytes_that_are_no_text_are_replaced():
    raw = phrases.pa.array([b"caf\xe9 ok"]).view(phrases.pa.string())
    batch = phrases.pa.record_batch([phrases.pa.array(["en"]), raw], names=["lang", "text"])
    words = [r["word"] for b in phrases._count_words(iter([batch]), 4096) for r in b.to_pylist() if r["kind"] == 0]
    assert sorted(words) == ["caf\ufffd", "ok"]


def test_repeats_of_one_word_and_long_texts(spark):
    rows = [("en", "no " * 40_000), ("en", "x" * 70_000 + " y"), ("en", "yes no. " * 20)] * 2
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(frame) == brute(rows, 30, 2000)


def test_scores_beyond_64_bits(spark):
    vocabulary = spark.createDataFrame([("en", "a", 1, 10**14), ("en", "b", 2, 10**14)], "lang string, word string, h long, n long")
    counted = spark.createDataFrame([(1, 2, 0, 0, 10**14 - 1)], "w1 long, w2 long, w3 long, w4 long, a long")
    (row,) = phrases.scored(vocabulary, counted, 30).collect()
    assert row["score"] == 2000000 * (10**14 - 1) // (2 * 10**14) == 999_999


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    frame = odd_docs.withColumnsRenamed({"source": "phrase", "n_chars": "rank"})
    assert found(frame, least=2) == brute(rows, 2, 2000)
    assert collocations(no_docs).collect() == []
    assert collocations(no_docs).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_words_with_one_hash_are_refused(spark, monkeypatch):
    frame = spark.createDataFrame([("en", "a b")], "lang string, text string")
    monkeypatch.setattr(phrases, "_count_words", lambda batches, buckets: iter(
        [phrases.pa.record_batch([[0, 0], ["en", "en"], ["a", "b"], [7, 7], [1, 1]], schema=phrases._SCHEMA)]))
    with pytest.raises(ValueError, match="same hash"):
        collocations(frame)


def test_registered_query_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    rows = op12_collocations(spark, SF_DIR)
    expected = con.sql(ORACLE["op12_collocations"])
    assert rows.columns == expected.columns
    assert sorted(map(tuple, rows.collect())) == sorted(expected.fetchall())
