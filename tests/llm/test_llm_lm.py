import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from lakehist.llm import lm, trigrams
from lakehist.llm.queries import QUERIES
from pyarrow import fs

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def tokens(text):
    return [w.lower() for w in WORD.findall((text or "").encode())] + ["end"]


def discounts(counts):
    n = Counter(min(c, 5) for c in counts)
    if not n[1] or not n[2]:
        return [0, 0.5, 0.75, 1.0]
    y = n[1] / (n[1] + 2 * n[2])
    three = 3 - 4 * y * n[4] / n[3] if n[3] else 1.5
    found = [0, 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], three]
    return [min(max(d, 0), most) for d, most in zip(found, (0, 1, 2, 3))]


class Brute:
    def __init__(self, texts):
        split = [tokens(t) for t in texts]
        self.words = Counter(w for t in split for w in t)
        self.pairs = Counter(p for t in split for p in zip(["start", *t], t))
        self.d = discounts(self.pairs.values())
        self.kinds = Counter(w for _, w in self.pairs)
        self.low = discounts(self.kinds.values())
        self.left = sum(self.low[min(c, 3)] for c in self.kinds.values()) / max(len(self.pairs), 1) if self.pairs else 1.0
        self.total, self.back = Counter(), Counter()
        for (v, _), c in self.pairs.items():
            self.total[v] += c
            self.back[v] += self.d[min(c, 3)]

    def p(self, v, w):
        k = self.kinds[w]
        q = max(k - self.low[min(k, 3)], 0) / max(len(self.pairs), 1) + self.left / (len(self.words) + 1)
        if not self.total[v]:
            return q
        c = self.pairs[v, w]
        return (max(c - self.d[min(c, 3)], 0) + self.back[v] * q) / self.total[v]

    def scores(self, text):
        n, v = sum(self.words.values()), len(self.words)
        own = tokens(text)
        base = sum(math.log10((self.words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        return len(own), sum(self.words[w] > 0 for w in own), n, base, sum(math.log10(self.p(a, b)) for a, b in zip(["start", *own], own))


def compare(spark, train, docs, shards):
    model = lm.train(train, shards=shards)
    brute = Brute([r["text"] for r in train.collect()])
    texts = [r["text"] for r in docs.collect()]
    rows = lm.scored(docs, model).collect()
    assert len(rows) == len(texts)
    found = sorted(tuple(r)[1:] for r in rows)
    for got, want in zip(found, sorted(brute.scores(t) for t in texts)):
        assert got == pytest.approx(want, abs=1e-6)
    return model, brute


@pytest.mark.parametrize("shards", [1, 5, 64])
def test_against_brute_force(spark, odd_docs, shards):
    train = odd_docs.where("doc_id IS NULL OR doc_id <> 12")
    model, brute = compare(spark, train, odd_docs, shards)
    assert model.distinct == len(brute.words)


def test_probabilities_sum_to_one(spark):
    train = spark.createDataFrame([(i, f"a b{i % 4} c a b{i % 3}") for i in range(20)], "doc_id long, text string")
    brute = compare(spark, train, train, 3)[1]
    for v in brute.total:
        assert sum(brute.p(v, w) for w in brute.words) + brute.p(v, "?") == pytest.approx(1)


def test_small_blobs_and_real_documents(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lm, "HELD", 500)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    compare(spark, docs.where(~lm.held_out()), docs, 16)


def test_shards_of_a_store_that_cannot_be_mapped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lm, "_store", lambda path: (fs.SubTreeFileSystem("/", fs.LocalFileSystem()), path.lstrip("/")))
    words, counts = np.arange(3, dtype=np.uint64), np.array([5, 1, 2], np.uint32)
    for _ in range(2):  # a task may run twice
        lm._put(str(tmp_path), "bigrams-0", [words, counts])
        found = lm._get(str(tmp_path), "bigrams-0", lm._BIGRAM_FILE)
        assert [a.tolist() for a in found] == [[0, 1, 2], [5, 1, 2]]
    assert [f.name for f in tmp_path.iterdir()] == ["bigrams-0"]
    with pytest.raises(FileNotFoundError):
        lm._get(str(tmp_path), "bigrams-1", lm._BIGRAM_FILE)


def test_learning_from_nothing(odd_docs, no_docs, spark):
    compare(spark, no_docs, odd_docs, 4)
    assert lm.scored(no_docs, lm.train(odd_docs, shards=2)).collect() == []


def test_held_out_documents_are_likelier_than_by_word_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scores = lm.scored(docs.where(lm.held_out()), lm.train(docs.where(~lm.held_out())))
    row = scores.selectExpr("SUM(score) AS model", "SUM(base_score) AS base").first()
    assert row["model"] > row["base"]


class BruteOfThree:
    """Bigrams count the distinct words before them, those of the start symbol how often they occur."""

    def __init__(self, texts):
        split = [["start", *tokens(t)] for t in texts]
        self.words = Counter(w for t in split for w in t[1:])
        three = Counter(g for t in split for g in zip(t, t[1:], t[2:]))
        two = Counter((v, w) for _, v, w in three) + Counter((t[0], t[1]) for t in split)
        kinds = Counter(w for _, w in two)
        self.levels = [self.level(kinds), self.level(two), self.level(three)]

    @staticmethod
    def level(counts):
        d, total, back = discounts(counts.values()), Counter(), Counter()
        for gram, c in counts.items():
            before = gram[:-1] if isinstance(gram, tuple) else ()
            total[before] += c
            back[before] += d[min(c, 3)]
        return counts, d, total, back

    def p(self, before, w):
        counts, d, total, back = self.levels[len(before)]
        low = self.p(before[1:], w) if before else 1 / (len(self.words) + 1)
        if not total[before]:
            return low
        c = counts[(*before, w) if before else w]
        return (max(c - d[min(c, 3)], 0) + back[before] * low) / total[before]

    def score(self, text):
        own = ["start", *tokens(text)]
        return sum(math.log10(self.p(tuple(own[max(i - 2, 0):i]), own[i])) for i in range(1, len(own)))


def compare_three(train, docs, shards):
    model = lm.train(train, shards=shards, order=3)
    brute = BruteOfThree([r["text"] for r in train.collect()])
    found = sorted(r["score"] for r in lm.scored(docs, model).collect())
    assert found == pytest.approx(sorted(brute.score(r["text"]) for r in docs.collect()), abs=1e-6)
    return brute


@pytest.mark.parametrize("shards", [1, 64])
def test_order_three_against_brute_force(odd_docs, no_docs, shards):
    compare_three(odd_docs.where("doc_id IS NULL OR doc_id <> 12"), odd_docs, shards)
    compare_three(no_docs, odd_docs, shards)


def test_order_three_on_real_documents(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lm, "HELD", 500)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    brute = compare_three(docs.where(~lm.held_out()), docs, 16)
    for before in [(), ("start",), *list(brute.levels[2][2])[:20]]:
        assert sum(brute.p(before, w) for w in brute.words) + brute.p(before, "?") == pytest.approx(1)


def test_query_looks_two_words_back(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    brute = BruteOfThree([r["text"] for r in docs.where(~lm.held_out()).collect()])
    found = {r["doc_id"]: r["score"] for r in QUERIES["op2_kneser_ney"](spark, sf_dir).collect()}
    for r in docs.limit(20).collect():
        assert found[r["doc_id"]] == pytest.approx(brute.score(r["text"]), abs=1e-6)


def test_counts_beyond_32_bits(tmp_path):
    """Three words, one pair and one trigram so frequent that no 32-bit number holds them."""
    many = 2**33 + 5
    hashes = np.sort(lm._tokens(pa.array(["a b"]))[0])
    start = len(hashes)
    model = lm.Model(str(tmp_path), 1, 3 * many, start, np.array([lm._START]), order=3, bases=np.zeros(1, np.int64), hot_numbers=np.array([start]))
    lm._put(model.path, "counts-0", [hashes, np.full(start, many)])
    place = {int(h): i for i, h in enumerate(hashes)}
    a, b, end = (place[int(h)] for h in lm._tokens(pa.array(["a b"]))[0])
    grams = sorted([(start, start, a), (a, start, b), (b, a, end)])
    columns = [np.array(c) for c in zip(*grams)]
    rows = trigrams._by_shard(lm._TRIGRAM, np.zeros(3, int), [*columns, np.full(3, many)], trigrams._squeezed_trigrams)
    table = pa.Table.from_batches([lm._batch(list(rows))])
    for merge in (trigrams._merge_trigrams, trigrams._merge_spread, trigrams._merge_words):
        table = merge(table, model)
    totals = trigrams._unsqueezed(table["data"][0].as_py())[0]
    assert totals[0] == 3 and totals[9:13].tolist() == [many, 0, 0, 1]
    scorer = trigrams.Scorer(model)
    shard, (low, high, follows, one, two, more) = scorer._contexts(np.array([start, a]), np.array([a, b]))
    assert follows.tolist() == [many, many] and more.tolist() == [1, 1]
    assert scorer._trigrams(shard, low, high, np.array([b, end])).tolist() == [many, many]
    assert scorer._pairs(np.array([start, a]), np.array([a, b])).tolist() == [many, 1]
    assert scorer._of_words(np.array([a, -1]))[0].tolist() == [many, 0]


def test_bigram_counts_beyond_32_bits(tmp_path):
    hashes = np.sort(np.array([5, 9], np.uint64))
    blob = lm._batch([(0, lm._BIGRAM, 2, lm._packed(hashes, hashes[::-1].copy(), np.array([2**34, 7])))])
    lm._merge_bigrams(pa.Table.from_batches([blob]), str(tmp_path), 1, np.zeros(0, np.uint64))
    key = np.sort(lm._bigram(hashes, hashes[::-1].copy(), np.zeros(0, np.uint64)))
    scorer = lm.Scorer(lm.Model(str(tmp_path), 1, 1, 1, np.zeros(0, np.uint64)))
    (found,) = scorer._find("bigrams", key, 1)
    (large,) = scorer._find("large", key, 1)
    assert sorted(found.tolist()) == [7, lm._LARGE] and sorted(large.tolist()) == [0, 2**34]


def test_stores_that_cannot_be_opened_are_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lm._store("s3a://bucket/folder")


@given(st.lists(st.tuples(*[st.integers(0, 2**40)] * 2), min_size=1, max_size=60), st.lists(st.integers(0, 2**40), min_size=1, max_size=20))
def test_runs_planes_and_searches(rows, sought):
    first, second = (np.array(c) for c in zip(*sorted(rows)))
    packed = trigrams._unsqueezed(trigrams._squeezed(*trigrams._runs(first, second)))
    assert [a.tolist() for a in trigrams._of_runs(*packed)] == [first.tolist(), second.tolist()]
    run = np.unique(second % 2**33)
    asked = np.array([*sought, *run.tolist()]) % 2**33
    at = trigrams._find(trigrams._planes(run), np.zeros(len(asked)), np.full(len(asked), len(run)), asked)
    assert at.tolist() == [run.tolist().index(x) if x in run else -1 for x in asked.tolist()]
    counts = trigrams._bytes(second)
    assert trigrams._count(counts, np.arange(len(second))).tolist() == second.tolist()


@pytest.mark.parametrize("shards", [1, 7])
def test_contexts_with_many_successors(spark, shards):
    """Sums that are stored and sums that are taken from the successors; words never seen anywhere."""
    rows = [(i, f"so many w{i % 90} w{i % 40} so many") for i in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs = spark.createDataFrame([(0, "so many w3 w4 so"), (1, "so many unseen so many"), (2, "unseen unseen w1"), (3, "so")], train.schema)
    compare_three(train, docs, shards)
