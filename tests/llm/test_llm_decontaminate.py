import gc
import random
import re
import weakref

import numpy as np
import pyarrow as pa
import pytest
from lakehist.llm.decontaminate import SuffixArray, _scan, block_of, contamination, decontaminated, longest_matches, stored_blocks
from pyspark.sql.classic.dataframe import DataFrame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_longest(text, items, window):
    """First word and length of the longest run that stands in one item, shorter items as a whole."""
    own, best = split(text), (0, 0)
    for _, passage in items:
        words = split(passage)
        for p in range(len(own)):
            for q in range(len(words)):
                k = 0
                while p + k < len(own) and q + k < len(words) and own[p + k] == words[q + k]:
                    k += 1
                if k >= min(window, len(words)):
                    best = max(best, (k, -p))
    return (-best[1], best[0]) if best[0] else None


def brute(text, items, window):
    own, hit, found = split(text), set(), set()
    for item, passage in items:
        words = split(passage)
        n = min(window, len(words))
        sought = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()
        for i in range(len(own) - n + 1):
            if n and tuple(own[i:i + n]) in sought:
                hit.update(range(i, i + n))
                if item is not None:
                    found.add(str(item))
    return len(own), len(hit), sorted(found)


def random_texts(rng, n, size, words="abcde"):
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(size))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    items = list(enumerate(random_texts(rng, 12, 9))) + [(None, "a b c a"), (99, None), (100, "..."), (5, "Ä e 7"), (5, "e, e")]
    docs = list(enumerate([*random_texts(rng, 60, 60), None, "", "ä E: 7!", "ä E: 7 A B C A", "a b c", "x"]))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 20):  # one block, and many
        rows = contamination(frame, benchmark, window=4, shard_bytes=300, block_bytes=block_bytes).collect()
        found = {r["doc_id"]: r["contamination"] for r in rows}
        assert len(rows) == len(docs)
        for i, text in docs:
            n, hit, listed = brute(text, items, 4)
            c = found[i]
            assert (c["n_words"], c["n_hit"], c["items"]) == (n, hit, listed)
            assert (tuple(c["longest"]) if c["longest"] else None) == brute_longest(text, items, 4)
            assert sum(p["n_words"] for p in c["passages"]) == hit


def test_passages_are_where_the_words_are(spark):
    docs = spark.createDataFrame([(1, "x one two three y one two z three two one")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    c = contamination(docs, benchmark, window=2).first()["contamination"]
    assert [tuple(p) for p in c["passages"]] == [(1, 3), (5, 2)]
    assert tuple(c["longest"]) == (1, 3)


def test_a_passage_of_two_items_is_no_longest_match(spark):
    docs = spark.createDataFrame([(1, "x a b c d e f g x a b c d e")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "a b c d e"), (2, "d e f g h"), (3, "q a b c d e")], "item_id long, text string")
    c = contamination(docs, benchmark, window=2).first()["contamination"]
    assert [tuple(p) for p in c["passages"]] == [(1, 7), (9, 5)]
    assert tuple(c["longest"]) == (1, 5)


@pytest.mark.parametrize("seed", range(30))
def test_longest_matches(seed):
    rng = random.Random(seed)
    own, others = ([rng.choice([0, 1, 1, 2, 2, 3]) for _ in range(rng.randrange(1, 60))] for _ in range(2))

    def common(p, q):
        k = 0
        while p + k < len(own) and q + k < len(others) and own[p + k] == others[q + k] > 0:
            k += 1
        return k

    expected = [max(common(p, q) for q in range(len(others))) for p in range(len(own))]
    assert longest_matches(np.array(own), np.array(others)).tolist() == expected


def test_suffix_array_searches_across_keys():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcdefgh") for _ in range(400))
    block = block_of([(1, text)], 30)  # 30 words of 4 bits take two keys
    numbers = block.windows[30][0]
    assert SuffixArray(numbers, len(block.vocabulary) + 1, 30, 30).n_keys == 2
    benchmark, doc = [(1, " ".join(text.split()[100:160]))], text
    from lakehist.llm.decontaminate import _scan

    class Held:
        value = block_of(benchmark, 30)

    assert _scan(pa.array([doc]), [Held], 30).to_pylist()[0]["n_hit"] == 60


def test_shards_of_fewer_words_than_a_window(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "c a b c a b c d")], "item_id long, text string")
    assert decontaminated(docs, benchmark).count() == 2
    assert decontaminated(docs, benchmark, window=3).count() == 1


def test_odd_rows_pass_through(odd_docs, no_docs, spark):
    benchmark = spark.createDataFrame([(1, "twice the same row"), (2, "größe straße")], "item_id long, text string")
    kept = decontaminated(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.count() - 3
    assert decontaminated(no_docs, benchmark).collect() == []
    assert decontaminated(odd_docs, benchmark.limit(0)).count() == odd_docs.count()
    clash = odd_docs.withColumn("contamination", odd_docs.doc_id)
    assert decontaminated(clash, benchmark).columns == clash.columns


def test_a_benchmark_of_many_blocks_is_never_held_whole(spark, monkeypatch):
    """Blocks are written by tasks, and a scan has one of them at a time."""
    rng = random.Random(17)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(30))) for i in range(200)] + [(None, "a b c d e")] + [(3, None)]
    benchmark = spark.createDataFrame(items + items[:50], "item_id long, text string").repartition(5)
    blocks = stored_blocks(benchmark, "item_id", "text", 4, 300)
    assert len(blocks) > 30
    held, most, kept = weakref.WeakSet(), [], [b.value for b in blocks]
    assert sorted((b.items[k] or "", len(b.windows)) for b in kept for k in range(len(b.items))) == sorted((str(i) if i is not None else "", 1) for i, t in items if t)
    del kept

    class Watched:
        def __init__(self, block):
            self.block = block

        @property
        def value(self):
            found = self.block.value
            held.add(found)
            gc.collect()
            most.append(len(held))
            return found

    texts = [" ".join(items[i][1].split()[2:9]) + " x a b c d e" for i in range(0, 200, 7)] + ["nothing", None, ""]
    rows = _scan(pa.array(texts), [Watched(b) for b in blocks], 4).to_pylist()
    assert len(most) == len(blocks) and max(most) <= 2  # the next one is opened before the last is let go
    for text, row in zip(texts, rows):
        assert (row["n_words"], row["n_hit"], row["items"]) == brute(text, items, 4)


def test_the_driver_holds_no_text_of_the_benchmark(spark, monkeypatch):
    """What comes back from the blocks is their numbers."""
    benchmark = spark.createDataFrame([(i, f"secret passage number {i} of many") for i in range(50)], "item_id long, text string")
    seen, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.extend(rows := collect(self)) or rows)
    monkeypatch.setattr(DataFrame, "toLocalIterator", None)
    docs = spark.createDataFrame([(1, "a secret passage number 7 of many")], "doc_id long, text string")
    found = contamination(docs, benchmark, window=3, block_bytes=200)
    assert len(seen) > 3 and "secret" not in str(seen)
    assert collect(found)[0]["contamination"]["items"][:1] == ["0"]
