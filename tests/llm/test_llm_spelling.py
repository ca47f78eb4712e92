import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from lakehist.llm import spelling
from lakehist.llm.queries import ORACLE, op11_spelling
from lakehist.llm.spelling import nearest, spelling_variants, variants, vocabulary

SF_DIR = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_error(a, b):
    """Whether ``a`` and ``b`` are the same but for one letter, at the first place where they differ."""
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def brute_near(words, letters="abcdefghijklmnopqrstuvwxyzéß÷"):
    """The near words of each word, by making every string that is one error away."""
    found = {}
    for w in words:
        if len(w) > 100:  # too many strings to make; cutting a letter off either makes the other
            found[w] = {x for x in words if x != w and abs(len(x) - len(w)) < 2 and one_error(w, x)}
            continue
        cuts = [(w[:i], w[i:]) for i in range(len(w) + 1)]
        made = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
        found[w] = {m for m in made if m in words and m != w}
    return found


def brute(words):
    near = brute_near(words)
    form, out = {}, []
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=lambda r: r[0])


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: r[0])


def random_words(rng, n, letters, lengths):
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))): 5 * 5 ** rng.randrange(7) + rng.randrange(3) for _ in range(n)}
    for w in list(words):
        at = rng.randrange(len(w))
        words.setdefault(w[:at] + w[at + 1:] if len(w) > 6 and rng.random() < 0.4 else w[:at] + rng.choice(letters) + w[at + 1:], 5 + rng.randrange(4))
    return words


@pytest.mark.parametrize("seed, letters, lengths, sizes", [
    (0, "ab", (6, 7, 8), {}),
    (1, "abé", (6, 7, 9, 13), {"block": 40}),
    (2, "abcdefgß", (6, 7), {"piece": 3, "block": 7}),
    (3, "ab", (20, 21), {"piece": 16}),
])
def test_near_words_and_forms_against_brute_force(spark, seed, letters, lengths, sizes):
    words = random_words(random.Random(seed), 150, letters, lengths)
    frame = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    expected = brute(words)
    assert sum(r[4] for r in expected) > 100
    assert rows_of(variants(frame, **sizes)) == expected


def test_index_finds_exactly_the_words_one_error_away(monkeypatch):
    rng = random.Random(6)
    for t in (6, 7):
        words = sorted({"".join(rng.choice("aab") for _ in range(t + rng.randrange(2))) for _ in range(130)})
        letters = np.array([[*w.encode().ljust(t + 1, b"\0")] for w in words], np.uint8)
        size = np.array([len(w) for w in words])
        index, near = spelling.Index(letters, size), brute_near(dict.fromkeys(words, 1), "ab")
        got = set()
        for m in (t, t + 1):
            own = np.flatnonzero(size == m)
            a, b = index.near(letters[own], m)
            got |= {(words[i], words[j]) for i, j in zip(own[a], b)}
        assert got == {(w, x) for w in words for x in near[w] if min(len(w), len(x)) == t}


def test_long_chains_of_forms(spark):
    words = {"abcdef" + "x" * i: 5 ** (12 - i) for i in range(12)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r["root"] for r in variants(frame).collect()} == {"abcdef"}


def test_ties_go_to_the_first_word(spark):
    frame = spark.createDataFrame([("abcdef", 5), ("abcdeé", 25), ("abcdez", 25), ("bcdefgh", 9)], "word string, n long")
    rows = {r["word"]: r for r in variants(frame).collect()}
    assert rows["abcdef"]["form"] == "abcdez" and rows["abcdef"]["n_near"] == 2
    assert (rows["abcdez"]["form"], rows["abcdez"]["form_n"]) == (None, None)
    assert (rows["bcdefgh"]["n_near"], rows["bcdefgh"]["root"]) == (0, "bcdefgh")


def test_a_half_that_a_third_of_all_words_share(spark):
    rng = random.Random(8)
    shared = {"common" + "".join(rng.choice("abc") for _ in range(6)): 5 for _ in range(300)}
    words = shared | random_words(rng, 200, "abcdefgh", (12,))
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    near = brute_near(words)
    rows = {r["word"]: r["n_near"] for r in nearest(frame, piece=32).collect()}
    assert rows == {w: len(f) for w, f in near.items() if f}


def test_vocabulary_of_random_texts(spark):
    rng = random.Random(9)
    bag = ["Kitchen", "kitchén", "RIVER", "stones", "naïveté", "×÷ÀÿÖö", "short", "mountains"]
    rows = [(i, " ".join(rng.choice(bag) + rng.choice(["", ".", "1", "ā", "-"]) for _ in range(200))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["word"]: r["n"] for r in vocabulary(frame).collect()}
    assert found == brute_words(rows)
    assert any(w not in {lowered(b) for b in bag} for w in found) or len(found) >= 7


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    text = ("Mountain rivers; " * 300) + "q" * 5_000 + " Mountain"
    assert "".join(spelling._chunks(lowered(text))) == lowered(text)
    monkeypatch.setattr(spelling, "CHARS", 50)
    parts = list(spelling._chunks(lowered(text)))
    assert "".join(parts) == lowered(text) and len(parts) > 50
    assert sum(len(re.findall("[a-zÀ-ÿ]+", p)) for p in parts) == len(re.findall("[a-zÀ-ÿ]+", lowered(text)))
    rows = [(1, text * 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(spelling_variants(frame)) == brute(brute_words(rows))


def test_very_long_words(spark):
    long = "ab" * 3_000
    words = {long: 500, long[:-1]: 5, long[1:]: 5, "x" + long[1:]: 9, long[:200]: 7, "abcdef": 5}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = {r["word"]: (r["form"], r["n_near"]) for r in variants(frame).collect()}
    # Cutting either end off, and replacing the first letter, are one error each; both cuts are two errors apart but here one.
    assert rows["x" + long[1:]] == (long, 2)
    assert rows[long][1] == 3 and rows["abcdef"] == (None, 0)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()] * 5
    frame = odd_docs.withColumnsRenamed({"source": "word", "lang": "n"})
    for _ in range(4):
        frame = frame.unionAll(odd_docs)
    assert rows_of(spelling_variants(frame)) == brute(brute_words(rows))
    assert spelling_variants(no_docs).collect() == []
    assert spelling_variants(no_docs).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_registered_query_against_sql_and_brute_force(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    found = op11_spelling(spark, SF_DIR)
    expected = con.sql(ORACLE["op11_spelling"])
    assert found.columns == expected.columns
    assert rows_of(found) == sorted(expected.fetchall(), key=lambda r: r[0])
    docs = con.sql("SELECT doc_id, text FROM documents").fetchall()
    assert [(r[0], r[3]) for r in rows_of(found)] == sorted(brute_words(docs).items())
