import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lakehist.llm import tokens
from lakehist.llm.tokens import Document, counted, counter, leaf_starts, recounted, redactions, total, tree_of

count = counter(tokens.VOCABULARY)
TEXT = st.text(alphabet="ab'sé日 \n\t.,019ll\u00a0", max_size=900)


@settings(max_examples=120, deadline=None)
@given(text=TEXT)
def test_leaves_have_the_tokens_of_the_text(text):
    data = text.encode()
    for size in (256, 4):
        held, tokens.LEAF_BYTES = tokens.LEAF_BYTES, size
        try:
            assert total(Document.read(data, count).sums) == count(data)
        finally:
            tokens.LEAF_BYTES = held


@settings(max_examples=120, deadline=None)
@given(text=TEXT, seed=st.integers(0, 10**6), puts=st.lists(TEXT, max_size=5))
def test_edits_count_like_the_edited_text(text, seed, puts):
    rng = random.Random(seed)
    held, tokens.LEAF_BYTES = tokens.LEAF_BYTES, 8
    try:
        places = sorted(rng.sample(range(len(text) + 1), min(2 * len(puts), len(text) + 1)))
        spans = list(zip(places[::2], places[1::2]))
        edits, edited, last = [], "", 0
        for (a, b), put in zip(spans, puts):
            edits.append((len(text[:a].encode()), len(text[a:b].encode()), put.encode()))
            edited, last = edited + text[last:a] + put, b
        edited += text[last:]
        d = Document.read(text.encode(), count)
        rng.shuffle(edits)
        d.edit(edits, count)
        assert d.data.decode() == edited
        assert total(d.sums) == count(edited.encode())
        assert (d.sums == tree_of(tokens.leaf_counts(d.data, d.starts, count))).all()
    finally:
        tokens.LEAF_BYTES = held


def test_an_edit_encodes_little():
    text = " ".join(f"word{i}" for i in range(20_000)).encode()
    d = Document.read(text, count)
    d.edit([(70_000, 3, b"new text")], count)
    assert d.encoded <= 3 and len(d.starts) > 500
    assert total(d.sums) == count(d.data)


def test_bad_edits():
    for edits in ([(0, 9, b"")], [(-1, 1, b"")], [(0, 2, b""), (1, 1, b"")]):
        with pytest.raises(ValueError):
            Document.read(b"a bc", count).edit(edits, count)


def test_no_safe_cut_is_one_leaf():
    assert leaf_starts(("é" * 1000).encode()).tolist() == [0]
    assert leaf_starts(b"").tolist() == []


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.withColumn("tokens", odd_docs.doc_id).withColumnRenamed("source", "edits")
    found = recounted(redactions(counted(docs)), tree_column="_tokens", edits_column="_edits")
    assert found.columns == [*docs.columns, "_tokens", "_edits", "edited"]
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        text = r["text"] or ""
        assert r["_tokens"]["n_tokens"] == count(text.encode())
        assert r["edited"]["text"] == tokens.REDACTED.sub(b"0", text.encode()).decode()
        assert r["edited"]["n_tokens"] == count(r["edited"]["text"].encode())
    assert any(r["_edits"] for r in rows)
    assert recounted(redactions(counted(no_docs))).collect() == []


def test_null_edits_change_nothing(spark):
    docs = counted(spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string"))
    docs = docs.selectExpr("*", "CAST(NULL AS ARRAY<STRUCT<at: BIGINT, drop: BIGINT, put: STRING>>) AS edits")
    for r in recounted(docs).collect():
        assert r["edited"]["n_tokens"] == r["tokens"]["n_tokens"] and r["edited"]["leaves_encoded"] == 0


def test_real_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for r in recounted(redactions(counted(docs))).collect():
        assert r["tokens"]["n_tokens"] == count(r["text"].encode())
        assert r["edited"]["n_tokens"] == count(r["edited"]["text"].encode())


def test_trees_add_up():
    for n in (0, 1, 2, 3, 7, 8):
        sums = tree_of(np.arange(1, n + 1))
        assert total(sums) == n * (n + 1) // 2


#: Letters, marks, numbers and signs of many scripts, and all that Unicode takes for white space.
SCRIPTS = st.text(
    alphabet=st.one_of(
        st.sampled_from("абвгд жзик 日本語。，、のテキスト ελλη नमस्ते हिन्दी สวัสดี العربية עברית 한국어 ٣४①Ⅷ½ 😀👍🏽€ §'´’l's"),
        st.sampled_from("\u0085       　\x1c\x1f\x00​‍\r\n\t '"),
        st.characters(exclude_categories=["Cs"]),
    ),
    max_size=120,
)


@settings(max_examples=300, deadline=None)
@given(text=SCRIPTS)
def test_leaves_of_any_script_have_the_tokens_of_the_text(text):
    data, held = text.encode(), tokens.LEAF_BYTES
    tokens.LEAF_BYTES = 1  # every safe cut is one
    try:
        assert total(Document.read(data, count).sums) == count(data)
    finally:
        tokens.LEAF_BYTES = held


@settings(max_examples=200, deadline=None)
@given(text=SCRIPTS, put=SCRIPTS, seed=st.integers(0, 10**6))
def test_edits_of_any_script_count_like_the_edited_text(text, put, seed):
    rng, held = random.Random(seed), tokens.LEAF_BYTES
    tokens.LEAF_BYTES = rng.choice((1, 6))
    try:
        a, b = sorted(rng.randrange(len(text) + 1) for _ in range(2))
        d = Document.read(text.encode(), count)
        d.edit([(len(text[:a].encode()), len(text[a:b].encode()), put.encode())], count)
        assert d.data.decode() == text[:a] + put + text[b:]
        assert total(d.sums) == count(d.data)
        assert (d.sums == tree_of(tokens.leaf_counts(d.data, d.starts, count))).all()
    finally:
        tokens.LEAF_BYTES = held


@pytest.mark.parametrize("sentence", [
    "Съешь ещё этих мягких французских булок, да выпей чаю. ", "敏捷的棕色狐狸跳过了懒狗。今天天气很好，我们去公园。", "すばやい茶色の狐は、のろまな犬を飛び越える。",
    "Ο γρήγορος καστανός αλεπού πηδάει. ", "तेज़ भूरी लोमड़ी आलसी कुत्ते पर कूदती है। ", "키 큰 사람이 빨리 걷는다. ",
])
def test_texts_of_many_scripts_have_many_leaves(sentence):
    data = (sentence * 3_000).encode()
    d = Document.read(data, count)
    sizes = np.diff(np.append(d.starts, len(data)))
    assert len(d.starts) > len(data) / 600 and sizes.max() < 1_000
    assert total(d.sums) == count(data)
    middle = len((sentence * 1_500).encode())
    d.edit([(middle, len(sentence.encode()), "x1 ".encode())], count)
    assert d.encoded <= 4 and total(d.sums) == count(d.data)
