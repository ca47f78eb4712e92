"""The registered queries against their SQL, and the stages of the pipeline on real and on odd documents."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR
from lakehist.llm import common, language
from lakehist.llm.queries import ORACLE, QUERIES

import __spark_entry__ as entry
import corpus_pipeline


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    registered = {name: query.__wrapped__ for name, query in entry.queries().items() if hasattr(query, "__wrapped__")}
    assert registered == QUERIES | {"pipeline": corpus_pipeline.run}
    assert ORACLE.items() <= entry.oracle_sql().items() and "pipeline" not in entry.oracle_sql()


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF_DIR), con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.fetchall())


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op1_minhash_dedup", ["doc_id", "class_id"]),
        ("op2_kneser_ney", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]),
        ("op3_mixing", ["doc_id", "size", "source_size", "target", "taken"]),
        ("op4_hilbert_sharding", ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
        ("op5_token_counts", ["doc_id", "n_tokens", "edited_tokens"]),
        ("op10_language", ["doc_id", "held_out", "lang_pred", "score"]),
    ],
)
def test_query_has_a_row_for_every_document(spark, name, columns):
    found = QUERIES[name](spark, SF_DIR)
    assert [c for c in columns if c not in found.columns] == []
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert Counter(r[0] for r in found.select("doc_id").collect()) == Counter(r[0] for r in docs.select("doc_id").collect())


def test_run_is_its_stages_one_after_the_other(spark):
    final = corpus_pipeline.run(spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language identification", "near duplicates", "benchmark decontamination", "source mixture", "shards",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns
        docs = spark.createDataFrame(kept.collect(), kept.schema)
    rows = final.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in docs.collect())
    sizes = Counter(r["shard"] for r in rows)
    assert len(sizes) == corpus_pipeline.SHARDS and max(sizes.values()) - min(sizes.values()) <= 1


def test_stages_on_odd_documents(spark, odd_docs, no_docs):
    model = language.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert language.accepted(odd_docs, model).count() > 0
    docs = odd_docs.withColumn("digest", odd_docs.lang).withColumn("_src", odd_docs.source)
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF_DIR)
        held = {tuple(r) for r in docs.collect()}
        if stage is not corpus_pipeline.shard:
            assert kept.columns == docs.columns and {tuple(r) for r in kept.collect()} <= held
        else:
            assert kept.count() == docs.count()
        assert stage(spark, no_docs, SF_DIR).collect() == []
        docs = spark.createDataFrame(kept.collect() or [], kept.schema) if stage is not corpus_pipeline.shard else docs


def test_the_last_stage_keeps_all_columns_in_files_by_shard(spark, odd_docs, tmp_path):
    docs = odd_docs.withColumn("slot", odd_docs.source).withColumn("url", odd_docs.lang)
    kept = corpus_pipeline.shard(spark, docs, SF_DIR)
    assert kept.columns[-6:] == ["text", "lang", "source", "n_chars", "_slot", "url"]
    held = Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], r["slot"], r["url"]) for r in docs.collect())
    assert Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], r["_slot"], r["url"]) for r in kept.collect()) == held
    kept.write.parquet(str(tmp_path / "out"))
    runs = []
    for file in (tmp_path / "out").glob("*.parquet"):
        own = [(r["shard"], r["slot"]) for r in spark.read.parquet(str(file)).collect()]
        assert own == sorted(own)
        runs.append((own[0], own[-1]))
    assert all(a[1] < b[0] for a, b in zip(sorted(runs), sorted(runs)[1:]))


def test_a_run_leaves_its_result_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda spark: f"file:{tmp_path}/shared")
    rows = corpus_pipeline.run(spark, SF_DIR)
    left = [p.name for p in (tmp_path / "shared").iterdir()]
    assert len(left) == 1 and left[0].startswith("llm-pipeline-4-")
    assert rows.count() > 0 and {"n_chars", "text", "lang", "source"} <= set(rows.columns)
