"""A training corpus from ``documents``: language, near duplicates, benchmark passages, mixture, shards.

Each stage takes the documents that the one before it kept and returns documents in the same columns; the last
one returns all of them in shards. Between stages they are written as Parquet to the shared folder and read again, so a lost
executor costs the stage at hand. What a stage leaves in the shared folder goes once the next table is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakehist.llm import language
from lakehist.llm.common import scratch, scratch_folder
from lakehist.llm.decontaminate import decontaminated
from lakehist.llm.minhash import deduplicated
from lakehist.llm.mixing import mixed_documents
from lakehist.llm.sharding import hilbert_shards, laid_out
from lakehist.sources.files import delete

SHARDS = 24


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach; those without a letter or hardly likelier in one than in all go."""
    return language.accepted(docs, language.fit(docs.where(language.in_training())))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest identifier."""
    return deduplicated(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten consecutive words with a benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; documents come as often as the mix takes them."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with all their columns in shards along a Hilbert curve over source, language and size, laid out by shard and
    slot: a file is a run of the curve."""
    return laid_out(hilbert_shards(docs, SHARDS, carry=[c for c in docs.columns if c.lower() != "doc_id"]))


STAGES = [
    ("language identification", identify_language),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("source mixture", mix_sources),
    ("shards", shard),
]

#: The stages are trained, hashed and permuted; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"pipeline-{i}")
        with scratch_folder(spark, f"pipeline-{i}-work"):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            delete(spark, before)
        before = path
    return docs
