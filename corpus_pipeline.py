"""The corpus pipeline: documents through five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.llm import decontamination, mixing, ngram_join, passages, quality
from lakerisk.session import drop_staged, stage_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    scored = quality.score(docs, quality.training_model(spark, sf_dir))
    return scored.filter(F.col("score") >= quality.CUT).select(docs.columns)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.keep_one(docs, ngram_join.jaccard_join(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds as well are cut out; a text of nothing else goes."""
    return passages.remove_repeats(docs, passages.repeated_passages(docs))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document that is left."""
    return mixing.digest(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_copy),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix_sources),
]

# The classifier, the chains and the draws of the mix have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, stage_table(stage(spark, docs, sf_dir), name.split()[0])
        drop_staged(before)
    return docs
