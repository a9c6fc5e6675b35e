"""Ranked prediction tables and their readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.config import DATASET_CUTOFFS, RUN_PREFIX
from lakerisk.functions.text import experiment_of
from lakerisk.operators.ordering import with_rank

# Parts a group is cut into before its highest rows are chosen.
PARTS = 64


def by_score() -> list[Column]:
    """Score descending, id ascending: the one order used for every ranking."""
    return [F.col("score").desc(), F.col("id").asc()]


def rank_population(scored: DataFrame) -> DataFrame:
    """Global rank over everything scored, 1 = highest risk."""
    return with_rank(scored, by_score(), (), "rank_global")


def part_sizes(preds: DataFrame) -> DataFrame:
    return preds.groupBy("run_id", "split").agg(F.count(F.lit(1)).alias("n_in_split"))


def rank_in_split(preds: DataFrame) -> DataFrame:
    """Rank, size and percentile of every row inside its run and split."""
    ranked = with_rank(preds, by_score(), ["run_id", "split"], "rank_in_split", total="n_in_split")
    return ranked.withColumn("rank_percentile", F.col("rank_in_split") / F.col("n_in_split"))


def _first_k(rows: DataFrame, groups: list[str], k: int, name: str) -> DataFrame:
    """The k highest of every group, numbered in `name`.

    Two levels: the k highest of each part of a group (parts by hash of the id), then those of
    the group. The limit applies before each shuffle, so however many tasks hold rows of a hot
    group, its last task meets at most k rows of each part.
    """
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS))
    inside = Window.partitionBy(*groups, "_part").orderBy(*by_score())
    whole = Window.partitionBy(*groups).orderBy(*by_score())
    leading = rows.withColumn("_part", part).withColumn("_turn", F.row_number().over(inside)).filter(F.col("_turn") <= k)
    numbered = leading.drop("_part", "_turn").withColumn(name, F.row_number().over(whole).cast("long"))
    return numbered.filter(F.col(name) <= k)


def top_per_split(preds: DataFrame, k: int = 1000) -> DataFrame:
    """The k highest of every run and split, with size and percentile.

    The size is a separate small aggregate.
    """
    top = _first_k(preds, ["run_id", "split"], k, "rank_in_split")
    return top.join(part_sizes(preds), ["run_id", "split"]).withColumn(
        "rank_percentile", F.col("rank_in_split") / F.col("n_in_split")
    )


def top_per_region(ranked: DataFrame, k: int = 20) -> DataFrame:
    """The k highest per run, split and region; rows without region are left out.

    Equal scores are ordered by id, so that the result is repeatable.
    """
    return _first_k(ranked.filter(F.col("region").isNotNull()), ["run_id", "split", "region"], k, "rank_in_region")


def flag_latest_runs(runs: DataFrame, prefix: str = RUN_PREFIX) -> DataFrame:
    """Experiment of each run, and 1 for the newest run of its experiment and version."""
    named = runs.withColumn("experiment", experiment_of(F.col("run_id"), prefix))
    window = Window.partitionBy(F.coalesce("experiment", "run_id"), "dataset_version").orderBy(
        F.col("run_date").desc(), F.col("run_id").desc()
    )
    newest = F.when(F.row_number().over(window) == 1, 1).otherwise(0)
    return named.withColumn("is_latest", newest).select(
        "run_id", "model_name", "variant", "dataset_version", "experiment", "is_latest"
    )


def version_months(spark) -> DataFrame:
    """Dataset version to snapshot month, as a small table."""
    rows = [(version, month) for version, (month, _) in DATASET_CUTOFFS.items()]
    return spark.createDataFrame(rows, "dataset_version string, ref_month string")
