"""Run records: leaderboard, matrix gaps, champion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.functions.numbers import clean_number

# Fixed value: the experiments of the official matrix, in order.
OFFICIAL_RUNS = ["E1", "E2", "E3", "E4", "E5", "E6"]


def consolidate(records: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """One row per run with its test metrics, best cross-validation score first."""
    cv = F.col("metricas_cv")
    base = records.select(
        "run_id",
        F.col("model_name").alias("model"),
        "variant",
        F.when(F.coalesce("usa_pesos", F.lit(True)), "yes").otherwise("no").alias("weighted"),
        F.col("dataset_version").alias("dataset"),
        cv["cv_pr_auc_mean"].alias("cv_pr_auc"),
        cv["train_pr_auc"].alias("train_pr_auc"),
        F.col("segundos_entrenamiento").alias("seconds"),
    )
    names = ["pr_auc", "pr_auc_low", "pr_auc_high", "recall_1pct", "recall_5pct", "lift_1pct", "brier"]
    if metrics is None:
        return base.withColumns({f"test_{n}": F.lit(None).cast("double") for n in names})
    test = metrics.filter(F.lower("split") == "test").select("run_id", *[F.col(n).alias(f"test_{n}") for n in names])
    return base.join(test, "run_id", "left").orderBy(F.col("cv_pr_auc").desc_nulls_last(), "run_id")


def matrix_gaps(records: DataFrame, expected: Sequence[str] = OFFICIAL_RUNS) -> DataFrame:
    """Each expected experiment and whether a run was found for it.

    A run counts for the first expected code, in list order, that its id contains.
    """
    spark = records.sparkSession
    wanted = spark.createDataFrame([(c,) for c in expected], "experiment string")
    run = F.upper(F.trim(F.coalesce("run_id", F.lit(""))))
    first = F.coalesce(*[F.when(run.contains(c), F.lit(c)) for c in expected])
    found = records.select(first.alias("experiment")).filter(F.col("experiment").isNotNull()).distinct()
    return wanted.join(found.withColumn("found", F.lit(True)), "experiment", "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def run_summary(records: DataFrame) -> DataFrame:
    """Leaderboard row of a run record: fold mean and population spread, overfit gap.

    A record without the recall field keeps it null: it is unknown, not zero.
    """
    cv = F.col("metricas_cv")
    mean = F.coalesce(cv["cv_pr_auc_mean"], F.lit(0.0))
    train = F.coalesce(cv["train_pr_auc"], F.lit(0.0))
    scores = F.array_compact(F.coalesce(cv["cv_pr_auc_folds"], F.array().cast("array<double>")))
    count = F.size(scores)
    centre = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.nullif(count, F.lit(0))
    spread = F.sqrt(F.aggregate(scores, F.lit(0.0), lambda a, x: a + (x - centre) * (x - centre)) / F.nullif(count, F.lit(0)))
    return records.withColumns(
        {
            "cv_pr_auc_mean": mean,
            "cv_pr_auc_std": F.coalesce(spread, F.lit(0.0)),
            "cv_recall_1pct_mean": cv["cv_recall_1pct_mean"],
            "cv_recall_1pct_std": F.coalesce(cv["cv_recall_1pct_std"], F.lit(0.0)),
            "train_pr_auc": train,
            "overfit_gap": F.round(train - mean, 4),
        }
    )


def choose_champion(results: DataFrame) -> DataFrame:
    """Champion and challenger among successful V2 runs of the block scheme.

    Highest cross-validated recall at 1 %, then average precision, then the linear
    model. When any candidate lacks the recall, it is ignored for all of them. A run
    id breaks the remaining ties.
    """
    scheme = F.coalesce("cv_scheme", F.lit("bloques"))
    candidates = results.filter(
        (F.col("status") == "SUCCESS") & (F.col("variant") == "V2") & (scheme != "temporal")
    )
    complete = candidates.select(F.count_if(F.col("cv_recall_1pct_mean").isNull()).alias("n")).scalar() == 0
    zero = F.lit(0.0)
    ranked = candidates.select(
        "run_id",
        "model_name",
        F.coalesce("cv_pr_auc_mean", zero).alias("cv_pr_auc_mean"),
        F.coalesce("cv_recall_1pct_mean", zero).alias("cv_recall_1pct_mean"),
        F.when(complete, F.coalesce("cv_recall_1pct_mean", zero)).otherwise(zero).alias("_recall"),
    )
    order = [
        F.col("_recall").desc(),
        F.col("cv_pr_auc_mean").desc(),
        (F.col("model_name") == "LR").desc(),
        F.col("run_id").asc(),
    ]
    # The window only ever sees the two rows the limit leaves.
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(*order))
    role = F.when(place == 1, "champion").otherwise("challenger")
    return ranked.orderBy(*order).limit(2).withColumn("role", role).drop("_recall")


def best_parameters(grid: DataFrame) -> DataFrame:
    """The setting with the highest mean recall at 1 %, then the highest mean precision."""
    return grid.orderBy(F.col("recall_1pct").desc(), F.col("pr_auc").desc(), "setting").limit(1)


def clean_record_numbers(records: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Numbers of a run record: NaN, null and unreadable become 0, the rest is rounded."""
    return records.withColumns({c: clean_number(F.col(c), digits) for c in columns})
