"""Dashboard views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.config import RUN_PREFIX
from lakerisk.functions.numbers import percent, quadrant, ratio
from lakerisk.operators.curves import score_histogram
from lakerisk.operators.ranking import flag_latest_runs, top_per_split, version_months
from lakerisk.operators.selection import rank_cuts, ranked_score
from lakerisk.session import stage_table

# Quadrant labels.
QUADRANTS = (
    "Alto RUC / Alta Informalidad",
    "Alto RUC / Baja Informalidad",
    "Bajo RUC / Alta Informalidad",
    "Bajo RUC / Baja Informalidad",
)
RANKING_FEATURES = [
    "entity_type", "activity", "workers", "n_orders", "total_amount", "n_buyers", "excluded", "affiliated",
    "contract_age_days", "aff_age_days", "aff_n_types", "status_changed", "billing_changed", "months_gap",
    "new_in_period", "months_seen",
]


def active_share(summary: DataFrame) -> DataFrame:
    """Active entities per region with their share of the country."""
    total = summary.select(F.sum("active_entities").alias("n")).scalar()
    return summary.select(
        "region", "active_entities", percent(F.col("active_entities"), total, 2).alias("share_pct")
    ).orderBy(F.col("active_entities").desc(), "region")


def exclusion_concentration(summary: DataFrame) -> DataFrame:
    """Excluded entities against active ones, and the region's share of revenue."""
    revenue = summary.select(F.sum("revenue").alias("n")).scalar()
    return summary.select(
        "region",
        "excluded_entities",
        "active_entities",
        percent(F.col("excluded_entities"), F.col("active_entities"), 4).alias("excluded_pct_of_active"),
        "revenue",
        percent(F.col("revenue"), revenue, 2).alias("revenue_share_pct"),
    ).orderBy(F.col("excluded_pct_of_active").desc_nulls_last(), "region")


def quadrants(summary: DataFrame) -> DataFrame:
    """Regions against the national medians; the one-row medians are scalar subqueries."""
    middle = F.struct(
        F.percentile_approx("active_entities", 0.5).alias("a"), F.percentile_approx("informal_pct", 0.5).alias("i")
    )
    mid = summary.select(middle.alias("mid")).scalar()
    with_mid = summary.withColumns({"active_median": mid["a"], "informal_median": mid["i"]})
    label = quadrant(
        F.col("active_entities"), F.col("informal_pct"), F.col("active_median"), F.col("informal_median"), QUADRANTS
    )
    return with_mid.select(
        "region", "active_entities", "informal_pct", label.alias("quadrant"), "active_median", "informal_median"
    ).orderBy(F.col("informal_pct").desc_nulls_last(), "region")


def audit_ranking(preds: DataFrame, runs: DataFrame, features: DataFrame, k: int = 1000, prefix: str = RUN_PREFIX) -> DataFrame:
    """The k riskiest entities of every run and split, with the features of the run's month.

    The ranking is cut before any join, so the feature table meets k rows per group.
    """
    top = top_per_split(preds, k).drop("n_in_split")
    months = version_months(preds.sparkSession)
    flagged = flag_latest_runs(runs, prefix).join(months, "dataset_version")
    facts = features.select(
        F.col("ref_month").cast("string").alias("ref_month"),
        F.col("entity_id").cast("string").alias("id"),
        *RANKING_FEATURES,
    )
    rows = top.withColumn("id", F.col("id").cast("string")).join(flagged, "run_id")
    return rows.join(facts, ["ref_month", "id"], "left").drop("ref_month")


def score_distribution(preds: DataFrame, runs: DataFrame, metrics: DataFrame, prefix: str = RUN_PREFIX) -> DataFrame:
    """Score histogram per run, split and label; test metrics on the test rows only."""
    bins = score_histogram(preds)
    whole = bins.groupBy("run_id", "split", "label").agg(F.sum("n").alias("_of"))
    scored = metrics.select("run_id", F.lit("test").alias("split"), "pr_auc", "roc_auc")
    return (
        bins.join(whole, ["run_id", "split", "label"])
        .join(flag_latest_runs(runs, prefix), "run_id")
        .join(scored, ["run_id", "split"], "left")
        .select(
            "run_id", "model_name", "variant", "dataset_version", "experiment", "is_latest", "split", "label",
            "bin",
            (F.col("bin") / 20.0).alias("bin_start"),
            ((F.col("bin") + 1) / 20.0).alias("bin_end"),
            "n",
            F.round("mean_score", 4).alias("mean_score"),
            (F.col("n") / F.col("_of")).alias("bin_share"),
            "pr_auc",
            "roc_auc",
        )
    )


def regional_panorama(summary: DataFrame, preds: DataFrame, runs: DataFrame, prefix: str = RUN_PREFIX) -> DataFrame:
    """Regional figures with the model's risk per region, run and split.

    A region counts its rows in the top 1 % of its run and split: rank <= n/100,
    without a ceiling, which differs from the cut-off of the official metrics. The row where
    that share ends is found by histograms of the scores, so the rows themselves are not sorted.
    """
    rows = stage_table(preds.select("run_id", "split", "id", "score", "label", F.upper(F.trim("region")).alias("place")), "scored")
    cuts = rank_cuts(rows, {"top": F.floor(F.col("n") * 0.01)}, ["run_id", "split"], stored=True)
    ends = cuts.select(F.col("run_id").alias("_run"), F.col("split").alias("_split"), "cut_score", "cut_id")
    marked = rows.join(ends, [F.col("run_id").eqNullSafe(F.col("_run")), F.col("split").eqNullSafe(F.col("_split"))], "left")
    tied = (ranked_score(F.col("score")) == F.col("cut_score")) & (F.col("cut_id").isNull() | (F.col("id") <= F.col("cut_id")))
    in_top = (ranked_score(F.col("score")) > F.col("cut_score")) | tied
    model = marked.groupBy("run_id", "split", "place").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.sum("label").alias("n_positives"),
        F.avg("score").alias("mean_score"),
        F.count_if(in_top).alias("n_top_1pct"),
    )
    named = summary.withColumn("place", F.upper(F.trim("region")))
    return (
        named.join(model, "place", "left")
        .join(flag_latest_runs(runs, prefix), "run_id", "left")
        .select(
            "region", "active_entities", "informal_pct", "revenue", "excluded_entities",
            percent(F.col("excluded_entities"), F.col("active_entities"), 4).alias("excluded_pct_of_active"),
            "run_id", "model_name", "variant", "dataset_version", "experiment", "is_latest", "split",
            "n_scored", "n_positives",
            F.round("mean_score", 4).alias("mean_score"),
            "n_top_1pct",
            ratio(F.col("n_top_1pct"), F.col("n_scored")).alias("top_1pct_share"),
        )
    )


LEADERBOARD_METRICS = [
    "pr_auc", "pr_auc_low", "pr_auc_high", "roc_auc", "recall_1pct", "precision_1pct", "lift_1pct",
    "recall_5pct", "precision_5pct", "lift_5pct", "recall_capital", "recall_rest", "brier",
    "tp_1pct", "fp_1pct", "fn_1pct", "tn_1pct", "instance", "billable_seconds", "cost_usd",
]


def leaderboard(records: DataFrame, metrics: DataFrame) -> DataFrame:
    """Run records with their test metrics, best average precision first."""
    runs = records.select(
        "run_id", "model_name", "variant", "dataset_version", F.col("usa_pesos").alias("weighted"),
        F.col("metricas_cv.cv_pr_auc_mean").alias("cv_pr_auc_mean"),
        F.col("metricas_cv.cv_pr_auc_std").alias("cv_pr_auc_std"),
        "n_train", "n_test",
        F.col("n_positivos_train").alias("n_positives_train"),
        F.col("n_positivos_test").alias("n_positives_test"),
        F.col("fecha").alias("run_date"),
    )
    return runs.join(metrics.select("run_id", *LEADERBOARD_METRICS), "run_id").orderBy(
        F.col("pr_auc").desc_nulls_last(), F.col("run_date").desc(), "run_id"
    )
