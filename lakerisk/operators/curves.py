"""Points of the evaluation curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.operators.evaluation import RUN, score_ladder, walk
from lakerisk.session import stage_table


def precision_recall_points(preds: DataFrame, groups: Sequence[str] = RUN) -> DataFrame:
    """Precision and recall at every distinct score, and the closing point (1, 0).

    Groups without positives have no curve.
    """
    ladder = score_ladder(preds, groups).filter(F.col("p_upto_all") > 0)
    points = ladder.select(
        *groups,
        F.col("score").alias("threshold"),
        (F.col("p_upto") / F.col("n_upto")).alias("precision"),
        (F.col("p_upto") / F.col("p_upto_all")).alias("recall"),
    )
    closing = points.select(
        *groups, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    ).distinct()
    return points.unionByName(closing)


def roc_points(preds: DataFrame, groups: Sequence[str] = RUN) -> DataFrame:
    """False and true positive rate at every distinct score, and the origin."""
    negatives = F.col("n_upto_all") - F.col("p_upto_all")
    ladder = score_ladder(preds, groups).filter((F.col("p_upto_all") > 0) & (negatives > 0))
    points = ladder.select(
        *groups,
        F.col("score").alias("threshold"),
        ((F.col("n_upto") - F.col("p_upto")) / negatives).alias("false_rate"),
        (F.col("p_upto") / F.col("p_upto_all")).alias("true_rate"),
    )
    origin = points.select(
        *groups, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("false_rate"), F.lit(0.0).alias("true_rate")
    ).distinct()
    return points.unionByName(origin)


def gain_lift_points(preds: DataFrame, groups: Sequence[str] = RUN) -> DataFrame:
    """Share reviewed, share of positives captured, and lift, at every rank."""
    rows = walk(preds, groups).filter(F.col("hits_all") > 0)
    prevalence = F.col("hits_all") / F.col("rank_all")
    return rows.select(
        *groups,
        "rank",
        (F.col("rank") / F.col("rank_all") * 100).alias("reviewed_pct"),
        (F.col("hits") / F.col("hits_all") * 100).alias("captured_pct"),
        ((F.col("hits") / F.col("rank")) / prevalence).alias("lift"),
    )


def calibration_points(preds: DataFrame, groups: Sequence[str] = RUN, bins: int = 10) -> DataFrame:
    """Mean score and positive share per uniform bin, upper edge included; empty bins absent."""
    step = 1.0 / bins
    past = [(F.col("score") > F.lit(i * step)).cast("int") for i in range(1, bins)]
    return preds.groupBy(*groups, sum(past, F.lit(0)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("score").alias("mean_score"),
        F.avg(F.col("label").cast("double")).alias("positive_share"),
    )


def density_points(preds: DataFrame, groups: Sequence[str] = RUN, bins: int = 40) -> DataFrame:
    """Histogram density per label over the label's own score range.

    A label with a single score gets a range of one around it. The ranges are one row
    per group, found by a map-side aggregate and joined back.
    """
    keys = [*groups, "label"]
    ranges = preds.groupBy(*keys).agg(
        F.min("score").alias("_min"), F.max("score").alias("_max"), F.count(F.lit(1)).alias("_of")
    )
    flat = F.col("_min") == F.col("_max")
    low = F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min"))
    high = F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max"))
    # Stored, so that its true size (a row per group) decides how it is joined.
    ranges = stage_table(ranges.select(*keys, low.alias("_low"), ((high - low) / bins).alias("width"), "_of"), "ranges")
    place = F.least(F.floor((F.col("score") - F.col("_low")) / F.col("width")).cast("int"), F.lit(bins - 1))
    counted = preds.join(ranges, keys).groupBy(*keys, place.alias("bin"), "_low", "width", "_of").agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(
        *keys,
        "bin",
        (F.col("_low") + F.col("bin") * F.col("width")).alias("bin_start"),
        "n",
        (F.col("n") / (F.col("_of") * F.col("width"))).alias("density"),
    )


def score_histogram(preds: DataFrame, groups: Sequence[str] = (*RUN, "label"), bins: int = 20, clamp: bool = True) -> DataFrame:
    """Rows and mean score per bin; with `clamp`, a score of 1 joins the last bin."""
    place = F.floor(F.col("score") * bins).cast("int")
    if clamp:
        place = F.least(place, F.lit(bins - 1))
    return preds.groupBy(*groups, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score")
    )
