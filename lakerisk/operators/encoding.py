"""Out-of-fold target encoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.config import ENCODING_WEIGHT
from lakerisk.session import stage_table

_COHORT_SIZE = 100_000


def standard_encodings() -> list[tuple[str, list[str], Column]]:
    """(name, needed columns, category) of the encodings of the curated table.

    The cohort separates the id kinds, because each kind numbers its ids on its own.
    """
    cohort = F.floor(F.col("id_sequence") / _COHORT_SIZE).cast("long").cast("string")
    return [
        ("te_activity", ["activity"], F.col("activity")),
        ("te_activity_region", ["activity", "region"], F.concat("activity", F.lit("|"), "region")),
        ("te_cohort", ["id", "id_sequence"], F.concat(F.substring("id", 1, 2), F.lit("|"), cohort)),
    ]


def fold_count(train: DataFrame) -> int:
    """Folds of the train rows, numbered from 0; one without rows counts too."""
    return (train.agg(F.max("fold").alias("last")).first()["last"] or 0) + 1


def category_rates(train: DataFrame, key: Column, folds: int, weight: Column | None = None) -> DataFrame:
    """One row per category: rows and positives in all, and in each fold.

    A fixed number of conditional sums replaces a (category, fold) table and its
    window, so one aggregate with map-side combining is all that is shuffled.
    """
    one = F.lit(1) if weight is None else weight
    hits = one * F.col("label")
    in_fold = lambda k, value: F.sum(F.when(F.col("fold") == k, value).otherwise(F.lit(0)))
    return (
        train.withColumn("_key", key)
        .filter(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(
            F.sum(one).alias("_n"),
            F.sum(hits).alias("_p"),
            *[in_fold(k, one).alias(f"_n{k}") for k in range(folds)],
            *[in_fold(k, hits).alias(f"_p{k}") for k in range(folds)],
        )
    )


def _own_fold(prefix: str, rates: DataFrame) -> Column:
    own = F.lit(0)
    for k in (c.removeprefix(prefix) for c in rates.columns if c.startswith(prefix) and c != prefix):
        own = F.when(F.col("fold") == int(k), F.col(f"{prefix}{k}")).otherwise(own)
    return own


def apply_rates(
    rows: DataFrame, rates: DataFrame, key: Column, name: str, prevalence: Column, m: float
) -> DataFrame:
    """Smoothed rate (p + m*prevalence) / (n + m) of each row's category.

    A row in a fold the rates were fitted on leaves its own fold out; any other row
    (test, or a validation fold) uses all of it. An unknown or null category gets the
    prevalence.
    """
    zero = F.lit(0)
    n = F.coalesce(F.col("_n"), zero) - F.coalesce(_own_fold("_n", rates), zero)
    p = F.coalesce(F.col("_p"), zero) - F.coalesce(_own_fold("_p", rates), zero)
    rate = (p + F.lit(float(m)) * prevalence) / (n + F.lit(float(m)))
    joined = rows.withColumn("_key", key).join(rates, "_key", "left").withColumn(name, rate.cast("double"))
    return joined.select(*rows.columns, name)


def encode_out_of_fold(
    dataset: DataFrame,
    key: Column,
    name: str,
    m: float = ENCODING_WEIGHT,
    folds: int | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Add `name`: the encoding fitted on the train part, never on a row's own fold."""
    return encode_all(dataset, [(name, key)], m, folds, weight)


def encode_all(
    dataset: DataFrame,
    encodings: Sequence[tuple[str, Column]],
    m: float = ENCODING_WEIGHT,
    folds: int | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Add several encodings, all fitted on the rows as given; the folds are those of the train rows unless given.

    Pass a stored table: the rates of every encoding and the prevalence read it once
    each, with only the columns they need. The rates are stored too: with a known size
    the planner can broadcast them, and the wide rows are not shuffled for a category
    that may hold a third of them; a large table is joined by AQE's skew join.
    """
    train = dataset.filter(F.col("split") == "train")
    folds = fold_count(train) if folds is None else folds
    one = F.lit(1) if weight is None else weight
    mean = F.sum(one * F.col("label")).cast("double") / F.nullif(F.sum(one).cast("double"), F.lit(0.0))
    prevalence = train.select(F.coalesce(mean, F.lit(0.0)).alias("prevalence")).scalar()
    out = dataset
    for name, key in encodings:
        rates = stage_table(category_rates(train, key, folds, weight), "rates")
        out = apply_rates(out, rates, key, name, prevalence, m)
    return out


def negative_weight(dataset: DataFrame, per_positive: int) -> Column:
    """Weight of a row when negatives are sampled: a kept negative stands for
    n_neg / (ratio * n_pos) of them, never less than 1."""
    train = dataset.filter(F.col("split") == "train")
    positives = F.count_if(F.col("label") == 1)
    stands_for = F.greatest(
        F.lit(1.0), (F.count(F.lit(1)) - positives) / F.nullif(positives * per_positive, F.lit(0))
    )
    weight = train.select(F.coalesce(stands_for, F.lit(1.0)).alias("weight")).scalar()
    return F.when(F.col("label") == 1, F.lit(1.0)).otherwise(weight)
