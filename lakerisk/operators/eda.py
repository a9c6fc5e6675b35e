"""Exploratory tables."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.numbers import percent
from lakerisk.operators.quantiles import exact_quantiles


def class_balance(df: DataFrame, target: str = "positive") -> DataFrame:
    """One row: counts per class, negatives per positive, prevalence in percent."""
    counted = df.agg(F.count_if(F.col(target)).alias("positives"), F.count_if(~F.col(target)).alias("negatives"))
    pos, neg = F.col("positives"), F.col("negatives")
    return counted.withColumns(
        {"negatives_per_positive": neg / F.nullif(pos, F.lit(0)), "prevalence_pct": pos / F.nullif(pos + neg, F.lit(0)) * 100}
    )


def incidence(df: DataFrame, by: str, target: str = "positive") -> DataFrame:
    """Rows, positives and incidence in percent (4 decimals) per value."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(target)).alias("positives")
    ).withColumn("rate_pct", percent(F.col("positives"), F.col("rows"), 4))


def frequencies(df: DataFrame, by: str) -> DataFrame:
    """Rows per value with their share of the total."""
    total = df.select(F.count(F.lit(1)).alias("n")).scalar()
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows")).withColumn("share_pct", percent(F.col("rows"), total, 2))


def correlations(df: DataFrame, columns: Sequence[str], strong: float = 0.7) -> DataFrame:
    """Pearson correlation of every pair in one aggregate; `strong` marks collinear pairs."""
    pairs = list(combinations(columns, 2))
    as_number = lambda c: F.col(c).cast("double")
    both = lambda a, b: F.col(a).isNotNull() & F.col(b).isNotNull()
    wide = df.agg(
        *[
            F.corr(F.when(both(a, b), as_number(a)), F.when(both(a, b), as_number(b))).alias(f"r{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = F.array(
        *[F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"r{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    )
    return wide.select(F.inline(rows)).withColumn("is_strong", F.coalesce(F.abs("r") >= strong, F.lit(False)))


def describe(df: DataFrame, value: str, by: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """Count, mean, spread, minimum, quartiles and maximum of the positive values.

    Quartiles are mergeable sketches in the same pass, unless `exact` asks for an
    ordered pass over the distinct values.
    """
    marks = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    positive = df.filter(F.col(value) > 0).select(*by, F.col(value).cast("double").alias("x"))
    sketches = [] if exact else [F.percentile_approx("x", q, 10000).alias(n) for n, q in marks.items()]
    summary = positive.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("spread"),
        F.min("x").alias("least"),
        *sketches,
        F.max("x").alias("greatest"),
    )
    if not exact:
        return summary
    quartiles = exact_quantiles(positive, "x", marks, by).withColumnsRenamed({c: f"_{c}" for c in by})
    if not by:
        return summary.withColumns({n: quartiles.select(n).scalar() for n in marks})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return summary.join(quartiles, same).drop(*[f"_{c}" for c in by])


def value_histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """Equal-width histogram of the positive values, upper edge in the last bin."""
    positive = df.filter(F.col(value) > 0).select(F.col(value).cast("double").alias("x"))
    ends = positive.select(F.struct(F.min("x").alias("low"), F.max("x").alias("high")).alias("ends")).scalar()
    low, high = ends["low"], ends["high"]
    width = F.nullif((high - low) / bins, F.lit(0.0))
    place = F.coalesce(F.least(F.floor((F.col("x") - low) / width).cast("int"), F.lit(bins - 1)), F.lit(0))
    return positive.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def regional_table(summary: DataFrame) -> DataFrame:
    """The four regional figures, revenue in millions, by active entities."""
    return summary.select(
        "region",
        "active_entities",
        F.round("informal_pct", 2).alias("informal_pct"),
        "excluded_entities",
        F.round(F.col("revenue") / 1e6, 2).alias("revenue_millions"),
    ).orderBy(F.col("active_entities").desc(), "region")
