"""Exact quantiles of a whole column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.operators.selection import quantile_ends


def exact_quantiles(df: DataFrame, column: str, wanted: Mapping[str, float], groups: Sequence[str] = ()) -> DataFrame:
    """One row per group with the named quantiles, linear between neighbours.

    The neighbours are found by refining histograms, so no row is sorted or exchanged, and unlike with an exact
    percentile aggregate, no task ever holds all distinct values.
    """
    ends = quantile_ends(df, F.col(column), wanted, groups)
    low, high, part = (lambda n, p=p: F.col(f"{p}_{n}") for p in ("low", "high", "part"))
    return ends.select(*groups, *[(low(n) + (high(n) - low(n)) * part(n)).alias(n) for n in wanted])
