"""Removal of repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Any one row per key; choose it by `keep_first` when the rows differ."""
    return df.dropDuplicates(list(keys))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key by `order`; equal rows are told apart by a hash of all columns.

    Spark turns ``row_number = 1`` into a group limit that runs before the shuffle, so
    a key with very many rows sends one row per task.
    """
    tie = F.xxhash64(*df.columns)
    ranked = df.withColumn(
        "_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order, tie))
    )
    return ranked.filter(F.col("_nth") == 1).drop("_nth")


def keep_latest_order(df: DataFrame) -> DataFrame:
    """Latest load of each order number; rows without a number pass untouched."""
    newest = [F.col("year").desc(), F.col("month").desc()]
    if "issue_date" in df.columns:
        newest.append(F.col("issue_date").desc())
    numbered = df.filter(F.col("order_no").isNotNull())
    return keep_first(numbered, ["order_no"], newest).unionByName(
        df.filter(F.col("order_no").isNull())
    )


def registry_snapshot(df: DataFrame) -> DataFrame:
    """One row per entity and publication period."""
    return keep_first(df, ["entity_id", "period"], [F.col("entity_id")])
