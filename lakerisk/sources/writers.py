"""Writers: partitioned tables, quarantines, small files and safe publication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.config import staging_path
from lakerisk.functions.numbers import finite_or_null
from lakerisk.sources.readers import written_rows


class PublishError(RuntimeError):
    """A staged table is not what was expected; the live path was left untouched."""


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], only_touched: bool = False) -> None:
    """Overwrite a partitioned table, or only the partitions present in `df`."""
    mode = "dynamic" if only_touched else "static"
    df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*by).parquet(path)


def write_whole(df: DataFrame, path: str) -> None:
    """Overwrite even with no rows, so that no stale rows remain."""
    df.write.mode("overwrite").parquet(path)


def write_if_any(df: DataFrame, path: str, by: Sequence[str]) -> bool:
    """Write only a non-empty frame; tells whether it did."""
    if df.isEmpty():
        return False
    write_partitioned(df, path, by)
    return True


def write_single_file(df: DataFrame, path: str) -> None:
    """One file, for tables of a few dozen rows such as the regional summary."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_metric_rows(df: DataFrame, path: str) -> None:
    """Flat metric rows as NDJSON; NaN and infinities become null, nulls are written."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    clean = df.withColumns({c: finite_or_null(F.col(c)) for c in doubles})
    clean.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop.Path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a staged table if there is one."""
    fs, to_path = _file_system(spark, path)
    fs.delete(to_path(path), True)


def publish(spark: SparkSession, live: str, expected_rows: int | None = None, optional: bool = False) -> int:
    """Move the staged table over the live one once its rows are verified.

    An optional output that was not staged clears its live path, so that the live
    table never shows rows of an earlier run. Returns the published row count.
    """
    staged = staging_path(live)
    fs, to_path = _file_system(spark, live)
    if not fs.exists(to_path(staged)):
        if not optional:
            raise PublishError(f"nothing staged at {staged}")
        fs.delete(to_path(live), True)
        return 0
    rows = written_rows(spark, staged)
    if expected_rows is not None and rows != expected_rows:
        raise PublishError(f"{staged} holds {rows} rows, expected {expected_rows}")
    previous = to_path(f"{live.rstrip('/')}.previous")
    fs.delete(previous, True)
    fs.mkdirs(to_path(live).getParent())
    had_live = fs.exists(to_path(live))
    if had_live and not fs.rename(to_path(live), previous):
        raise PublishError(f"cannot set {live} aside")
    if not fs.rename(to_path(staged), to_path(live)):
        if had_live:
            fs.rename(previous, to_path(live))
        raise PublishError(f"cannot move {staged} to {live}")
    fs.delete(previous, True)
    return rows
