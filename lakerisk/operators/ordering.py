"""Exact global ranks and running totals without a single-task window.

A window ordered over a whole table (or over a label with two values) runs in one
task. Here Spark range-partitions the rows by (group, order keys), each slice is
numbered where it lies, and the slice totals (one row per slice and group) give the
offset of every slice. A group of any size is spread over many slices, because the
range keys end in a unique key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.session import stage_table

# monotonically_increasing_id keeps the partition number above bit 33.
_SLICE_BITS = 33
# Rows of a group, counted beforehand, up to which callers may use a plain window in place of slices.
WINDOW_ROWS = 1_000_000


def _attach(rows: DataFrame, slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of the slice table; a null group matches itself.

    The slice table is stored first, so the planner knows its true size: it broadcasts
    it when that is small (one row per slice, plus one per group) and shuffles both
    sides when a caller has very many groups.
    """
    renamed = stage_table(slices, "slices").withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return rows.join(renamed, same, "left")


def _sliced(df: DataFrame, groups: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Sort globally and store each row with its slice number and place."""
    ordered = df.orderBy(*[F.col(g) for g in groups], *order)
    place = F.monotonically_increasing_id()
    return stage_table(ordered.withColumn("_place", place), "ordered").withColumn(
        "_slice", F.shiftright("_place", _SLICE_BITS)
    )


def with_rank(
    df: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    name: str = "rank",
    total: str | None = None,
) -> DataFrame:
    """Row number (1-based) inside `groups` by `order`; `order` must be a total order.

    `total` names an optional column with the group's row count. Use it where groups
    are few and large; many small groups are better served by a plain window.
    """
    rows = _sliced(df, groups, order)
    slices = rows.groupBy(*groups, "_slice").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = slices.select(
        *groups,
        "_slice",
        (F.sum("_n").over(upto) - F.col("_n") - F.col("_first") + 1).alias("_shift"),
        *([F.sum("_n").over(whole).alias(total)] if total else []),
    )
    return _attach(rows, slices, [*groups, "_slice"]).select(
        *df.columns, (F.col("_place") + F.col("_shift")).alias(name), *([total] if total else [])
    )


def _running(groups: Sequence[str], columns: Sequence[str]) -> Callable:
    """Replaces columns by their running sums inside each group of a slice that comes in order.

    A batch is summed up as a whole, less what stood before each of its groups; the last group's sums are carried on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, carried = None, np.zeros(len(columns), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = lambda at, batch=batch: [batch.column(g)[at].as_py() for g in groups]
            upto = np.cumsum(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns], axis=1), axis=0)
            starts = np.zeros(1, dtype=np.int64)
            if groups and key(0) != key(batch.num_rows - 1):
                named = pd.DataFrame({g: batch.column(g).to_pandas() for g in groups}).groupby(groups, sort=False, dropna=False).ngroup().to_numpy()
                starts = np.concatenate([starts, np.flatnonzero(named[1:] != named[:-1]) + 1])
            before = np.vstack([np.zeros((1, len(columns)), np.int64), upto[starts[1:] - 1]])
            if held == key(0):
                before[0] -= carried
            sums = upto - np.repeat(before, np.diff(np.append(starts, batch.num_rows)), axis=0)
            held, carried = key(batch.num_rows - 1), sums[-1]
            new = dict(zip(columns, sums.T))
            arrays = [pa.array(new[n]) if n in new else batch.column(n) for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return run


def with_running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    groups: Sequence[str] = (),
) -> DataFrame:
    """Running sums of whole-number expressions inside `groups` by `order`.

    Every name in `totals` becomes the inclusive running sum, and `<name>_all` the
    group's overall sum. Sums are bigint, so the result does not depend on slicing; a null adds nothing.
    Sums inside a slice are taken while the sorted slice is written, so after the range exchange
    only the slice totals are aggregated and joined, and no row is exchanged again.
    """
    wide = df.withColumns({f"_local_{n}": F.coalesce(e.cast("long"), F.lit(0)) for n, e in totals.items()})
    ordered = wide.orderBy(*[F.col(g) for g in groups], *order).withColumn("_place", F.monotonically_increasing_id())
    summed = ordered.mapInArrow(_running(list(groups), [f"_local_{n}" for n in totals]), ordered.schema)
    local = stage_table(summed, "ordered").withColumn("_slice", F.shiftright("_place", _SLICE_BITS))
    slices = local.groupBy(*groups, "_slice").agg(
        *[F.max_by(f"_local_{n}", "_place").alias(f"_sum_{n}") for n in totals]
    )
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = slices.select(
        *groups,
        "_slice",
        *[(F.sum(f"_sum_{n}").over(upto) - F.col(f"_sum_{n}")).alias(f"_before_{n}") for n in totals],
        *[F.sum(f"_sum_{n}").over(whole).alias(f"{n}_all") for n in totals],
    )
    return _attach(local, slices, [*groups, "_slice"]).select(
        *df.columns,
        *[(F.col(f"_local_{n}") + F.col(f"_before_{n}")).alias(n) for n in totals],
        *[f"{n}_all" for n in totals],
    )
