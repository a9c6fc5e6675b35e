"""Exact order statistics and rank cuts by refining histograms: rows are scanned, never sorted or exchanged.

The value at a place of a group is searched with histograms of `BINS` bins that Spark combines before the shuffle.
Counts say which bin holds the place; the next histogram covers that bin alone, and once a bin holds few rows
its values are merged and counted. All columns, groups and places share the scans: one for the ranges, one for the
first histogram, one for the values, and one more for each bin that stays large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.operators.ordering import WINDOW_ROWS, with_rank
from lakerisk.session import stage_table

BINS = 4096
# Rows of a bin whose values are merged and counted in place of another histogram.
FEW = 65_536
# Values are searched inside these bounds, so that the width of a range is a finite double.
BOUND = 8e307


def bounded(value: Column) -> Column:
    """The value as a double inside the bounds; NaN counts as the upper bound, null stays null."""
    number = value.cast("double")
    return F.when(number.isNotNull(), F.greatest(F.least(number, F.lit(BOUND)), F.lit(-BOUND)))


def _bin(value: Column, low: Column, high: Column, even: bool) -> Column:
    """Bin of a value in its range: even steps, or steps of the logarithm (of the sign, in a range around zero).

    Both rise with the value, which is all the search needs. Even steps always part the ends of a range, and
    taking turns makes the rounds few whatever the tails: a range of all doubles is down to one value after about eight.
    """
    if not even:
        bent = lambda v: F.when(low > 0, F.ln(v)).when(high < 0, -F.ln(-v)).otherwise(F.signum(v))
        value, low, high = bent(value), bent(low), bent(high)
    return F.coalesce(F.floor((value - low) / F.nullif(high - low, F.lit(0.0)) * BINS), F.lit(0)).cast("int")


def _inside(cells: DataFrame, open_places: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells in the ranges still open; ranges of a group do not overlap, so a cell meets one at most."""
    ranges = open_places.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_low", "_high").distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return cells.join(ranges, [*same, F.col("_x").between(F.col("_low"), F.col("_high"))]).drop(*[f"_of_{k}" for k in keys])


def _narrowed(open_places: DataFrame, counted: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Each place in the part of its range that holds it, counted from the start of that part."""
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_low").orderBy(order))
    parts = counted.withColumn("_upto", upto).select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_low").alias("_of_low"), "_upto", F.col("_n").alias("_rows_in"),
        F.col("_least").alias("_new_low"), F.col("_most").alias("_new_high"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    before = F.col("_upto") - F.col("_rows_in")
    met = open_places.join(parts, [*same, F.col("_low") == F.col("_of_low")])
    return met.filter((F.col("_place") >= before) & (F.col("_place") < F.col("_upto"))).select(
        *keys, "_name", (F.col("_place") - before).alias("_place"), F.col("_new_low").alias("_low"),
        F.col("_new_high").alias("_high"), F.col("_rows_in").alias("_rows"), "_all",
    )


def values_at(
    df: DataFrame, value: Column, places: Mapping[str, Column], groups: Sequence[str] = (), few: int = FEW, stored: bool = False
) -> DataFrame:
    """One row per group with rows: `n` (non-null values) and, by name, the value at each 0-based place.

    A place is a bigint expression over `n` and the groups; outside 0 .. n - 1 its value is null. The needed columns of
    `df` are stored once, as every histogram scans them; `stored` says that `df` is a plain table already. Groups
    should be few and large; their names must not start with an underscore.
    """
    narrow = df.select(F.lit(0).alias("_one"), *groups, bounded(value).alias("_x")).filter(F.col("_x").isNotNull())
    cells, keys = narrow if stored else stage_table(narrow, "cells"), ["_one", *groups]
    whole = cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
    wanted = F.array(*[F.struct(F.lit(name).alias("_name"), place.cast("long").alias("_place")) for name, place in places.items()])
    listed = whole.select(*keys, "_low", "_high", F.col("n").alias("_rows"), F.col("n").alias("_all"), F.inline(wanted))
    table = stage_table(listed.select(*keys, "_name", "_place", "_low", "_high", "_rows", "_all"), "places")
    held = F.col("_place").between(0, F.col("_all") - 1)
    done, table = [table.filter(~held | F.col("_place").isNull()).withColumn("_low", F.lit(None).cast("double"))], table.filter(held)
    even, waiting = True, []
    while not table.filter((F.col("_low") < F.col("_high")) & (F.col("_rows") > few)).isEmpty():
        large = (F.col("_low") < F.col("_high")) & (F.col("_rows") > few)
        waiting.append(table.filter(~large))  # found, or in a bin of few rows, whose values are still to be counted
        open_places = table.filter(large)
        binned = _inside(cells, open_places, keys).groupBy(*keys, "_low", _bin(F.col("_x"), F.col("_low"), F.col("_high"), even).alias("_bin"))
        counted = binned.agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_least"), F.max("_x").alias("_most"))
        table, even = stage_table(_narrowed(open_places, counted, keys, "_bin"), "places"), not even
    for part in waiting:
        table = table.unionByName(part)
    done.append(table.filter(F.col("_low") == F.col("_high")))
    last = table.filter(F.col("_low") < F.col("_high"))
    merged = _inside(cells, last, keys).groupBy(*keys, "_low", "_x").agg(F.count(F.lit(1)).alias("_n"))
    counted = merged.withColumns({"_least": F.col("_x"), "_most": F.col("_x")})
    done.append(_narrowed(last, counted, keys, "_x"))
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    by_name = [F.max(F.when(F.col("_name") == name, F.col("_low"))).alias(name) for name in places]
    return stage_table(found.groupBy(*keys).agg(F.max("_all").alias("n"), *by_name).drop("_one"), "values")


def quantile_ends(df: DataFrame, value: Column, wanted: Mapping[str, float], groups: Sequence[str] = (), few: int = FEW, stored: bool = False) -> DataFrame:
    """Per group: `n` and, for each named quantile, the two values around it and how far it lies between them."""
    spot = {name: F.lit(float(q)) * (F.col("n") - 1) for name, q in wanted.items()}
    places = {f"low_{name}": F.floor(s) for name, s in spot.items()} | {f"high_{name}": F.ceil(s) for name, s in spot.items()}
    return values_at(df, value, places, groups, few, stored).withColumns({f"part_{name}": s - F.floor(s) for name, s in spot.items()})


def rank_cuts(rows: DataFrame, cuts: Mapping[str, Column], groups: Sequence[str], few: int = FEW, stored: bool = False) -> DataFrame:
    """Where each cut of a ranking (score descending, id ascending) falls, one row per group and cut.

    A cut is the number of rows it takes, an expression over `n`, the group's rows. Columns: groups, cut, take,
    cut_score, cut_id. A row is taken when its `ranked_score` is above cut_score, or equals it with an id up to cut_id;
    cut_id is null where all rows of that score are taken. Cuts that take no row, or null ones, are left out. Only rows
    whose score ties at a cut that parts them are sorted, by a window up to `WINDOW_ROWS` of them and in slices beyond.
    """
    narrow = rows.select(*groups, "id", ranked_score(F.col("score")).alias("_score"))
    narrow = narrow if stored else stage_table(narrow, "scores")
    taken = {name: F.when(k.isNotNull(), F.least(k.cast("long"), F.col("n"))) for name, k in cuts.items()}
    found = values_at(narrow, F.col("_score"), {name: F.col("n") - k for name, k in taken.items()}, groups, few, stored=True)
    pairs = F.array(*[F.struct(F.lit(c).alias("cut"), k.alias("take"), F.col(c).alias("cut_score")) for c, k in taken.items()])
    at = stage_table(found.select(*groups, F.inline(pairs)).filter(F.col("take") > 0), "cuts")
    ends = at.select(*[F.col(g).alias(f"_of_{g}") for g in groups], "cut", "take", "cut_score")
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in groups]
    sides = narrow.join(ends, same).groupBy(*groups, "cut", "take", "cut_score").agg(
        F.count_if(F.col("_score") > F.col("cut_score")).alias("_above"), F.count_if(F.col("_score") == F.col("cut_score")).alias("_ties")
    )
    sides = stage_table(sides.withColumn("_nth", F.col("take") - F.col("_above")), "cuts")
    parted = sides.filter(F.col("_nth") < F.col("_ties"))
    most = parted.agg(F.max("_ties")).first()[0]
    if most is None:
        return sides.select(*groups, "cut", "take", "cut_score", F.lit(None).cast(narrow.schema["id"].dataType).alias("cut_id"))
    tied = parted.select(*[F.col(g).alias(f"_of_{g}") for g in groups], "cut_score").distinct()
    held = narrow.join(tied, [*same, F.col("_score") == F.col("cut_score")]).select(*groups, "_score", "id")
    if most <= WINDOW_ROWS:
        numbered = held.withColumn("_turn", F.row_number().over(Window.partitionBy(*groups, "_score").orderBy("id")))
    else:
        numbered = with_rank(held, [F.col("id")], [*groups, "_score"], "_turn")
    numbered = numbered.select(
        *[F.col(g).alias(f"_of_{g}") for g in groups], F.col("_score").alias("_tied"), F.col("_turn"), F.col("id").alias("cut_id")
    )
    met = [*same, F.col("cut_score") == F.col("_tied"), F.col("_nth") == F.col("_turn"), F.col("_nth") < F.col("_ties")]
    return sides.join(numbered, met, "left").select(*groups, "cut", "take", "cut_score", "cut_id")


def ranked_score(score: Column) -> Column:
    """The score as rankings compare it: a missing one is the lowest."""
    return F.coalesce(bounded(score), F.lit(-BOUND))
