"""Regional summary: active entities, weighted informality, revenue and exclusions per region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.numbers import money_sum
from lakerisk.functions.regions import ROLLUP_ROWS, normalise_region, region_from_code

ACTIVE = "ACTIVO"


def latest_month(registry: DataFrame) -> tuple[int, int] | None:
    """Newest (year, month); reads only the two partition columns."""
    newest = F.max(F.struct(F.col("year").cast("int").alias("y"), F.col("month").cast("int").alias("m")))
    found = registry.agg(newest.alias("at")).first()["at"]
    return (found["y"], found["m"]) if found else None


def reference_snapshot(
    registry: DataFrame, year: int | None = None, month: int | None = None
) -> tuple[DataFrame, int | None, int | None]:
    """One monthly snapshot: the given one, or the newest for the part not given.

    The partition columns are compared with typed literals, which prunes partitions.
    """
    if year is None or month is None:
        newest = latest_month(registry)
        if newest:
            year, month = newest[0] if year is None else year, newest[1] if month is None else month
    if year is None or month is None:
        return registry, year, month
    return registry.filter((F.col("year") == year) & (F.col("month") == month)), year, month


def active_by_region(snapshot: DataFrame) -> DataFrame:
    active = F.upper(F.trim("status")) == ACTIVE
    return snapshot.filter(active).groupBy("region").agg(F.count(F.lit(1)).alias("active_entities"))


def informality_by_region(survey: DataFrame) -> DataFrame:
    """Weighted informal share of employed persons, in percent."""
    informal = F.when(F.col("informal") == 1, F.col("weight")).otherwise(F.lit(0.0))
    employed = survey.filter(F.col("employed") == 1)
    per_code = employed.groupBy(region_from_code(F.col("code")).alias("region")).agg(
        F.sum(informal).alias("informal"), F.sum("weight").alias("every")
    )
    return per_code.select("region", (F.col("informal") / F.nullif("every", F.lit(0.0)) * 100).alias("informal_pct"))


def revenue_by_region(revenue: DataFrame, year: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Revenue per canonical region (and `by`). Roll-up rows are dropped so nothing counts twice."""
    rows = revenue if year is None or "year" not in revenue.columns else revenue.filter(F.col("year") == year)
    single = rows.filter(~F.upper(F.trim("region")).isin(ROLLUP_ROWS))
    return single.groupBy(normalise_region(F.col("region")).alias("region"), *by).agg(
        money_sum(F.col("amount")).alias("revenue")
    )


def exclusions_by_region(exclusions: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Excluded entities per region of the snapshot."""
    places = snapshot.select("entity_id", "region").distinct()
    return (
        exclusions.join(places, "entity_id").groupBy("region").agg(F.count(F.lit(1)).alias("excluded_entities"))
    )


def regional_summary(active: DataFrame, informality: DataFrame, revenue: DataFrame, excluded: DataFrame) -> DataFrame:
    """One row per region found in any part; counts and amounts default to 0, the rate to null."""
    joined = (
        active.join(informality, "region", "outer").join(revenue, "region", "outer").join(excluded, "region", "outer")
    )
    return joined.fillna(0, subset=["active_entities", "revenue", "excluded_entities"])
