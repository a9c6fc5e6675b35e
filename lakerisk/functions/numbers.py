"""Numeric expressions, safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_sum(amount: Column) -> Column:
    """Exact sum of amounts in cents, returned as double: independent of row order."""
    return F.sum(amount.cast("decimal(18,2)")).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null when `whole` is null or zero."""
    return part / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, rounded; null when `whole` is null or zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), digits)


def flag(condition: Column) -> Column:
    """1 when true, else 0 (null counts as false)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def amount_per_worker(amount: Column, workers: Column) -> Column:
    """Null when the worker count is unknown or not positive, or the amount is null."""
    return F.when((workers > 0) & amount.isNotNull(), amount / workers)


def soft_log(value: Column) -> Column:
    """log1p of the value cut at zero; null stays null."""
    return F.when(value.isNotNull(), F.log1p(F.greatest(value.cast("double"), F.lit(0.0))))


def clean_number(value: Column, digits: int = 4) -> Column:
    """Text or number to a rounded double; NaN, null and unreadable values give 0."""
    number = value.try_cast("double")
    return F.round(F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0)), digits)


def finite_or_null(value: Column) -> Column:
    """NaN and infinities are not valid JSON: they become null."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def quadrant(x: Column, y: Column, x_mid: Column, y_mid: Column, labels: tuple[str, str, str, str]) -> Column:
    """Label by position against two midpoints: high/high, high/low, low/high, else low/low."""
    return (
        F.when((x >= x_mid) & (y >= y_mid), labels[0])
        .when((x >= x_mid) & (y < y_mid), labels[1])
        .when((x < x_mid) & (y >= y_mid), labels[2])
        .otherwise(labels[3])
    )
