"""Splits that keep every row: what fails a rule goes to a quarantine with its reason."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.config import VALID_YEARS
from lakerisk.functions.ids import valid_id
from lakerisk.functions.regions import normalise_region
from lakerisk.sources.readers import CORRUPT

REASON = "reject_reason"
# Reasons, in the order in which they are joined.
BAD_ID = "ruc_invalido"
BAD_BUYER = "ruc_entidad_invalido"
BAD_CONTRACTOR = "ruc_contratista_invalido"
NO_AMOUNT = "monto_nulo"
NEGATIVE_AMOUNT = "monto_negativo"


def split_by_schema(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected) by the parser's corrupt-record column.

    The clean side must keep other columns in use: Spark cannot query the corrupt
    column alone on a CSV scan.
    """
    corrupt = F.col(CORRUPT)
    return parsed.filter(corrupt.isNull()).drop(CORRUPT), parsed.filter(corrupt.isNotNull())


def year_out_of_range(columns: Sequence[str], years: tuple[int, int] = VALID_YEARS) -> Column:
    """True when any date has a year outside the range; a null date is fine."""
    outside = [~F.year(c).between(*years) for c in columns]
    return reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in outside], F.lit(False))


def split_by_year(
    df: DataFrame, columns: Sequence[str], years: tuple[int, int] = VALID_YEARS
) -> tuple[DataFrame, DataFrame]:
    bad = year_out_of_range(columns, years)
    return df.filter(~bad), df.filter(bad)


def merge_rejects(by_schema: DataFrame, by_year: DataFrame) -> DataFrame:
    """Both kinds of rejects in one table; a column one side lacks is null there."""
    return by_schema.unionByName(by_year, allowMissingColumns=True)


def split_parsed(
    parsed: DataFrame, dates: Sequence[str] = (), years: tuple[int, int] = VALID_YEARS
) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected) by the parser and the years at once: the rejects are `merge_rejects` of both splits, from one scan."""
    bad = F.col(CORRUPT).isNotNull() | year_out_of_range(dates, years)
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad)


def split_registry(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver with canonical region, rejected with reason) by id validity."""
    ok = valid_id(F.col("entity_id"))
    silver = df.filter(ok).withColumn("region", normalise_region(F.col("region")))
    return silver, df.filter(~ok).withColumn(REASON, F.lit(BAD_ID))


def order_rules() -> tuple[Column, Column]:
    """(accepted, reasons) for an order row.

    The buyer id must be valid, the contractor id valid or absent, the amount present
    and not negative. All failed rules are listed, joined by ``;``.
    """
    buyer_ok = valid_id(F.col("buyer_id"))
    contractor = F.col("contractor_id")
    contractor_ok = contractor.isNull() | valid_id(contractor)
    amount = F.col("amount")
    accepted = buyer_ok & contractor_ok & F.coalesce(amount >= 0, F.lit(False))
    reasons = F.concat_ws(
        ";",
        F.when(~buyer_ok, BAD_BUYER),
        F.when(~contractor_ok, BAD_CONTRACTOR),
        F.when(amount.isNull(), NO_AMOUNT),
        F.when(amount < 0, NEGATIVE_AMOUNT),
    )
    return accepted, reasons


def split_orders(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver with canonical region, rejected with reasons)."""
    accepted, reasons = order_rules()
    silver = df.filter(accepted).withColumn("region", normalise_region(F.col("region")))
    return silver, df.filter(~accepted).withColumn(REASON, reasons)
