"""Preparation of the side sources: exclusion list, label register, affiliations, survey, revenue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.config import MIN_VALID_ID_SHARE
from lakerisk.functions.dates import day_first_date, serial_date
from lakerisk.functions.regions import MONTH_NAMES, region_display
from lakerisk.functions.text import strip_space
from lakerisk.sources.schemas import REGISTER_HEADERS


def require_columns(df: DataFrame, needed: Sequence[str], source: str) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{source} lacks columns {missing}; it has {df.columns}")


def existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that are there, in the wanted order."""
    have = set(df.columns)
    return df.select(*[c for c in wanted if c in have])


def rename_by_header(df: DataFrame, headers: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Rename every column whose header contains a known text; keep only those and `keep`."""
    names = {}
    for column in df.columns:
        for text, target in headers.items():
            if text in column.lower():
                names[column] = target
    wanted = [*keep, *[t for t in headers.values() if t in names.values()]]
    return df.withColumnsRenamed(names).select(*wanted)


def with_valid_id(df: DataFrame, column: str = "entity_id") -> DataFrame:
    """Rows whose id is an 11-digit number, as bigint; the rest is dropped. Lazy."""
    number = F.col(column).try_cast("double")
    ok = (number >= 10**10) & (number < 10**11)
    return df.filter(ok).withColumn(column, number.cast("long"))


def checked_ids(df: DataFrame, source: str, column: str = "entity_id") -> DataFrame:
    """`with_valid_id`, after one aggregate proves the column really holds ids."""
    number = F.col(column).try_cast("double")
    ok = (number >= 10**10) & (number < 10**11)
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("valid")).first()
    if seen["n"] == 0 or seen["valid"] / seen["n"] < MIN_VALID_ID_SHARE:
        raise ValueError(
            f"[{source}] only {seen['valid']} of {seen['n']} values of {column} are 11-digit ids"
        )
    return with_valid_id(df, column)


def exclusion_list(raw: DataFrame) -> DataFrame:
    """One row per valid id. Among repeats the smallest name is kept, so a re-run agrees."""
    require_columns(raw, ["entity_id", "name"], "exclusion list")
    return checked_ids(raw, "exclusion list").groupBy("entity_id").agg(F.min("name").alias("name"))


def parsed_date(df: DataFrame, column: str) -> DataFrame:
    """Serial numbers when every filled cell is a number, else day-first text.

    The choice is per whole column, made by a one-row aggregate inside the plan.
    """
    kind = dict(df.dtypes)[column]
    if kind in ("date", "timestamp"):
        return df.withColumn(column, F.col(column).cast("date"))
    text = F.col(column).cast("string")
    odd = df.select(F.count_if(text.isNotNull() & text.try_cast("double").isNull()).alias("odd"))
    numeric = text.try_cast("double")
    return df.withColumn(
        column, F.when(odd.scalar() == 0, serial_date(numeric)).otherwise(day_first_date(text))
    )


def label_register(raw: DataFrame) -> DataFrame:
    """One row per id with its oldest resolution; raises when an issue date is unreadable."""
    id_column = next((c for c in raw.columns if c.strip().upper() == "RUC"), raw.columns[0])
    named = rename_by_header(
        raw.withColumnRenamed(id_column, "entity_id"), REGISTER_HEADERS, keep=["entity_id"]
    )
    require_columns(named, ["issue_date"], "label register")
    for column in ("issue_date", "firm_date", "publication_date"):
        if column in named.columns:
            named = parsed_date(named, column)
    if "representative" in named.columns:
        named = named.withColumn("representative", strip_space(F.col("representative").cast("string")))
    valid = checked_ids(named, "label register")
    if not valid.filter(F.col("issue_date").isNull()).isEmpty():
        raise ValueError("label register has empty or unreadable issue dates")
    return oldest_per_key(valid).withColumn("positive", F.lit(True))


def oldest_per_key(df: DataFrame, key: str = "entity_id", date: str = "issue_date") -> DataFrame:
    """The row with the oldest date per key; the remaining columns break ties.

    `min` of a struct aggregates before the shuffle, so a key with many rows is cheap.
    """
    rest = [c for c in df.columns if c not in (key, date)]
    undated = F.col(date).isNull().alias("_undated")
    oldest = F.min(F.struct(undated, date, *rest)).alias("_row")
    return df.groupBy(key).agg(oldest).select(key, *[F.col(f"_row.{c}") for c in (date, *rest)])


def affiliations(raw: DataFrame) -> DataFrame:
    """Valid ids, lower-case voucher type, ISO start date, no repeated rows."""
    require_columns(raw, ["entity_id", "voucher_type", "start_date"], "affiliations")
    started = F.try_to_timestamp(F.col("start_date").cast("string"), F.lit("yyyy-MM-dd")).cast("date")
    typed = raw.select("entity_id", "voucher_type", started.alias("start_date"))
    return (
        checked_ids(typed, "affiliations")
        .withColumn("voucher_type", F.lower(strip_space(F.col("voucher_type"))))
        .distinct()
    )


def survey(raw: DataFrame) -> DataFrame:
    """The four used columns; rows without region code or weight are dropped."""
    require_columns(raw, ["code", "employed", "informal", "weight"], "survey")
    return (
        raw.select("code", "employed", "informal", "weight")
        .dropna(subset=["code", "weight"])
        .withColumn("code", F.col("code").cast("long"))
    )


def revenue_long(wide: DataFrame, region_cells: tuple[str, str]) -> DataFrame:
    """Month columns named ``<year>_<month>`` to long rows; unreadable amounts become null.

    Columns whose name is no month (totals, notes) are left out.
    """
    cells = []
    for column in wide.columns:
        year, _, name = column.partition("_")
        month = MONTH_NAMES.get(name.strip().lower().rstrip("."))
        if column not in region_cells and year.isdigit() and month:
            amount = F.col(f"`{column}`").cast("string").try_cast("double")
            cells.append(
                F.struct(
                    F.lit(f"{year}_{month}").alias("period"),
                    F.lit(int(year)).cast("long").alias("year"),
                    F.lit(month).alias("month"),
                    amount.alias("amount"),
                )
            )
    region = region_display(*[F.col(c) for c in region_cells])
    return wide.select(region.alias("region"), F.inline(F.array(*cells))).filter(F.col("region") != "")


def revenue(long: DataFrame) -> DataFrame:
    """Rows with a readable amount."""
    require_columns(long, ["region", "period", "year", "month", "amount"], "revenue")
    return long.withColumn("amount", F.col("amount").try_cast("double")).dropna(subset=["amount"])
