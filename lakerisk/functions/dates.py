"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: day zero of spreadsheet serial dates.
SERIAL_ORIGIN = "1899-12-30"


def year_month(year: Column, month: Column) -> Column:
    """Text yyyymm."""
    two_digits = F.lpad(month.cast("int").cast("string"), 2, "0")
    return F.concat(year.cast("int").cast("string"), two_digits)


def month_index(yyyymm: Column) -> Column:
    """Months since year zero, so that differences are month counts."""
    return F.substring(yyyymm, 1, 4).cast("int") * 12 + F.substring(yyyymm, 5, 2).cast("int")


def month_end(yyyymm: Column) -> Column:
    return F.last_day(F.to_date(F.concat(yyyymm, F.lit("01")), "yyyyMMdd"))


def age_days(at: Column, since: Column) -> Column:
    """Days from `since` to `at`; null when negative."""
    days = F.datediff(at, since)
    return F.when(days >= 0, days)


def serial_date(number: Column) -> Column:
    """Spreadsheet serial number to date, the fraction of a day dropped."""
    days = F.floor(number.cast("double")).cast("int")
    return F.date_add(F.to_date(F.lit(SERIAL_ORIGIN)), days)


def day_first_date(text: Column) -> Column:
    """Day-first text (d/m/y, also with dashes) or ISO text; null when unreadable."""
    slashed = F.regexp_replace(F.trim(text), "-", "/")
    iso = F.try_to_timestamp(F.trim(text), F.lit("yyyy-MM-dd")).cast("date")
    return F.coalesce(iso, F.try_to_timestamp(slashed, F.lit("d/M/yyyy")).cast("date"))


def closed_month_end(latest: Column) -> Column:
    """Last day of the month before `latest`: the last complete month of a feed."""
    return F.last_day(F.add_months(latest, -1))
