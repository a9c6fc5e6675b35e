"""Entity ids: validity, padding, parts and stable hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An id has 11 digits: 2 for the kind, 8 in sequence, 1 check digit.
ID_PATTERN = r"^[0-9]{11}$"
ID_WIDTH = 11


def valid_id(value: Column) -> Column:
    """True for exactly 11 digits after trimming; null is invalid."""
    return F.coalesce(F.trim(value.cast("string")).rlike(ID_PATTERN), F.lit(False))


def padded_id(value: Column) -> Column:
    """11-character text of a numeric id, zeros on the left; null stays null."""
    number = value.cast("long")
    return F.when(number.isNotNull(), F.format_string(f"%0{ID_WIDTH}d", number))


def _whole_div(value: Column, by: int) -> Column:
    """Integer division of a non-negative bigint, exact beyond 53 bits."""
    return F.floor((value - value % F.lit(by)) / F.lit(by)).cast("long")


def id_prefix(value: Column) -> Column:
    """The leading kind digits as text."""
    return _whole_div(value, 10**9).cast("string")


def id_sequence(value: Column) -> Column:
    """The eight digits in sequence, a proxy for the enrolment date."""
    return _whole_div(value, 10) % F.lit(10**8)


def order_hash(text: Column, salt: str, kind: str = "murmur3") -> Column:
    """Stable pseudo-random order key. `md5` exists for checks outside Spark."""
    salted = F.concat(text, F.lit(salt))
    if kind == "md5":
        return F.md5(salted)
    if kind != "murmur3":
        raise ValueError(f"unknown hash kind: {kind!r}")
    # Widened first: the absolute value of the smallest int would not fit an int.
    return F.abs(F.hash(salted).cast("long"))


def hash_uniform(text: Column, seed: int, kind: str = "xxhash64") -> Column:
    """Uniform number in [0, 1) from a hash, so a re-run task gives the same value."""
    if kind == "md5":
        head = F.substring(F.md5(F.concat(text, F.lit(f"|{seed}"))), 1, 12)
        return F.conv(head, 16, 10).cast("double") / F.lit(float(2**48))
    bits = F.shiftrightunsigned(F.xxhash64(text, F.lit(seed)), 11)
    return bits.cast("double") / F.lit(float(2**53))
