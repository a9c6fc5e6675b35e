"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_space(text: Column) -> Column:
    """Remove any leading and trailing white space, not only blanks."""
    return F.regexp_replace(text, r"^[\s ]+|[\s ]+$", "")


def first_match(value: Column, table: Mapping) -> Column:
    """Look `value` up in a small fixed table; null when it is absent."""
    pairs = [F.lit(x) for x in chain.from_iterable(table.items())]
    return F.try_element_at(F.create_map(*pairs), value)


def text_or(value: Column, default: str) -> Column:
    return F.coalesce(F.trim(value), F.lit(default))


def filled(value: Column) -> Column:
    """True for a value that is not null and not blank."""
    return F.coalesce(F.trim(value) != "", F.lit(False))


def experiment_of(run_id: Column, prefix: str) -> Column:
    """Experiment code between the prefix and the next dash; null when absent."""
    return F.nullif(F.regexp_extract(run_id, f"^{prefix}-([^-]+)-", 1), F.lit(""))


def run_id_of(
    prefix: str, experiment: Column, model: Column, variant: Column, weighted: Column, tag: Column | None = None
) -> Column:
    """Deterministic run id: prefix, experiment, model, variant, weights and an optional tag."""
    weights = F.when(weighted, F.lit("w1")).otherwise(F.lit("w0"))
    tail = F.when(tag != "", tag) if tag is not None else F.lit(None).cast("string")
    return F.concat_ws("-", F.lit(prefix), experiment, F.lower(model), F.lower(variant), weights, tail)
