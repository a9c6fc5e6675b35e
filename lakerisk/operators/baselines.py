"""Reference scores without training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.functions.ids import hash_uniform

# Conditions that count as irregular, and the column names each rule accepts.
BAD_CONDITIONS = ["NO HABIDO", "NO HALLADO"]
CONDITION_NAMES = ["condition"]
WORKER_NAMES = ["workers", "n_workers"]
CONTRACT_NAMES = ["has_contracts", "total_amount", "n_orders"]


def constant_score(df: DataFrame) -> DataFrame:
    return df.withColumns({"score": F.lit(0.0), "run_id": F.lit("baseline_constant")})


def _present(df: DataFrame, names: list[str]):
    return next((F.col(n) for n in names if n in df.columns), None)


def rule_score(df: DataFrame) -> DataFrame:
    """A third of a point each: irregular condition, zero workers (unknown counts as
    zero), public contracts with at most one worker. A rule without its column is 0."""
    condition, contracts = _present(df, CONDITION_NAMES), _present(df, CONTRACT_NAMES)
    declared = _present(df, WORKER_NAMES)
    workers = F.lit(0.0) if declared is None else F.coalesce(declared.try_cast("double"), F.lit(0.0))
    points = F.lit(0.0)
    if condition is not None:
        points = points + F.coalesce(F.upper(F.trim(condition)).isin(BAD_CONDITIONS), F.lit(False)).cast("double")
    if declared is not None:
        points = points + (workers == 0).cast("double")
    if contracts is not None:
        as_text = F.lower(contracts.cast("string"))
        contracted = F.coalesce(contracts.try_cast("double") > 0, F.lit(False)) | F.coalesce(
            as_text.isin("true", "t", "1"), F.lit(False)
        )
        points = points + (contracted & (workers <= 1)).cast("double")
    return df.withColumns({"score": points / 3.0, "run_id": F.lit("baseline_rule")})


def random_score(df: DataFrame, seed: int = 42, hash_kind: str = "xxhash64") -> DataFrame:
    """Uniform score from a hash of the id: stable however the rows are laid out."""
    return df.withColumns(
        {"score": hash_uniform(F.col("id"), seed, hash_kind), "run_id": F.lit("baseline_random")}
    )
