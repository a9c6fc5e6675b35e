"""Model input: column choice, top-coding, imputation, categories, weights, sampling, CV rounds."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from math import log1p

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.functions.ids import order_hash
from lakerisk.functions.numbers import soft_log
from lakerisk.operators.ordering import with_rank
from lakerisk.operators.selection import quantile_ends
from lakerisk.session import stage_table

# The columns a model may use, and the limits of the preparation.
NUMERIC = [
    "total_amount", "median_amount", "max_amount", "n_orders", "n_buyers", "top_buyer_share", "annulled_share",
    "contract_age_days", "workers", "workers_known", "no_workers", "amount_per_worker", "regional_informal_pct",
    "id_sequence", "months_seen", "new_in_period", "months_gap", "billing_changed", "status_changed", "affiliated",
    "aff_age_days", "aff_n_types", "aff_invoice_portal", "aff_receipt_portal", "aff_own_system", "aff_fees_only",
]
CATEGORICAL = ["activity", "main_activity", "region", "entity_type", "id_prefix", "billing_mode", "accounting_mode"]
LEAKY_CATEGORICAL = ["status", "condition"]
LOGGED = [
    "total_amount", "median_amount", "max_amount", "n_orders", "n_buyers", "contract_age_days", "workers", "amount_per_worker",
]
CATEGORY_LIMITS = {"region": 25}
DEFAULT_CATEGORY_LIMIT = 30
TOP_QUANTILE = 0.995
UNKNOWN, INFREQUENT = "DESCONOCIDO", "infrequent"


def candidate_columns(df: DataFrame, variant: str) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns a variant may use; V1 adds the leaky ones."""
    leaky = LEAKY_CATEGORICAL if variant == "V1" else []
    have = set(df.columns)
    return [c for c in NUMERIC if c in have], [c for c in CATEGORICAL + leaky if c in have]


@dataclass
class Preparation:
    """What is learnt from the training rows: a few numbers and names per column."""

    numeric: list[str]
    categorical: list[str]
    linear: bool
    caps: dict[str, float] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)
    with_missing: list[str] = field(default_factory=list)
    categories: dict[str, list[str]] = field(default_factory=dict)

    def shaped(self, column: str) -> Column:
        """Top-coded (linear models only) and logged where the tail is long."""
        value = F.col(column).cast("double")
        if column not in LOGGED:
            return value
        cap = self.caps.get(column)
        return soft_log(F.when(value.isNotNull(), F.least(value, F.lit(cap))) if cap else value)

    def numeric_columns(self) -> dict[str, Column]:
        """Imputed values and missing marks, by output name."""
        out = {f"num_{c}": F.coalesce(self.shaped(c), F.lit(self.medians[c])) for c in self.numeric}
        out |= {f"missing_{c}": F.col(c).isNull().cast("double") for c in self.with_missing}
        return out

    def category_columns(self) -> dict[str, Column]:
        """Kept categories by name, everything else pooled."""
        return {f"cat_{c}": pool_rare(F.col(c), self.categories[c]) for c in self.categorical}


def top_coded(value: Column, cap: Column) -> Column:
    """The smaller of value and cap; no cap when it is not positive. Null stays null."""
    return F.when(cap > 0, F.when(value.isNotNull(), F.least(value, cap))).otherwise(value)


def frequent_categories(train: DataFrame, limits: Mapping[str, int]) -> dict[str, list[str]]:
    """The most frequent values of each column; past its limit the last place is the pool's.

    All columns are counted in one pass, and the group limit keeps at most limit + 1
    values per column and task before they meet.
    """
    if not limits:
        return {}
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("name"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("value"))
            for c in limits
        ]
    )
    counted = train.select(F.inline(cells)).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("name").orderBy(F.col("n").desc(), "value"))
    most = max(limits.values()) + 1
    top: dict[str, list[str]] = {c: [] for c in limits}
    for row in counted.withColumn("place", place).filter(F.col("place") <= most).orderBy("name", "place").collect():
        top[row["name"]].append(row["value"])
    return {c: v if len(v) <= limits[c] else v[: limits[c] - 1] for c, v in top.items()}


def pool_rare(value: Column, kept: Sequence[str]) -> Column:
    named = F.coalesce(value.cast("string"), F.lit(UNKNOWN))
    return F.when(named.isin(list(kept)), named).otherwise(F.lit(INFREQUENT))


# Per column and quantile: the two values around it, and how far it lies from the first to the second.
Ends = dict[str, dict[str, tuple[float, float, float]]]
QUANTILES = {"median": 0.5, "cap": TOP_QUANTILE}


def _exact_ends(train: DataFrame, numeric: Sequence[str]) -> Ends:
    """Exact quantiles of all columns at once: the columns are stored side by side, and each scan counts all of them."""
    wide = stage_table(train.select(*[F.col(c).cast("double").alias(c) for c in numeric]), "numeric")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("x")) for c in numeric])
    found = quantile_ends(wide.select(F.inline(cells)), F.col("x"), QUANTILES, ["column"], stored=True)
    return {r["column"]: {q: (r[f"low_{q}"], r[f"high_{q}"], r[f"part_{q}"]) for q in QUANTILES} for r in found.collect()}


def _sketched_ends(train: DataFrame, numeric: Sequence[str]) -> Ends:
    """Quantiles from mergeable sketches in one pass; each is the value of a row near the wanted place."""
    sketch = lambda c, q: F.percentile_approx(F.col(c).cast("double"), q, 10000)
    seen = train.agg(*[sketch(c, x).alias(f"{q}_{c}") for c in numeric for q, x in QUANTILES.items()]).first()
    return {c: {q: (seen[f"{q}_{c}"],) * 2 + (0.0,) for q in QUANTILES} for c in numeric}


def fit_preparation(train: DataFrame, variant: str, linear: bool, sketch: bool = False) -> Preparation:
    """Learn caps, medians, missing marks and kept categories.

    Quantiles are exact and linear between neighbours, or from sketches on demand. Top-coding and log keep the order
    of values, so the shaped median lies between the shaped neighbours of the plain one. Columns without a value
    are left out; a cap that is not positive is none.
    """
    numeric, categorical = candidate_columns(train, variant)
    learnt = [F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"filled_{c}") for c in numeric + categorical]]
    seen = train.agg(*learnt).first()
    prep = Preparation([c for c in numeric if seen[f"filled_{c}"]], [c for c in categorical if seen[f"filled_{c}"]], linear)
    prep.with_missing = [c for c in prep.numeric if seen[f"filled_{c}"] < seen["rows"]]
    ends = (_sketched_ends if sketch else _exact_ends)(train, prep.numeric) if prep.numeric else {}
    for c in prep.numeric:
        low, high, part = ends[c]["cap"]
        cap = low + (high - low) * part
        if linear and c in LOGGED and cap > 0:
            prep.caps[c] = cap
        low, high, part = ends[c]["median"]
        if c in LOGGED:
            low, high = (log1p(max(0.0, min(x, prep.caps.get(c, x)))) for x in (low, high))
        prep.medians[c] = low + (high - low) * part
    limits = {c: CATEGORY_LIMITS.get(c, DEFAULT_CATEGORY_LIMIT) for c in prep.categorical}
    prep.categories = frequent_categories(train, limits)
    return prep


def preparation_report(rows: DataFrame, prep: Preparation) -> DataFrame:
    """What a preparation does to rows, one row per column.

    Numeric columns have their median, cap, rows imputed, and mean and ends of the prepared values; categorical ones
    the number of kept names and the rows that are pooled.
    """
    numbers, names = prep.numeric_columns(), prep.category_columns()
    sums = []
    for c in prep.numeric:
        value = numbers[f"num_{c}"]
        marked = F.sum(numbers[f"missing_{c}"]).cast("long") if c in prep.with_missing else F.lit(0).cast("long")
        fixed = [F.lit(prep.medians[c]).alias("median"), F.lit(prep.caps.get(c)).cast("double").alias("cap")]
        seen = [marked.alias("changed"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("greatest")]
        sums.append(F.struct(F.lit(c).alias("column"), *fixed, *seen, F.lit(None).cast("long").alias("kept")))
    for c in prep.categorical:
        void = [F.lit(None).cast("double").alias(n) for n in ("median", "cap")]
        ends = [F.lit(None).cast("double").alias(n) for n in ("mean", "least", "greatest")]
        pooled = F.count_if(names[f"cat_{c}"] == INFREQUENT).alias("changed")
        kept = F.lit(len(prep.categories[c])).cast("long").alias("kept")
        sums.append(F.struct(F.lit(c).alias("column"), *void, pooled, *ends, kept))
    return rows.agg(F.array(*sums).alias("parts")).select(F.inline("parts"))


def class_weight(rows: DataFrame) -> Column:
    """Balanced weight n / (2 * n_class); both counts come from one scalar subquery."""
    counts = F.struct(
        F.count(F.lit(1)).cast("double").alias("n"), F.count_if(F.col("label") == 1).cast("double").alias("p")
    )
    seen = rows.select(counts.alias("seen")).scalar()
    n, p = seen["n"], seen["p"]
    return F.when(F.col("label") == 1, n / F.nullif(p * 2, F.lit(0.0))).otherwise(n / F.nullif((n - p) * 2, F.lit(0.0)))


def sample_negatives(rows: DataFrame, per_positive: int, seed: int = 42, hash_kind: str = "murmur3") -> DataFrame:
    """All positives and exactly `per_positive` negatives for each (or all there are).

    The negatives with the lowest hashes are taken by a distributed rank, so neither
    the driver nor one task receives them, and a re-run picks the same rows.
    """
    if per_positive <= 0:
        return rows
    positive = F.col("label") == 1
    salted = order_hash(F.col("id"), f"_salt_{seed}_sample", hash_kind)
    keys = rows.filter(~positive).select(salted.alias("hash"), "id")
    wanted = rows.filter(positive).select((F.count(F.lit(1)) * per_positive).alias("n")).scalar()
    ranked = with_rank(keys, [F.col("hash"), F.col("id")], (), "_nth").filter(F.col("_nth") <= wanted)
    # The last key taken is a one-row subquery; comparing with it needs no join.
    last = ranked.select(F.max(F.struct("hash", "id")).alias("last")).scalar()
    taken = F.coalesce(F.struct(salted.alias("hash"), "id") <= last, F.lit(False))
    return rows.filter(positive | taken)


def block_rounds(folds: Sequence[int]) -> Iterator[tuple[int, Column, Column]]:
    """(round, train rows, validation rows): every fold validates once."""
    for k in folds:
        yield k, (F.col("fold") >= 0) & (F.col("fold") != k), F.col("fold") == k


def forward_rounds(folds: Sequence[int]) -> Iterator[tuple[int, Column, Column]]:
    """(round, train rows, validation rows): fold k is predicted from earlier folds only."""
    for k in sorted(folds)[1:]:
        yield k, (F.col("fold") >= 0) & (F.col("fold") < k), F.col("fold") == k


def round_sizes(dataset: DataFrame, rounds: Iterator[tuple[int, Column, Column]]) -> DataFrame:
    """Rows and positives of every round, from one aggregate."""
    listed = list(rounds)
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("round"),
                F.col(f"t{k}").alias("train_rows"),
                F.col(f"v{k}").alias("valid_rows"),
                F.col(f"p{k}").alias("train_positives"),
            )
            for k, _, _ in listed
        ]
    )
    counts = []
    for k, fit, valid in listed:
        counts += [F.count_if(fit).alias(f"t{k}"), F.count_if(valid).alias(f"v{k}")]
        counts.append(F.count_if(fit & (F.col("label") == 1)).alias(f"p{k}"))
    return dataset.agg(*counts).select(F.inline(rows))
