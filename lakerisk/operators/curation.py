"""Curation of the training table: population, exclusion, label, split, folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerisk.config import FOLDS, SPLIT_SEED, TEST_SHARE
from lakerisk.functions.dates import closed_month_end
from lakerisk.functions.ids import order_hash, padded_id
from lakerisk.operators.encoding import encode_all, standard_encodings
from lakerisk.operators.ordering import with_rank, with_running_totals
from lakerisk.session import stage_table
from lakerisk.sources.small import oldest_per_key, require_columns

# Entity types that ever occur among the positives, and the active state.
ELIGIBLE_TYPES = [
    "EMPRESA INDIVIDUAL DE RESPONSABILIDAD LIMITADA",
    "PERSONA NATURAL CON NEGOCIO",
    "SOCIEDAD ANONIMA CERRADA",
    "SOCIEDAD COMERCIAL DE RESPONSABILIDAD LIMITADA",
    "CONTRATOS COLABORACION EMPRESARIAL",
    "SOCIEDAD POR ACCIONES CERRADA SIMPLIFICADA",
    "SOCIEDAD IRREGULAR",
    "SOCIEDAD ANONIMA",
]
ACTIVE = "ACTIVO"


def eligible_population(features: DataFrame) -> DataFrame:
    """Active, affiliated entities of an eligible type; the three filters reach the scan."""
    require_columns(features, ["entity_type", "status", "affiliated"], "features")
    return features.filter(
        F.col("entity_type").isin(ELIGIBLE_TYPES) & (F.col("status") == ACTIVE) & (F.col("affiliated") == 1)
    )


def drop_excluded(features: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Entities outside the exclusion list, keyed by their 11-character `id`."""
    listed = exclusions.select(padded_id(F.col("entity_id")).alias("id"))
    keyed = features.withColumn("id", padded_id(F.col("entity_id")))
    return keyed.join(listed, "id", "left_anti").drop("excluded")


def attach_label(dataset: DataFrame, register: DataFrame) -> DataFrame:
    """label 1 for registered ids, with their dates and representative, else 0.

    A register with repeated ids keeps the oldest resolution of each.
    """
    optional = {"issue_date": "date", "firm_date": "date", "representative": "string"}
    keyed = register.select(
        padded_id(F.col("entity_id")).alias("id"),
        *[
            (F.col(c) if c in register.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in optional.items()
        ],
    )
    listed = oldest_per_key(keyed, key="id").withColumn("_listed", F.lit(1))
    return (
        dataset.join(listed, "id", "left")
        .withColumn("label", F.coalesce("_listed", F.lit(0)))
        .drop("_listed")
    )


def label_end(register: DataFrame):
    """Last day of the last month whose resolutions are published in full."""
    require_columns(register, ["issue_date", "publication_date"], "label register")
    latest = F.max(F.col("publication_date").cast("date"))
    end = register.agg(closed_month_end(latest).alias("end")).first()["end"]
    if end is None:
        raise ValueError("label register has no publication date: the label cannot be closed")
    return end


def within_label_window(dataset: DataFrame, cutoff: str, end) -> DataFrame:
    """Negatives, and positives issued in (cutoff, end]: before it the features already
    show the designation, after it the register is incomplete."""
    issued = F.col("issue_date")
    inside = (issued > F.lit(cutoff).cast("date")) & (issued <= F.lit(end).cast("date"))
    return dataset.filter(issued.isNull() | inside)


def _group_key():
    """Positives of one representative move together; anyone else moves alone."""
    own = F.col("id")
    return F.when(F.col("label") == 1, F.coalesce("representative", own)).otherwise(own)


def assign_split(
    keys: DataFrame, share: float = TEST_SHARE, seed: int = SPLIT_SEED, hash_kind: str = "murmur3"
) -> DataFrame:
    """`split` for rows of (id, label, group, firm_date, ...).

    Per label the first `share` of rows goes to test, by newest firm date, then hash,
    then id; afterwards a group of positives with any test row is test as a whole. The
    rank is distributed, so the label with nearly all rows does not sit in one task.
    """
    salted = order_hash(F.col("id"), f"_salt_{seed}_split", hash_kind)
    order = [F.col("firm_date").desc_nulls_last(), F.col("_hash"), F.col("id")]
    ranked = with_rank(keys.withColumn("_hash", salted), order, ["label"], "_nth", total="_of")
    marked = ranked.withColumn("_test", F.col("_nth") <= F.col("_of") * F.lit(share)).drop("_hash", "_nth", "_of")
    positive = F.col("label") == 1
    hit = marked.filter(positive & F.col("_test")).select("group").distinct().withColumn("_hit", F.lit(True))
    together = marked.filter(positive).join(hit, "group", "left").withColumn(
        "_test", F.coalesce("_hit", F.lit(False))
    )
    both = together.drop("_hit").unionByName(marked.filter(~positive))
    return both.withColumn("split", F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def assign_folds(
    split: DataFrame, folds: int = FOLDS, seed: int = SPLIT_SEED, hash_kind: str = "murmur3"
) -> DataFrame:
    """`fold`: blocks by issue date for train positives, cyclic by hash for train
    negatives, -1 for test.

    Groups of positives are laid out by their first issue date; a group takes the
    block of its first member, which follows from the running total of group sizes,
    so no member-level ordering is needed.
    """
    # Read three times below; stored, the narrow rows are computed once.
    split = stage_table(split, "split")
    train, positive = F.col("split") == "train", F.col("label") == 1
    winners = split.filter(train & positive)
    sizes = winners.groupBy("group").agg(
        F.min("issue_date").alias("_since"), F.count(F.lit(1)).alias("_size")
    )
    laid = with_running_totals(
        sizes, [F.col("_since").asc_nulls_last(), F.col("group")], {"_upto": F.col("_size")}
    )
    before = F.col("_upto") - F.col("_size")
    blocks = laid.select("group", F.floor(before * folds / F.col("_upto_all")).cast("int").alias("fold"))
    salted = order_hash(F.col("id"), f"_salt_{seed + 1}_fold", hash_kind)
    losers = split.filter(train & ~positive).withColumn("_hash", salted)
    cyclic = with_rank(losers, [F.col("_hash"), F.col("id")], (), "_nth")
    return (
        winners.join(blocks, "group")
        .unionByName(
            cyclic.withColumn("fold", ((F.col("_nth") - 1) % folds).cast("int")).drop("_hash", "_nth")
        )
        .unionByName(split.filter(~train).withColumn("fold", F.lit(-1)))
    )


def split_keys(labelled: DataFrame) -> DataFrame:
    """The narrow rows the split and the folds are decided on."""
    return labelled.select("id", "label", _group_key().alias("group"), "firm_date", "issue_date")


def curate(
    features: DataFrame,
    register: DataFrame,
    exclusions: DataFrame,
    cutoff: str | None = None,
    seed: int = SPLIT_SEED,
    hash_kind: str = "murmur3",
    keep_dates: bool = False,
) -> DataFrame:
    """Features to the curated table: id, label, split, fold, features and encodings.

    Split and folds are decided on narrow rows and joined back by id, so the wide
    feature rows are shuffled once and never sorted. Pass stored features: they are
    read twice, for the narrow rows and for the table itself.
    """
    labelled = attach_label(drop_excluded(features, exclusions), register)
    if cutoff is not None:
        labelled = within_label_window(labelled, cutoff, label_end(register))
    placed = assign_folds(assign_split(split_keys(labelled), seed=seed, hash_kind=hash_kind), seed=seed, hash_kind=hash_kind)
    dropped = ["entity_id", "representative"] + ([] if keep_dates else ["issue_date", "firm_date"])
    dataset = stage_table(labelled.join(placed.select("id", "split", "fold"), "id").drop(*dropped), "placed")
    have = set(dataset.columns)
    return encode_all(dataset, [(name, key) for name, needed, key in standard_encodings() if set(needed) <= have])


def label_coverage(features: DataFrame, register: DataFrame) -> DataFrame:
    """One row: registered ids, and those that have a feature row.

    A semi join keeps each registered id at most once, whatever the feature side repeats.
    """
    known = register.join(features.select("entity_id"), "entity_id", "left_semi")
    found = known.select(F.count_distinct("entity_id").alias("n")).scalar()
    return register.agg(F.count(F.lit(1)).alias("registered")).withColumn("found", found)


def scoring_dataset(features: DataFrame, register: DataFrame) -> DataFrame:
    """Features with the register's flag; entities outside the register read false."""
    return features.join(register, "entity_id", "left").withColumn(
        "positive", F.coalesce("positive", F.lit(False))
    )
