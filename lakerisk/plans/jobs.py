"""The pipeline from raw files to the curated table. Every job stages, verifies, and commits its outputs together."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.config import MAX_REJECT_RATE, LakePaths, cutoff_of, parse_cutoffs
from lakerisk.operators import curation, dedup, evaluation, features, models, quality, quarantine, regional
from lakerisk.operators.encoding import standard_encodings
from lakerisk.session import drop_staged, stage_table
from lakerisk.sources import commits, readers, schemas, small, writers
from lakerisk.sources.commits import Publication

MONTHLY = ["year", "month"]


@dataclass(frozen=True)
class Feed:
    """One of the two monthly feeds and how to clean it."""

    name: str
    columns: list
    dates: list[str]
    prepare: Callable[[DataFrame], DataFrame]
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]]


REGISTRY = Feed("registry", schemas.REGISTRY_COLUMNS, [], dedup.registry_snapshot, quarantine.split_registry)
ORDERS = Feed("orders", schemas.ORDER_COLUMNS, schemas.ORDER_DATES, dedup.keep_latest_order, quarantine.split_orders)


def _aside(layer: str, name: str) -> str:
    """Name of a table's quarantine; that of silver is a first-level folder, so catalogues list it."""
    return f"quarantine/{name}" if layer == "bronze" else f"quarantine_{name}"


def ingest(spark: SparkSession, paths: LakePaths, feed: Feed, raw: str | None = None) -> dict[str, int]:
    """Raw CSV to bronze: typed rows by month, rejects apart; returns the live rows of both tables.

    `raw` is the folder of this load's files (None: the feed's own folder of the raw layer).

    Every month the raw folder holds is replaced on both sides, also one whose rows were all
    rejected; other months stay. The parsed rows are staged once, so the text is not parsed again
    for each side. Both tables go live together.
    """
    _, schema = schemas.CONTRACTS[feed.name]
    raw_names = {neutral: raw for raw, _, neutral in feed.columns}
    parsed = stage_table(readers.read_raw_csv(spark, raw or paths.table("raw", feed.name), schema), f"parsed-{feed.name}")
    try:
        clean, rejected = quarantine.split_parsed(parsed, [raw_names[c] for c in feed.dates])
        by = schemas.PARTITION_COLUMNS
        loaded = [tuple(r) for r in parsed.select(*by).distinct().collect()]  # the months of this load
        with Publication(spark, paths, f"ingest-{feed.name}") as out:
            sides = [(feed.name, clean), (_aside("bronze", feed.name), rejected)]
            with ThreadPoolExecutor(len(sides)) as pool:  # the last tasks of one side leave cores to the other
                list(pool.map(lambda side: out.stage("bronze", *side, by, replaces=loaded), sides))
    finally:
        drop_staged(parsed)
    names = {"clean": feed.name, "rejected": _aside("bronze", feed.name)}
    return {side: commits.live_rows(spark, paths, "bronze", name) for side, name in names.items()}


def clean(spark: SparkSession, paths: LakePaths, feed: Feed, maximum: float = MAX_REJECT_RATE) -> DataFrame:
    """Bronze to silver. Nothing goes live unless contract, reject rate and row counts hold; then
    silver, its quarantine and the report do together."""
    bronze = commits.require_table(spark, paths, "bronze", feed.name)
    schemas.check_contract(bronze.schema, feed.name)
    named = schemas.neutral_names(bronze, feed.columns)
    aside = commits.read_table(spark, paths, "bronze", _aside("bronze", feed.name))
    bronze_rejected = None if aside is None else schemas.neutral_names(aside, feed.columns)
    entered = stage_table(feed.prepare(named), f"entered-{feed.name}")
    try:
        silver, rejected = feed.split(entered)
        report = stage_table(quality.quality_report(feed.name, named, entered, silver, rejected, bronze_rejected), "quality")
        quality.gate_reject_rate(report, maximum)
        with Publication(spark, paths, f"clean-{feed.name}") as out:
            out.stage("silver", feed.name, silver, MONTHLY)
            quality.gate_parts(report, out.part_rows("silver", feed.name))
            out.stage("silver", _aside("silver", feed.name), rejected, MONTHLY)
            out.stage("silver", "quality_report", report, ["source"], replaces=[(feed.name,)])
    finally:
        drop_staged(entered)
    return report


def prepare_side_source(spark: SparkSession, paths: LakePaths, name: str, raw: DataFrame, tidy: Callable[[DataFrame], DataFrame]) -> int:
    """A small source through bronze (as read) to silver (tidied); silver is read from the staged bronze."""
    with Publication(spark, paths, f"side-{name}") as out:
        out.stage("silver", name, tidy(out.stage("bronze", name, raw)))
    return commits.live_rows(spark, paths, "silver", name)


SIDE_SOURCES = {
    "exclusions": small.exclusion_list,
    "register": small.label_register,
    "affiliations": small.affiliations,
    "survey": small.survey,
    "revenue": small.revenue,
}


def build_regional(spark: SparkSession, paths: LakePaths, year: int | None = None, month: int | None = None) -> int:
    """Regional summary of one snapshot month (the newest unless given)."""
    silver = lambda name: commits.require_table(spark, paths, "silver", name)
    snapshot, year, _ = regional.reference_snapshot(silver("registry"), year, month)
    summary = regional.regional_summary(
        regional.active_by_region(snapshot),
        regional.informality_by_region(silver("survey")),
        regional.revenue_by_region(silver("revenue"), year),
        regional.exclusions_by_region(silver("exclusions"), snapshot),
    )
    with Publication(spark, paths, "regional") as out:
        out.stage("gold", "regional_summary", summary, single_file=True)
    return commits.live_rows(spark, paths, "gold", "regional_summary")


def build_features(spark: SparkSession, paths: LakePaths, cutoffs: str | None = None) -> int:
    """Feature rows of every cut-off; the regional summary must exist."""
    chosen = parse_cutoffs(cutoffs)
    silver = lambda name: commits.require_table(spark, paths, "silver", name)
    rates = features.regional_rate(commits.require_table(spark, paths, "gold", "regional_summary"))
    registry = silver("registry")
    table = features.feature_table(
        registry, registry, silver("orders"), silver("exclusions"), silver("affiliations"), chosen, rates
    )
    with Publication(spark, paths, "features") as out:
        quality.gate_features(out.stage("gold", "features", table, ["ref_month"]), [month for month, _ in chosen])
    return commits.live_rows(spark, paths, "gold", "features")


def build_scoring(spark: SparkSession, paths: LakePaths) -> tuple[int, DataFrame]:
    """Features with the register's flag, and the coverage of the register."""
    table = commits.require_table(spark, paths, "gold", "features")
    register = commits.require_table(spark, paths, "silver", "register")
    with Publication(spark, paths, "scoring") as out:
        out.stage("gold", "scoring_dataset", curation.scoring_dataset(table, register), ["ref_month"])
    return commits.live_rows(spark, paths, "gold", "scoring_dataset"), curation.label_coverage(table, register)


def build_curated(spark: SparkSession, paths: LakePaths, version: str, cutoff: tuple[str, str] | None = None) -> DataFrame:
    """Curated table of a dataset version, checked before its partition is replaced."""
    month, date = cutoff or cutoff_of(version)
    table = commits.require_table(spark, paths, "gold", "features").filter(F.col("ref_month").cast("string") == month)
    dataset = curation.curate(
        curation.eligible_population(table),
        commits.require_table(spark, paths, "silver", "register"),
        commits.require_table(spark, paths, "silver", "exclusions"),
        date,
    )
    with Publication(spark, paths, f"curated-{version}") as out:
        checked = out.stage("gold", "model_inputs", dataset.withColumn("dataset_version", F.lit(version)), ["dataset_version"], replaces=[(version,)])
        quality.gate_dataset(checked)
        quality.gate_features_filled(checked, [name for name, _, _ in standard_encodings()])
    return quality.curation_report(checked, version)


def train(
    spark: SparkSession, paths: LakePaths, version: str, code: str, tag: str = "", grid=None, replicates: int = 1000, ks=evaluation.ABSOLUTE_KS
) -> str:
    """Run one experiment on the curated table; predictions, record and metrics go live together.

    Only the rows of the run are replaced. A cut-off above the test rows is an error, as are train rows
    among what is scored. The record and the metrics are also exported as NDJSON. Returns the run id.
    """
    inputs = commits.require_table(spark, paths, "gold", "model_inputs")
    dataset = inputs.filter(F.col("dataset_version") == version).drop("dataset_version")
    _, predictions, record = models.run_experiment(dataset, code, version, tag, grid)
    run_id = predictions.select("run_id").first()[0]
    run, own = ["run_id"], [(run_id,)]
    with Publication(spark, paths, f"train-{run_id}") as out:
        written = out.stage("gold", "model_outputs", predictions, run, replaces=own)
        test = evaluation.check_predictions(written.filter(F.lower("split") == "test"), ks=ks)
        flat = stage_table(evaluation.flat_metrics(test, ks=ks, replicates=replicates), "metrics")
        out.stage("gold", "runs", record, run, replaces=own)
        out.stage("gold", "metrics", flat, run, replaces=own)
    record.coalesce(1).write.mode("overwrite").json(f"{paths.table('gold', 'model_runs')}/run={run_id}")
    writers.write_metric_rows(flat, f"{paths.table('gold', 'model_metrics')}/run={run_id}")
    drop_staged(flat)
    return run_id
