"""Every registered query: operators applied to the bound inputs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.functions.dates import day_first_date, serial_date
from lakerisk.functions.ids import valid_id
from lakerisk.functions.regions import clean_region, normalise_region, region_from_code
from lakerisk.functions.text import experiment_of, run_id_of
from lakerisk.operators import (
    baselines, curation, curves, dedup, eda, encoding, evaluation, features, models, preparation, quality,
    quantiles, quarantine, ranking, regional, runs,
)
from lakerisk.plans import lake_queries, views
from lakerisk.plans.bindings import bind, bind_spread, load, run_records
from lakerisk.plans.oracle import AFFILIATION_CUTOFF, CUTOFFS, FEATURES, LABEL_CUTOFF, MODELS, MONTH, NULL_COLUMNS, ORDER_CUTOFF
from lakerisk.session import scratch_path, stage_table
from lakerisk.sources import readers, small

YEARS = (1996, 2000)
Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, columns: Sequence[str], digits: int = 9) -> DataFrame:
    """Sums of doubles depend on their order in the last bits; round them at the edge."""
    return df.withColumns({c: F.round(c, digits) for c in columns if c in df.columns})


def _silver_registry(spark, d):
    return quarantine.split_registry(bind(spark, d, "registry"))[0]


def _snapshot(spark, d, registry=None):
    return regional.reference_snapshot(_silver_registry(spark, d) if registry is None else registry, 2001, 6)[0]


def _summary(spark, d, registry=None):
    snapshot = _snapshot(spark, d, registry)
    return regional.regional_summary(
        regional.active_by_region(snapshot),
        regional.informality_by_region(bind(spark, d, "survey")),
        regional.revenue_by_region(bind(spark, d, "revenue"), 2001),
        regional.exclusions_by_region(bind(spark, d, "exclusions"), snapshot),
    )


def _stored_summary(spark, d, registry=None):
    """The regional summary as the views find it: a stored table of a few rows."""
    return stage_table(_summary(spark, d, registry), "regional")


def _features(spark, d, cutoffs):
    # Cleaning the names of regions costs more than reading them back, and three parts read the registry.
    registry = stage_table(_silver_registry(spark, d), "registry")
    summary = _stored_summary(spark, d, registry)
    return features.feature_table(
        registry, bind(spark, d, "snapshots"), bind_spread(spark, d, "feed"), bind(spark, d, "exclusions"),
        bind(spark, d, "affiliations"), cutoffs, features.regional_rate(summary),
    )


def _one_month(spark, d):
    return _features(spark, d, [(MONTH, ORDER_CUTOFF)])


def _labelled(spark, d):
    register = bind(spark, d, "register")
    kept = curation.drop_excluded(_one_month(spark, d), bind(spark, d, "exclusions"))
    return curation.within_label_window(curation.attach_label(kept, register), LABEL_CUTOFF, curation.label_end(register))


def _placed(spark, d):
    keys = stage_table(curation.split_keys(_labelled(spark, d)), "keys")
    return curation.assign_folds(curation.assign_split(keys, hash_kind="md5"), hash_kind="md5")


def _curated(spark, d):
    """Labelled rows with split and fold, before the encodings."""
    labelled = stage_table(_labelled(spark, d), "labelled")
    placed = curation.assign_folds(
        curation.assign_split(curation.split_keys(labelled), hash_kind="md5"), hash_kind="md5"
    )
    return labelled.join(placed.select("id", "split", "fold"), "id")


def _curated_dataset(spark, d):
    return curation.curate(
        stage_table(_one_month(spark, d), "features"), bind(spark, d, "register"), bind(spark, d, "exclusions"), LABEL_CUTOFF, hash_kind="md5"
    )


def _preds(spark, d):
    return bind(spark, d, "preds")


def _bronze(spark, d):
    return quarantine.split_by_year(bind_spread(spark, d, "feed"), ["issue_date"], YEARS)


def _latest_orders(spark, d):
    return dedup.keep_latest_order(bind_spread(spark, d, "feed"))


def _exact_latest(spark, d):
    """Keep-latest with a fixed order among equal dates, which SQL can repeat."""
    feed = bind_spread(spark, d, "feed")
    order = [F.col(c).desc() for c in ("year", "month", "issue_date")] + [F.col("part_key"), F.col("line_no")] + [
        F.col(c).asc_nulls_last() for c in ("buyer_id", "amount", "currency", "order_status")
    ]
    numbered = dedup.keep_first(feed.filter(F.col("order_no").isNotNull()), ["order_no"], order)
    return numbered.unionByName(feed.filter(F.col("order_no").isNull()))


# ---- scans, quarantine and cleaning -------------------------------------------------

def ingest_split(spark, d):
    """Orders written as CSV with broken cells, read back and split by schema and year."""
    orders = load(spark, d, "orders")
    path = scratch_path(spark, "raw-orders")
    broken = F.when(F.col("o_orderkey") % 50 == 0, F.lit("not a number")).otherwise(
        F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    )
    text = orders.select("o_orderkey", broken.alias("o_totalprice"), F.to_date("o_orderdate").alias("o_orderdate"))
    text.write.option("header", True).csv(path)
    schema = spark.createDataFrame([], "o_orderkey bigint, o_totalprice double, o_orderdate date").schema
    clean, by_schema = quarantine.split_by_schema(readers.read_raw_csv(spark, path, schema))
    clean, by_year = quarantine.split_by_year(clean, ["o_orderdate"], YEARS)
    rejected = quarantine.merge_rejects(by_schema, by_year)
    side = F.when(F.col(readers.CORRUPT).isNotNull(), "schema").otherwise("year")
    named = rejected.select("o_orderkey", "o_totalprice", side.alias("side"))
    return clean.select("o_orderkey", "o_totalprice", F.lit("clean").alias("side")).unionByName(named)


def date_range_quarantine(spark, d):
    rejected = quarantine.year_out_of_range(["issue_date"], YEARS).alias("rejected")
    return bind_spread(spark, d, "feed").groupBy(rejected).agg(F.count(F.lit(1)).alias("rows"))


def id_validity(spark, d):
    checks = [valid_id(F.col("buyer_id")).alias("buyer_ok"), valid_id(F.col("contractor_id")).alias("contractor_ok")]
    return bind_spread(spark, d, "feed").groupBy(*checks).agg(F.count(F.lit(1)).alias("rows"))


def orders_quarantine(spark, d):
    accepted, reasons = quarantine.order_rules()
    return _exact_latest(spark, d).groupBy(accepted.alias("ok"), reasons.alias("reject_reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount")
    )


def registry_quarantine(spark, d):
    return features.with_ref_month(_silver_registry(spark, d)).select("entity_id", "region", "ref_month")


def quality_report(spark, d):
    bronze = bind_spread(spark, d, "feed")
    entered = stage_table(_exact_latest(spark, d).withColumn("region", F.lit(None).cast("string")), "entered")
    silver, rejected = quarantine.split_orders(entered)
    return quality.quality_report("orders", bronze, entered, silver, rejected)


def layer_losses(spark, d):
    bronze, rejected = _bronze(spark, d)
    silver, _ = quarantine.split_orders(bronze.withColumn("region", F.lit(None).cast("string")))
    return quality.layer_losses(bronze, rejected, silver)


def completeness(spark, d):
    feed = bind_spread(spark, d, "feed").withColumn("region", F.when(F.col("part_key") % 3 > 0, "LIMA"))
    return quality.completeness(feed, ["order_no", "buyer_id", "region", "amount", "issue_date"])


def id_column_guard(spark, d):
    valid = small.with_valid_id(bind_spread(spark, d, "feed").select(F.col("contractor_id").alias("entity_id")))
    return valid.groupBy("entity_id").agg(F.count(F.lit(1)).alias("rows"))


# ---- small sources and scalar functions ---------------------------------------------

def normalised_regions(spark, d):
    raw = F.col("region")
    return bind(spark, d, "registry").select("entity_id", normalise_region(raw).alias("region"), clean_region(raw).alias("cleaned"))


def code_map(spark, d):
    return load(spark, d, "supplier").select("s_suppkey", region_from_code(F.col("s_nationkey") + 1).alias("region"))


def serial_dates(spark, d):
    day = F.to_date("o_orderdate")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string")
    raw = load(spark, d, "orders").select("o_orderkey", serial.alias("n"), F.date_format(day, "d/M/yyyy").alias("t"))
    return raw.select("o_orderkey", serial_date(F.col("n")).alias("from_serial"), day_first_date(F.col("t")).alias("from_text"))


# Month headers as source files spell them.
MONTH_HEADERS = ["ene", "FEB", "Mar.", "abr", "may", "jun.", "JUL", "ago", "SET.", "oct", "Nov.", "Dic"]


def revenue_unpivot(spark, d):
    """All months of all years side by side, beside a column of totals and one of marks, back to long rows."""
    sales = load(spark, d, "orders").join(load(spark, d, "customer"), F.col("c_custkey") == F.col("o_custkey")).join(
        load(spark, d, "nation"), F.col("n_nationkey") == F.col("c_nationkey")
    )
    at = F.to_date("o_orderdate")
    first, last = sales.agg(F.min(F.year(at)), F.max(F.year(at))).first()
    heads = [f"{year}_{month}" for year in range(first, last + 1) for month in MONTH_HEADERS]
    head = F.concat(F.year(at), F.lit("_"), F.get(F.array(*map(F.lit, MONTH_HEADERS)), F.month(at) - 1))
    wide = sales.select(
        F.when(F.col("n_nationkey") == 6, "Provincia Constitucional del Callao").alias("cell_a"), F.col("n_name").alias("cell_b"),
        head.alias("head"), F.col("o_totalprice").cast("decimal(18,2)").alias("cents"),
    ).groupBy("cell_a", "cell_b").pivot("head", heads).agg(F.sum("cents"))
    marked = wide.withColumns({f"{last + 1}_Dic": F.lit("n.d."), f"{last}_total": F.lit(0)})
    return small.revenue_long(marked, ("cell_a", "cell_b"))


def oldest_resolution(spark, d):
    key = F.lit(10000000000) * (1 + F.col("o_custkey") % 2) + F.col("o_custkey")
    rows = load(spark, d, "orders").select(key.alias("entity_id"), F.to_date("o_orderdate").alias("issue_date"), F.col("o_orderkey").alias("source_row"))
    return small.oldest_per_key(rows)


def clean_affiliations(spark, d):
    loud = bind(spark, d, "affiliations").withColumns(
        {"voucher_type": F.concat(F.lit("  "), F.upper("voucher_type")), "start_date": F.col("start_date").cast("string")}
    )
    return small.affiliations(loud)


def clean_survey(spark, d):
    return small.survey(bind(spark, d, "survey")).groupBy("code", "employed", "informal").agg(
        F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows")
    )


def clean_exclusions(spark, d):
    key = F.lit(10000000000) * (1 + F.col("o_custkey") % 2) + F.col("o_custkey")
    return small.exclusion_list(load(spark, d, "orders").select(key.cast("string").alias("entity_id"), F.col("o_orderpriority").alias("name")))


# ---- curation and its checks --------------------------------------------------------

def label_join(spark, d):
    registry = bind(spark, d, "registry").filter((F.col("year") == 2001) & (F.col("month") == 6))
    keyed = registry.withColumn("id", F.lpad(F.col("entity_id").cast("string"), 11, "0"))
    return curation.attach_label(keyed, bind(spark, d, "register")).select("entity_id", "issue_date", "firm_date", "representative", "label")


def label_coverage(spark, d):
    contractors = features.order_facts(bind_spread(spark, d, "feed"))
    return curation.label_coverage(contractors, bind(spark, d, "register"))


def scoring_dataset(spark, d):
    base = features.registry_features(_silver_registry(spark, d), MONTH)
    return curation.scoring_dataset(base, bind(spark, d, "register")).select("entity_id", "positive", "issue_date", "region")


def split_70_30(spark, d):
    keys = stage_table(curation.split_keys(_labelled(spark, d)), "keys")
    return curation.assign_split(keys, hash_kind="md5").select("id", "label", "group", "split")


def group_cohesion(spark, d):
    return _placed(spark, d).groupBy("label", "group").agg(
        F.count_distinct("split").alias("splits"), F.count_distinct("fold").alias("folds"), F.count(F.lit(1)).alias("rows")
    )


def target_encoding(spark, d):
    return encoding.encode_out_of_fold(stage_table(_curated(spark, d)), F.col("region"), "te").select("id", "te")


def weighted_encoding(spark, d):
    weight = F.when(F.col("label") == 1, 1.0).otherwise(2.5)
    return encoding.encode_out_of_fold(stage_table(_curated(spark, d)), F.col("region"), "te", m=50, weight=weight).select("id", "te")


def exclusion_leak(spark, d):
    listed = bind(spark, d, "exclusions").select(F.lpad(F.col("entity_id").cast("string"), 11, "0").alias("id"))
    return quality.leaked_exclusions(_curated(spark, d).select("id"), listed)


# ---- evaluation and views -----------------------------------------------------------

def _official(spark, d):
    return _rounded(evaluation.ranking_metrics(_preds(spark, d)), ["pr_auc", "roc_auc", "brier"])


def _test_metrics(spark, d):
    return _official(spark, d).filter(F.col("split") == "test")


def baseline_rule(spark, d):
    return baselines.rule_score(_one_month(spark, d)).select("entity_id", "score", "run_id")


def baseline_constant(spark, d):
    return baselines.constant_score(_one_month(spark, d)).select("entity_id", "score", "run_id")


def baseline_random(spark, d):
    rows = _preds(spark, d).select(F.col("id").cast("string").alias("id"))
    return baselines.random_score(rows, 42, "md5").select(F.col("id").cast("long").alias("id"), "score", "run_id")


def view_audit_ranking(spark, d):
    # The bound registry lies in 2001: one of its months stands for the month of each version.
    stands = spark.createDataFrame([("v1", MONTH), ("v2", MONTH), ("v3", "200103")], "dataset_version string, bound string")
    official = ranking.version_months(spark).join(stands, "dataset_version").select("bound", F.col("ref_month").alias("official"))
    facts = _features(spark, d, CUTOFFS)
    placed = facts.join(official, F.col("ref_month") == F.col("bound")).withColumn("ref_month", F.col("official"))
    shown = views.audit_ranking(_preds(spark, d), bind(spark, d, "runs"), placed)
    return shown.drop("points")


def view_leaderboard(spark, d):
    preds = _preds(spark, d).filter(F.col("split") == "test")
    board = views.leaderboard(run_records(spark, d), evaluation.flat_metrics(preds))
    shown = _rounded(board, ["pr_auc", "roc_auc", "brier"])
    return shown.drop("pr_auc_low", "pr_auc_high", "recall_capital", "recall_rest", "instance", "billable_seconds", "cost_usd")


def flat_metric_rows(spark, d):
    return evaluation.flat_metrics(_preds(spark, d), replicates=1000)


def bootstrap_bounds(spark, d):
    """Whether each interval holds the average precision it is for, and its replicates, where there are 30 positives or more."""
    preds = _preds(spark, d)
    joined = evaluation.rank_areas(preds).join(evaluation.bootstrap_interval(preds), list(evaluation.RUN))
    enough = F.col("n_positives") >= evaluation.FEW_POSITIVES
    return joined.select(
        *evaluation.RUN, "n", "n_positives", F.when(enough, F.col("replicates")).alias("replicates"),
        F.when(enough, (F.col("pr_auc_low") <= F.col("pr_auc")) & (F.col("pr_auc") <= F.col("pr_auc_high"))).alias("holds"),
    )


def run_summary(spark, d):
    summary = runs.run_summary(run_records(spark, d))
    kept = summary.select("run_id", "cv_pr_auc_mean", "cv_pr_auc_std", "cv_recall_1pct_mean", "train_pr_auc", "overfit_gap")
    return _rounded(kept, ["cv_pr_auc_std"])


def champion(spark, d):
    results = runs.run_summary(run_records(spark, d)).withColumns({"status": F.lit("SUCCESS"), "cv_scheme": F.lit("bloques")})
    return runs.choose_champion(results)


def consolidated_runs(spark, d):
    scored = _official(spark, d).withColumns({"pr_auc_low": F.col("pr_auc"), "pr_auc_high": F.col("pr_auc")})
    return runs.consolidate(run_records(spark, d), scored).drop("test_pr_auc_low", "test_pr_auc_high")


def run_record_files(spark, d):
    path = scratch_path(spark, "records")
    run_records(spark, d).write.json(path)
    valid, rejected = readers.read_run_records(spark, path)
    shown = ["run_id", "model_name", "variant", "dataset_version", F.col("metricas_cv.cv_pr_auc_mean").alias("cv_pr_auc_mean")]
    return valid.select(*shown, F.lit("").alias("errors")).unionByName(rejected.select(*shown, "errors"))


def run_ids(spark, d):
    rebuilt = run_id_of("risk-run", experiment_of(F.col("run_id"), "risk-run"), F.col("model_name"), F.col("variant"), F.col("weighted"))
    return bind(spark, d, "runs").select("run_id", rebuilt.alias("rebuilt"))


# ---- exploration --------------------------------------------------------------------

def _classified(spark, d):
    return curation.scoring_dataset(bind(spark, d, "registry"), bind(spark, d, "register"))


def eda_correlation(spark, d):
    lines = load(spark, d, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount")
    )
    return _rounded(eda.correlations(lines, ["quantity", "price", "discount"]), ["r"], 6)


def _described(spark, d, by=()):
    return _rounded(eda.describe(bind_spread(spark, d, "feed"), "amount", by, exact=True), ["mean", "spread"], 4)


# ---- model preparation and models ---------------------------------------------------

def prep_winsor_log(spark, d):
    feed = bind_spread(spark, d, "feed")
    cap = stage_table(quantiles.exact_quantiles(feed, "amount", {"cap": preparation.TOP_QUANTILE}), "cap").select("cap").scalar()
    logged = preparation.soft_log(preparation.top_coded(F.col("amount"), cap))
    return _rounded(feed.select("order_no", "part_key", "line_no", "amount", logged.alias("amount_log")), ["amount_log"])


def prep_impute(spark, d):
    base = features.registry_features(_silver_registry(spark, d), MONTH)
    middle = stage_table(quantiles.exact_quantiles(base, "workers", {"m": 0.5}), "median").select("m").scalar()
    return base.select("entity_id", F.coalesce("workers", middle).alias("workers"), F.col("workers").isNull().cast("int").alias("workers_missing"))


def prep_onehot_topk(spark, d):
    base = features.registry_features(_silver_registry(spark, d), MONTH)
    kept = preparation.frequent_categories(base, {"activity": preparation.DEFAULT_CATEGORY_LIMIT})["activity"]
    return base.select("entity_id", preparation.pool_rare(F.col("activity"), kept).alias("activity"))


def preparation_fitted(spark, d):
    """The preparation of the linear models learnt on the feature table, and what it does to it."""
    rows = stage_table(_one_month(spark, d), "features")
    report = preparation.preparation_report(rows, preparation.fit_preparation(rows, "V1", linear=True))
    return _rounded(report, ["median", "cap", "mean", "least", "greatest"], 6)


def prep_class_weights(spark, d):
    rows = stage_table(_placed(spark, d).select("id", "label"), "placed")
    return rows.select("id", preparation.class_weight(rows).alias("weight"))


def negative_sample(spark, d):
    rows = stage_table(_placed(spark, d).select("id", "label"), "placed")
    return preparation.sample_negatives(rows, 3, hash_kind="md5")


def forward_cv_rounds(spark, d):
    return preparation.round_sizes(_placed(spark, d), preparation.forward_rounds(range(5)))


def _model_rows(spark, d):
    return stage_table(_curated(spark, d), "model-rows")


MODEL_SETTINGS = {
    "LR": {"c": 0.1, "max_iter": 50}, "DT": {"depth": 5, "leaf": 5}, "RF": {"trees": 20, "depth": 5, "leaf": 5},
    "GBT": {"rounds": 10, "depth": 3, "leaf": 5, "rate": 0.1}, "HGB": {"rounds": 5, "leaves": 15, "leaf": 5, "rate": 0.1},
}


def _predicted(rows: DataFrame, model: str) -> DataFrame:
    fitted = models.Learner(model, per_positive=5).fit_all(rows.filter(F.col("split") == "train"), [MODEL_SETTINGS[model]])[0]
    return models.score_population(rows, fitted, f"risk-run-{model.lower()}")


def model_scores(model: str) -> Query:
    """Fit on the train part with sampled negatives, score everyone, rank everyone."""
    return lambda spark, d: _predicted(_model_rows(spark, d), model)


def model_checks(spark, d):
    """What holds for the predictions of every model, whatever was learnt."""
    rows = _model_rows(spark, d)
    parts = [_predicted(rows, model).withColumn("model", F.lit(model)) for model in MODELS]
    scored = stage_table(reduce(DataFrame.unionByName, parts), "scored")
    seen = scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"), F.count_distinct("rank_global").alias("ranks"),
        F.min("rank_global").alias("first"), F.max("rank_global").alias("last"), F.every(F.col("score").between(0, 1)).alias("scores_are_chances"),
    )
    areas = evaluation.rank_areas(scored.filter(F.col("split") == "train"), ["model"]).select(
        "model", (F.col("pr_auc") > F.col("n_positives") / F.col("n")).alias("train_above_prevalence")
    )
    gapless = (F.col("first") == 1) & (F.col("last") == F.col("rows")) & (F.col("ranks") == F.col("rows"))
    return seen.join(areas, "model").select("model", "rows", "ids", gapless.alias("ranks_without_gap"), "scores_are_chances", "train_above_prevalence")


def model_cross_validation(spark, d):
    learner = models.Learner("DT", per_positive=5)
    per_round = models.cross_validate(_model_rows(spark, d), learner, models.settings({"depth": [3, 5], "leaf": [5]}))
    return models.grid_summary(per_round)


def model_forward_validation(spark, d):
    learner = models.Learner("LR", weighted=False, per_positive=5)
    return models.cross_validate(_model_rows(spark, d), learner, [{"c": 1.0, "max_iter": 50}], "temporal")


def model_coefficients(spark, d):
    rows = _model_rows(spark, d)
    fitted = models.Learner("LR").fit_all(rows.filter(F.col("split") == "train"), [{"c": 0.1, "max_iter": 50}])[0]
    return models.coefficients(spark, fitted)


def model_permutation(spark, d):
    rows = _model_rows(spark, d)
    fitted = models.Learner("DT").fit_all(rows.filter(F.col("split") == "train"), [{"depth": 4, "leaf": 5}])[0]
    return models.permutation_importance(fitted, rows.filter(F.col("split") == "train"))


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "contract_profile": lambda s, d: features.contract_profile(bind(s, d, "feed"), "2001-03-31"),
        "buyer_concentration": lambda s, d: features.contract_profile(bind(s, d, "feed"), "2001-03-31").select("entity_id", "top_buyer_share"),
        "registry_history": lambda s, d: features.registry_history(bind(s, d, "snapshots"), MONTH),
        "affiliation_features": lambda s, d: features.affiliation_features(bind(s, d, "affiliations"), AFFILIATION_CUTOFF),
        "registry_features": lambda s, d: features.registry_features(_silver_registry(s, d), MONTH),
        "feature_table": _one_month,
        "feature_table_multi_cutoff": lambda s, d: _features(s, d, CUTOFFS),
        "eligible_population": lambda s, d: curation.eligible_population(_one_month(s, d)).select("entity_id", "entity_type", "status", "affiliated"),
        "weighted_rate": lambda s, d: regional.informality_by_region(bind(s, d, "survey")),
        "active_by_region": lambda s, d: regional.active_by_region(_snapshot(s, d)),
        "revenue_by_region": lambda s, d: regional.revenue_by_region(bind(s, d, "revenue"), by=("year",)),
        "exclusions_by_region": lambda s, d: regional.exclusions_by_region(bind(s, d, "exclusions"), _snapshot(s, d)),
        "regional_summary": _summary,
        "latest_snapshot": lambda s, d: regional.reference_snapshot(bind(s, d, "registry"))[0].groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows")),
        "ingest_split": ingest_split,
        "date_range_quarantine": date_range_quarantine,
        "id_validity": id_validity,
        "registry_quarantine": registry_quarantine,
        "keep_latest": _exact_latest,
        "orders_quarantine": orders_quarantine,
        "quality_report": quality_report,
        "layer_losses": layer_losses,
        "completeness": completeness,
        "id_column_guard": id_column_guard,
        "normalise_region": normalised_regions,
        "code_map": code_map,
        "serial_dates": serial_dates,
        "revenue_unpivot": revenue_unpivot,
        "oldest_resolution": oldest_resolution,
        "clean_affiliations": clean_affiliations,
        "clean_survey": clean_survey,
        "clean_exclusions": clean_exclusions,
        "exclude_list": lambda s, d: curation.drop_excluded(
            bind(s, d, "registry").filter((F.col("year") == 2001) & (F.col("month") == 6)), bind(s, d, "exclusions")
        ).select("entity_id"),
        "label_join": label_join,
        "label_window": lambda s, d: curation.split_keys(_labelled(s, d)).select("id", "label", "issue_date", "group"),
        "label_coverage": label_coverage,
        "scoring_dataset": scoring_dataset,
        "split_70_30": split_70_30,
        "group_cohesion": group_cohesion,
        "cv_folds": lambda s, d: _placed(s, d).select("id", "label", "split", "fold"),
        "curated_dataset": lambda s, d: _curated_dataset(s, d).select("id", "label", "split", "fold", "te_activity", "te_activity_region", "te_cohort"),
        "target_encoding": target_encoding,
        "weighted_encoding": weighted_encoding,
        "curation_report": lambda s, d: quality.curation_report(_placed(s, d), "v2"),
        "dataset_invariants": lambda s, d: quality.dataset_invariants(_placed(s, d)),
        "duplicate_keys": lambda s, d: quality.repeated_keys(bind(s, d, "snapshots"), ["entity_id", "year", "month"]),
        "feature_audit": lambda s, d: quality.feature_audit(_curated(s, d), FEATURES),
        "feature_faults": lambda s, d: quality.feature_faults(_curated(s, d), FEATURES),
        "key_counts": lambda s, d: quality.key_counts(_placed(s, d)),
        "prevalence_by_split": lambda s, d: quality.prevalence_by_split(_placed(s, d)),
        "prevalence_by_fold": lambda s, d: quality.prevalence_by_fold(_placed(s, d)),
        "exclusion_leak": exclusion_leak,
        "null_rates": lambda s, d: quality.null_rates(_curated(s, d), NULL_COLUMNS),
        "positives_by_region": lambda s, d: quality.positives_by_region(stage_table(_curated(s, d).select("region", "label"))),
        "source_coverage": lambda s, d: quality.source_coverage(_curated(s, d)),
        "positive_dates": lambda s, d: quality.positive_dates(_placed(s, d)),
        "global_rank": lambda s, d: ranking.rank_population(_preds(s, d).select("id", "score", "run_id")),
        "rank_in_split": lambda s, d: ranking.rank_in_split(_preds(s, d).select("id", "score", "run_id", "split")).drop("score"),
        "topk_per_run": lambda s, d: ranking.top_per_split(_preds(s, d).select("id", "score", "run_id", "split"), 50),
        "topk_per_region": lambda s, d: ranking.top_per_region(_preds(s, d).select("id", "run_id", "split", "region", "score", "label")),
        "latest_run": lambda s, d: ranking.flag_latest_runs(bind(s, d, "runs")),
        "ranking_metrics": _official,
        "rank_areas": lambda s, d: _rounded(evaluation.rank_areas(_preds(s, d)), ["pr_auc", "roc_auc", "expected_recall_1pct"]),
        "segment_metrics": lambda s, d: _rounded(evaluation.segment_metrics(_preds(s, d)), ["pr_auc"]),
        "bootstrap_interval": lambda s, d: evaluation.bootstrap_interval(_preds(s, d)),
        "bootstrap_bounds": bootstrap_bounds,
        "flat_metrics": flat_metric_rows,
        "pr_points": lambda s, d: curves.precision_recall_points(_preds(s, d)),
        "roc_points": lambda s, d: curves.roc_points(_preds(s, d)),
        "gain_lift": lambda s, d: curves.gain_lift_points(_preds(s, d)),
        "calibration": lambda s, d: _rounded(curves.calibration_points(_preds(s, d)), ["mean_score", "positive_share"]),
        "score_density": lambda s, d: curves.density_points(_preds(s, d)),
        "score_histogram": lambda s, d: _rounded(curves.score_histogram(_preds(s, d)), ["mean_score"]),
        "score_histogram_open": lambda s, d: _rounded(curves.score_histogram(_preds(s, d), clamp=False), ["mean_score"]),
        "baseline_constant": baseline_constant,
        "baseline_rule": baseline_rule,
        "baseline_random": baseline_random,
        "view_active_share": lambda s, d: views.active_share(_stored_summary(s, d)),
        "view_exclusion_concentration": lambda s, d: views.exclusion_concentration(_stored_summary(s, d)),
        "view_quadrants": lambda s, d: views.quadrants(_stored_summary(s, d)),
        "view_audit_ranking": view_audit_ranking,
        "view_score_distribution": lambda s, d: views.score_distribution(_preds(s, d), bind(s, d, "runs"), _test_metrics(s, d)),
        "view_regional_panorama": lambda s, d: views.regional_panorama(_stored_summary(s, d), _preds(s, d), bind(s, d, "runs")),
        "view_leaderboard": view_leaderboard,
        "run_summary": run_summary,
        "champion": champion,
        "record_numbers": lambda s, d: runs.clean_record_numbers(
            bind(s, d, "registry").select("entity_id", "year", "month", "workers_text"), ["workers_text"]
        ),
        "matrix_gaps": lambda s, d: runs.matrix_gaps(run_records(s, d)),
        "consolidated_runs": consolidated_runs,
        "run_records": run_record_files,
        "run_ids": run_ids,
        "eda_balance": lambda s, d: eda.class_balance(_classified(s, d)),
        "eda_incidence": lambda s, d: eda.incidence(_classified(s, d), "condition"),
        "eda_frequencies": lambda s, d: eda.frequencies(bind(s, d, "registry"), "status"),
        "eda_correlation": eda_correlation,
        "eda_amounts": lambda s, d: _described(s, d),
        "eda_amounts_by_class": lambda s, d: _described(s, d, ["order_status"]),
        "eda_histogram": lambda s, d: eda.value_histogram(bind(s, d, "feed"), "amount"),
        "eda_non_canonical": lambda s, d: quality.odd_regions(bind(s, d, "registry").select(clean_region(F.col("region")).alias("region"))),
        "eda_regional_table": lambda s, d: eda.regional_table(_stored_summary(s, d)),
        "prep_winsor_log": prep_winsor_log,
        "prep_impute": prep_impute,
        "prep_onehot_topk": prep_onehot_topk,
        "preparation_fitted": preparation_fitted,
        "prep_class_weights": prep_class_weights,
        "negative_sample": negative_sample,
        "forward_cv_rounds": forward_cv_rounds,
        **{f"model_{model.lower()}": model_scores(model) for model in MODELS},
        "model_checks": model_checks,
        "model_cross_validation": model_cross_validation,
        "model_forward_validation": model_forward_validation,
        "model_coefficients": model_coefficients,
        "model_permutation": model_permutation,
    }
    return q | lake_queries.QUERIES


def flagship(spark: SparkSession, folder: str, k: int = 100) -> DataFrame:
    """The riskiest entities by the analyst rule, over the full feature table."""
    scored = baselines.rule_score(_one_month(spark, folder))
    top = scored.orderBy(F.col("score").desc(), F.col("total_amount").desc(), F.col("entity_id")).limit(k)
    return top.select("entity_id", "region", "score", "condition", "workers", "n_orders", "total_amount", "regional_informal_pct")
