"""Spark ML models: pipelines, cross-validation, scoring, explanation."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import product
from random import Random

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerisk.config import ENCODING_WEIGHT, RUN_PREFIX
from lakerisk.functions.ids import hash_uniform
from lakerisk.operators.boosting import LeafwiseBoosting
from lakerisk.operators.encoding import apply_rates, category_rates, negative_weight, standard_encodings
from lakerisk.operators.evaluation import rank_areas
from lakerisk.operators.ordering import with_rank
from lakerisk.operators.preparation import (
    INFREQUENT,
    Preparation,
    block_rounds,
    class_weight,
    fit_preparation,
    forward_rounds,
    sample_negatives,
)
from lakerisk.operators.pruning import PruningTree
from lakerisk.operators.ranking import rank_population
from lakerisk.operators.runs import best_parameters
from lakerisk.session import stage_table

# The experiment matrix. (id, model, variant, weighted, negatives per
# positive, scheme, grid); the grid uses the names of this module.
_LR_GRID = {"c": [0.01, 0.1, 1.0, 10.0]}
_DT_GRID = {"depth": [3, 5, 6], "leaf": [50, 200]}
_RF_GRID = {"trees": [300], "depth": [8, 16], "leaf": [50, 200]}
_HGB_GRID = {"rate": [0.05, 0.1], "rounds": [200, 400], "leaves": [15, 31], "leaf": [20, 100]}
EXPERIMENTS = [
    ("E1", "LR", "V2", True, 200, "bloques", _LR_GRID),
    ("E2", "DT", "V2", True, 200, "bloques", _DT_GRID),
    ("E3", "LR", "V1", True, 200, "bloques", _LR_GRID),
    ("E4", "DT", "V1", True, 200, "bloques", _DT_GRID),
    ("E5", "LR", "V2", False, 200, "bloques", _LR_GRID),
    ("E6", "DT", "V2", False, 200, "bloques", _DT_GRID),
    ("E9", "LR", "V2", True, 200, "bloques", {"c": [0.03, 0.3, 3.0, 30.0, 100.0, 300.0, 1000.0]}),
    ("E10", "DT", "V2", True, 200, "bloques", {"depth": [8, 10, 12], "leaf": [20, 100, 500]}),
    ("E11", "DT", "V2", True, 200, "bloques", {"impurity": ["entropy"], "depth": [5, 8], "leaf": [50, 200], "alpha": [0.0, 0.00001, 0.0001]}),
    ("E12", "DT", "V2", True, 200, "bloques", {"impurity": ["gini"], "depth": [4, 7], "split": [100, 500, 2000], "leaf": [50, 200]}),
    ("E13", "HGB", "V2", True, 200, "bloques", _HGB_GRID),
    ("E14", "HGB", "V2", False, 200, "bloques", _HGB_GRID),
    ("E15", "RF", "V2", False, 200, "bloques", _RF_GRID),
    ("E16", "RF", "V2", True, 200, "bloques", _RF_GRID),
    ("E5T", "LR", "V2", False, 200, "temporal", _LR_GRID),
    ("E15T", "RF", "V2", False, 200, "temporal", _RF_GRID),
]
RAISES, LOWERS = "raises risk", "lowers risk"


def side_by_side(spark, task: Callable, items: Iterable, parallel: int) -> list:
    """Results of independent Spark jobs submitted from several driver threads, in order."""
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(task), items))


def settings(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def classifier(model: str, setting: Mapping, weight_total: float, seed: int = 42):
    """The estimator for a model code and one grid setting: Spark ML's, or the leaf-wise boosting for HGB."""
    shared = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}
    if model == "LR":
        # The penalty of this estimator is averaged over the weights, hence 1 / (C * total).
        strength = 1.0 / (setting.get("c", 1.0) * weight_total)
        return LogisticRegression(**shared, regParam=strength, elasticNetParam=0.0, standardization=False, maxIter=setting.get("max_iter", 1000), tol=1e-5)
    if model == "HGB":
        return LeafwiseBoosting(setting.get("rounds", 200), setting.get("rate", 0.1), setting.get("leaves", 31), setting.get("leaf", 20))
    tree = {"maxDepth": setting.get("depth", 5), "minInstancesPerNode": setting.get("leaf", 50), "seed": seed, "maxBins": 64}
    if model == "DT":
        plain = DecisionTreeClassifier(**shared, **tree, impurity=setting.get("impurity", "gini"))
        return PruningTree(plain, setting.get("alpha", 0.0), setting.get("split", 2)) if {"alpha", "split"} & {*setting} else plain
    if model == "RF":
        return RandomForestClassifier(**shared, **tree, numTrees=setting.get("trees", 300), featureSubsetStrategy="sqrt")
    if model == "GBT":
        return GBTClassifier(**shared, **tree, maxIter=setting.get("rounds", 200), stepSize=setting.get("rate", 0.1))
    raise ValueError(f"unknown model {model!r}")


@dataclass
class Prepared:
    """What a round learnt before any grid setting: preparation, rates, feature stages."""

    prep: Preparation
    rates: dict[str, DataFrame]
    prevalence: float
    stages: PipelineModel

    def features(self, rows: DataFrame) -> DataFrame:
        return self.stages.transform(_prepared(rows, self.prep, self.rates, self.prevalence))


@dataclass
class FittedModel:
    """A classifier with the preparation it was fitted behind."""

    before: Prepared
    model: object

    @property
    def prep(self) -> Preparation:
        return self.before.prep

    @property
    def rates(self) -> dict[str, DataFrame]:
        return self.before.rates

    def score(self, rows: DataFrame) -> DataFrame:
        """Rows with `score`, the probability of the positive class."""
        return self.score_features(self.before.features(rows)).select(*rows.columns, "score")

    def score_features(self, features: DataFrame) -> DataFrame:
        return self.model.transform(features).withColumn("score", vector_to_array("probability")[1])


def _encodings(columns: Sequence[str]) -> list[tuple[str, Column]]:
    have = set(columns)
    if "fold" not in have:
        return []
    return [(f"enc_{name}", key) for name, needed, key in standard_encodings() if set(needed) <= have]


def _prepared(rows: DataFrame, prep: Preparation, rates: Mapping[str, DataFrame], prevalence: float) -> DataFrame:
    """Add the imputed, pooled and encoded columns."""
    for name, key in _encodings(rows.columns):
        if name in rates:
            rows = apply_rates(rows, rates[name], key, name, F.lit(prevalence), ENCODING_WEIGHT)
    return rows.withColumns({**prep.numeric_columns(), **prep.category_columns()})


def _stages(prep: Preparation, encoded: Sequence[str]) -> list:
    """One-hot the pooled categories, scale the numbers for the linear model, assemble."""
    stages, hot = [], []
    for c in prep.categorical:
        labels = [*prep.categories[c], INFREQUENT]
        stages.append(StringIndexerModel.from_labels(labels, inputCol=f"cat_{c}", outputCol=f"idx_{c}", handleInvalid="keep"))
        hot.append(f"hot_{c}")
    if hot:
        stages.append(OneHotEncoder(inputCols=[f"idx_{c}" for c in prep.categorical], outputCols=hot, dropLast=True, handleInvalid="keep"))
    numbers = [*prep.numeric_columns(), *encoded]
    stages.append(VectorAssembler(inputCols=numbers, outputCol="numbers"))
    block = "numbers"
    if prep.linear:
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True))
        block = "scaled"
    stages.append(VectorAssembler(inputCols=[block, *hot], outputCol="features"))
    return stages


@dataclass
class Learner:
    """How to fit: model code, variant, class weights and negatives per positive."""

    model: str
    variant: str = "V2"
    weighted: bool = True
    per_positive: int = 0
    seed: int = 42

    def prepare(self, train: DataFrame) -> tuple[Prepared, DataFrame, float]:
        """(preparation, stored feature rows, their total weight), for any grid setting.

        With sampled negatives the encoding counts each kept negative for those it
        stands for, so its rates are those of the population. Without at least two
        folds there is no encoding, because rates would see a row's own label.
        """
        fit_rows = sample_negatives(train, self.per_positive, self.seed)
        if self.per_positive > 0:
            fit_rows = fit_rows.withColumn("_stands_for", negative_weight(train, self.per_positive))
        else:
            fit_rows = fit_rows.withColumn("_stands_for", F.lit(1.0))
        fit_rows = stage_table(fit_rows, "fit")
        prep = fit_preparation(fit_rows, self.variant, self.model == "LR")
        mass = F.col("_stands_for")
        keyed = _encodings(fit_rows.columns)
        folds = (F.count_distinct("fold"), F.max("fold") + 1) if keyed else (F.lit(0), F.lit(0))
        seen = fit_rows.agg((F.sum(mass * F.col("label")) / F.sum(mass)).alias("p"), folds[0].alias("folds"), folds[1].alias("upto")).first()
        prevalence = seen["p"] or 0.0
        rates = {
            name: stage_table(category_rates(fit_rows, key, seen["upto"], mass), "rates")
            for name, key in keyed
            if seen["folds"] >= 2
        }
        balanced = class_weight(fit_rows) if self.weighted else F.lit(1.0)
        ready = _prepared(fit_rows, prep, rates, prevalence).withColumn("weight", balanced)
        stages = Pipeline(stages=_stages(prep, list(rates))).fit(ready)
        features = stage_table(stages.transform(ready).select("id", "label", "weight", "features"), "features")
        total = features.agg(F.sum("weight").alias("w")).first()["w"]
        return Prepared(prep, rates, prevalence, stages), features, total

    def fit_all(self, train: DataFrame, grid: Sequence[Mapping], parallel: int = 4) -> list[FittedModel]:
        """One fitted model per grid setting, over the same prepared rows."""
        before, features, total = self.prepare(train)

        def fit(setting: Mapping) -> FittedModel:
            return FittedModel(before, classifier(self.model, setting, total, self.seed).fit(features))

        return side_by_side(features.sparkSession, fit, grid, parallel)


def _validate_round(train: DataFrame, learner: Learner, grid: Sequence[Mapping], number: int, fit: Column, valid: Column) -> DataFrame:
    """Validation scores of every setting in one round, stored."""
    fitted = learner.fit_all(train.filter(fit), grid)
    rows = fitted[0].before.features(train.filter(valid)).select("id", "label", "features")
    if len(fitted) > 1:
        rows = stage_table(rows, "validation-features")
    parts = [
        f.score_features(rows).select(F.lit(i).alias("setting"), F.lit(number).alias("round"), "id", "score", "label")
        for i, f in enumerate(fitted)
    ]
    return stage_table(reduce(DataFrame.unionByName, parts), "validation")


def cross_validate(
    dataset: DataFrame,
    learner: Learner,
    grid: Sequence[Mapping],
    scheme: str = "bloques",
    folds: Sequence[int] | None = None,
    parallel: int = 5,
) -> DataFrame:
    """Average precision and tie-neutral recall at 1 % per setting and round.

    Each round is prepared and encoded on its own train part; validation folds stay
    complete. Rounds are independent Spark jobs and are submitted side by side. All
    validation scores are then measured in one ranking pass. The folds are those of the
    train rows unless given.
    """
    train = dataset.filter(F.col("split") == "train")
    if folds is None:  # one row per fold
        folds = sorted(r["fold"] for r in train.filter("fold >= 0").select("fold").distinct().collect())
    rounds = list(forward_rounds(folds) if scheme == "temporal" else block_rounds(folds))

    def run(item) -> DataFrame:
        return _validate_round(train, learner, grid, *item)

    scored = reduce(DataFrame.unionByName, side_by_side(dataset.sparkSession, run, rounds, parallel))
    areas = rank_areas(scored, ["setting", "round"])
    return areas.select("setting", "round", "n", "n_positives", "pr_auc", F.col("expected_recall_1pct").alias("recall_1pct"))


def grid_summary(per_round: DataFrame) -> DataFrame:
    """Mean and population spread over the rounds, per setting."""
    return per_round.groupBy("setting").agg(
        F.avg("pr_auc").alias("pr_auc"), F.stddev_pop("pr_auc").alias("pr_auc_std"),
        F.avg("recall_1pct").alias("recall_1pct"), F.stddev_pop("recall_1pct").alias("recall_1pct_std"),
    )


def score_population(dataset: DataFrame, fitted: FittedModel, run_id: str) -> DataFrame:
    """Prediction table: id, score, label, split, region, contract mark, run and global rank."""
    contracts = F.coalesce("has_contracts", F.lit(0)).cast("int") if "has_contracts" in dataset.columns else F.lit(None).cast("int")
    region = F.col("region") if "region" in dataset.columns else F.lit(None).cast("string")
    scored = fitted.score(dataset).select(
        "id", "score", "label", "split", region.alias("region"), contracts.alias("has_contracts"), F.lit(run_id).alias("run_id")
    )
    return rank_population(scored)


def _text_map(values: Mapping) -> Column:
    """A map column of texts; an empty one keeps its type."""
    pairs = [F.lit(str(x)) for k, v in sorted(values.items()) for x in (k, ", ".join(v) if isinstance(v, list) else v)]
    return F.create_map(*pairs).cast("map<string,string>")


def run_record(predictions: DataFrame, experiment: Mapping, per_round: DataFrame, setting: int, seconds: float) -> DataFrame:
    """The nested run record of a trained experiment, in the file format.

    `experiment` holds the version, variant, model and weighting, the winning setting, the grid
    it was chosen from, the seed and the number of assembled features.
    """
    chosen = per_round.filter(F.col("setting") == setting).orderBy("round")
    folds = [r["pr_auc"] for r in chosen.collect()]
    means = grid_summary(per_round).filter(F.col("setting") == setting)
    train_area = rank_areas(predictions.filter(F.col("split") == "train"), ["run_id"]).select(F.round("pr_auc", 4).alias("a")).scalar()
    pick = lambda c: means.select(F.round(c, 4).alias("v")).scalar()
    hit = F.col("label") == 1
    train, test = F.col("split") == "train", F.col("split") == "test"
    tried = {k: sorted({str(s.get(k)) for s in experiment["grid"]}) for s in experiment["grid"] for k in s}
    return predictions.groupBy("run_id").agg(
        F.count_if(train).alias("n_train"), F.count_if(test).alias("n_test"),
        F.count_if(train & hit).alias("n_positivos_train"), F.count_if(test & hit).alias("n_positivos_test"),
    ).select(
        "run_id",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("fecha"),
        F.lit(experiment["dataset_version"]).alias("dataset_version"),
        F.lit(experiment["variant"]).alias("variant"),
        F.lit(experiment["model"]).alias("model_name"),
        F.lit(experiment["weighted"]).alias("usa_pesos"),
        "n_train", "n_test", "n_positivos_train", "n_positivos_test",
        _text_map(experiment["setting"]).alias("hiperparametros_ganadores"),
        _text_map(tried).alias("grilla_probada"),
        F.lit(experiment["seed"]).cast("long").alias("semilla"),
        F.lit(experiment["features"]).cast("long").alias("n_features_transformadas"),
        F.round(F.lit(float(seconds)), 2).alias("segundos_entrenamiento"),
        F.struct(
            pick("pr_auc").alias("cv_pr_auc_mean"), pick("pr_auc_std").alias("cv_pr_auc_std"),
            F.array(*[F.lit(round(x, 4)) for x in folds]).alias("cv_pr_auc_folds"),
            train_area.alias("train_pr_auc"),
            pick("recall_1pct").alias("cv_recall_1pct_mean"), pick("recall_1pct_std").alias("cv_recall_1pct_std"),
        ).alias("metricas_cv"),
    )


def run_experiment(dataset: DataFrame, code: str, version: str, tag: str = "", grid: Sequence[Mapping] | None = None, parallel: int = 5) -> tuple[FittedModel, DataFrame, DataFrame]:
    """(model, predictions, run record) of one experiment of the matrix.

    The grid is validated by the experiment's scheme, the best setting is refitted on
    the whole train part (with the same sampling), and everyone is scored and ranked.
    """
    known = {row[0]: row for row in EXPERIMENTS}
    if code not in known:
        raise ValueError(f"unknown experiment {code!r}; known: {sorted(known)}")
    _, model, variant, weighted, per_positive, scheme, matrix = known[code]
    grid = settings(matrix) if grid is None else list(grid)
    learner = Learner(model, variant, weighted, per_positive)
    started = time.monotonic()
    per_round = stage_table(cross_validate(dataset, learner, grid, scheme, parallel=parallel), "rounds")
    best = best_parameters(grid_summary(per_round)).first()["setting"]
    fitted = learner.fit_all(dataset.filter(F.col("split") == "train"), [grid[best]])[0]
    weights = "w1" if weighted else "w0"
    run_id = "-".join([RUN_PREFIX, code, model.lower(), variant.lower(), weights, *([tag] if tag else [])])
    predictions = stage_table(score_population(dataset, fitted, run_id), "predictions")
    about = {
        "dataset_version": version, "variant": variant, "model": model, "weighted": weighted,
        "setting": grid[best], "grid": grid, "seed": learner.seed, "features": len(feature_names(fitted)),
    }
    return fitted, predictions, run_record(predictions, about, per_round, best, time.monotonic() - started)


def feature_names(fitted: FittedModel) -> list[str]:
    """Names of the assembled features, in vector order."""
    prep = fitted.prep
    names = [*prep.numeric_columns(), *fitted.rates]
    for c in prep.categorical:
        names += [f"{c}={v}" for v in [*prep.categories[c], INFREQUENT]]
    return names


def _named(fitted: FittedModel, values: Sequence[float]) -> list[tuple[str, float]]:
    names = feature_names(fitted)
    return [(names[i] if i < len(names) else f"feature_{i}", float(v)) for i, v in enumerate(values)]


def coefficients(spark, fitted: FittedModel) -> DataFrame:
    """Coefficients of the linear model with their direction, largest magnitude first."""
    rows = _named(fitted, fitted.model.coefficients.toArray())
    table = spark.createDataFrame(rows, "feature string, coefficient double")
    return table.withColumns(
        {"effect": F.when(F.col("coefficient") > 0, RAISES).otherwise(LOWERS), "magnitude": F.abs("coefficient")}
    ).orderBy(F.col("magnitude").desc(), "feature")


def importances(spark, fitted: FittedModel) -> DataFrame:
    """Impurity importance of the tree models, largest first."""
    rows = _named(fitted, fitted.model.featureImportances.toArray())
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def tree_rules(fitted: FittedModel) -> str:
    """The rules of a tree with feature names in place of positions."""
    text = fitted.model.toDebugString
    for i, name in reversed(list(enumerate(feature_names(fitted)))):
        text = text.replace(f"feature {i} ", f"{name} ")
    return text


def permuted(rows: DataFrame, columns: Sequence[str], repeats: int = 3, seed: int = 42) -> DataFrame:
    """`rows` once per column and repeat, with that column taken from another row: adds `feature` and `repeat`.

    Rows are put in a random order once, and a repeat takes the values of the row a drawn number of places ahead, the
    start following the end. So every repeat is a permutation in which no row keeps its own value, and the only sort
    is that of the rows as given. All columns and repeats are one plan: rows are repeated after the exchange.
    """
    drawn = rows.withColumn("_hash", hash_uniform(F.col("id").cast("string"), seed))
    ranked = stage_table(with_rank(drawn, [F.col("_hash"), F.col("id")], (), "_at").drop("_hash"), "permuted")
    n = ranked.count()
    ahead = [Random(seed + r).randrange(1, n) if n > 1 else 0 for r in range(repeats)]
    steps = F.array(*[F.struct(F.lit(r).alias("repeat"), F.lit(k).cast("long").alias("_ahead")) for r, k in enumerate(ahead)])
    own = ranked.select("*", F.inline(steps)).withColumn("_from", F.pmod(F.col("_at") - 1 + F.col("_ahead"), F.lit(max(n, 1))) + 1)
    given = ranked.select(F.col("_at").alias("_from"), F.struct(*columns).alias("_given"))
    each = own.join(given, "_from").withColumn("feature", F.explode(F.array(*map(F.lit, columns))))
    mixed = {c: F.when(F.col("feature") == c, F.col(f"_given.{c}")).otherwise(F.col(c)) for c in columns}
    return each.withColumns(mixed).select(*rows.columns, "feature", "repeat")


def used_columns(fitted: FittedModel) -> set[str]:
    """The columns that a score depends on: those behind a split of a tree, or behind a coefficient that is not 0.

    A model that shows neither is taken to use all its columns.
    """
    prep, model = fitted.prep, fitted.model
    behind = [[c] for c in prep.numeric] + [[c] for c in prep.with_missing]
    needed = {f"enc_{name}": columns for name, columns, _ in standard_encodings()}
    behind += [needed[name] for name in fitted.rates]
    behind += [[c] for c in prep.categorical for _ in (*prep.categories[c], INFREQUENT)]
    if hasattr(model, "coefficients"):
        used = [i for i, v in enumerate(model.coefficients.toArray()) if v]
    elif hasattr(model, "toDebugString"):
        used = [int(i) for i in re.findall(r"\(feature (\d+) ", model.toDebugString)]
    else:
        used = range(len(behind))
    return {c for i in used for c in (behind[i] if i < len(behind) else sum(behind, []))}


def permutation_importance(fitted: FittedModel, rows: DataFrame, columns: Sequence[str] | None = None, repeats: int = 3, seed: int = 42) -> DataFrame:
    """Mean and spread of the loss of average precision when a column is shuffled; all columns of the model unless given.

    All variants are scored by one plan and measured in a single ranking pass over their merged scores. A column that no
    score depends on loses exactly 0 in every repeat, so only the others are shuffled and scored.
    """
    columns = [*fitted.prep.numeric, *fitted.prep.categorical] if columns is None else list(columns)
    used = used_columns(fitted)
    still = [(c, 0.0, 0.0) for c in columns if c not in used]
    base = stage_table(rows, "intact")
    shown = ["feature", "repeat", "id", "score", "label"]
    intact = fitted.score(base.withColumns({"feature": F.lit(""), "repeat": F.lit(-1)})).select(*shown)
    variants = intact
    if shuffled := [c for c in columns if c in used]:
        variants = intact.unionByName(fitted.score(permuted(base, shuffled, repeats, seed)).select(*shown))
    areas = stage_table(rank_areas(variants, ["feature", "repeat"]).select("feature", "repeat", "pr_auc"), "areas")
    whole = areas.filter(F.col("feature") == "").select("pr_auc").scalar()
    lost = areas.filter(F.col("feature") != "").withColumn("lost", whole - F.col("pr_auc"))
    moved = lost.groupBy("feature").agg(F.avg("lost").alias("importance"), F.stddev_pop("lost").alias("spread"))
    unmoved = rows.sparkSession.createDataFrame(still, "feature string, importance double, spread double")
    return moved.unionByName(unmoved).orderBy(F.col("importance").desc(), "feature")
