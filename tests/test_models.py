import numpy as np
import pytest
from pyspark.sql import functions as F

from lakerisk.operators import models, preparation
from lakerisk.operators.evaluation import rank_areas


@pytest.fixture(scope="module")
def rows(spark):
    """500 rows, every 8th positive, with a planted signal in two columns."""
    i = F.col("id")
    label = (i % 8 == 0).cast("int")
    noise = (F.abs(F.hash(i)) % 100) / 100.0
    return spark.range(500).select(
        F.format_string("2%010d", i).alias("id"),
        label.alias("label"),
        F.when(i % 10 < 7, "train").otherwise("test").alias("split"),
        F.when(i % 10 < 7, (i % 5).cast("int")).otherwise(-1).alias("fold"),
        (label * 500 + noise * 400).alias("total_amount"),
        F.when(i % 9 != 0, noise * 10).alias("workers"),
        F.lit(None).cast("double").alias("aff_age_days"),
        F.concat(F.lit("A"), (i % 40)).alias("activity"),
        F.when(i % 6 != 0, "LIMA").alias("region"),
        (i * 1000).alias("id_sequence"),
        (i % 2).cast("int").alias("has_contracts"),
    ).cache()


def test_empty_columns_are_left_out(rows):
    prep = preparation.fit_preparation(rows, "V2", linear=True)
    assert "aff_age_days" not in prep.numeric and "total_amount" in prep.numeric and "status" not in prep.categorical
    leaky = rows.withColumn("status", F.lit("ACTIVO"))
    assert "status" in preparation.candidate_columns(leaky, "V1")[1] and "status" not in preparation.candidate_columns(leaky, "V2")[1]


def test_medians_and_caps_are_exact(spark):
    """An even number of values: the median of a logged column is the mean of two logarithms; sketches stay near."""
    values = [0.5 * i * i for i in range(1, 401)]
    df = spark.createDataFrame([(v, -v, "a") for v in values], "total_amount double, id_sequence double, region string")
    prep = preparation.fit_preparation(df, "V2", linear=True)
    cap = float(np.quantile(values, 0.995))
    shaped = np.log1p(np.minimum(values, cap))
    assert prep.caps == {"total_amount": pytest.approx(cap)}
    assert prep.medians["total_amount"] == pytest.approx(float(np.median(shaped)), rel=1e-12)
    assert prep.medians["id_sequence"] == pytest.approx(-float(np.median(values)))
    rough = preparation.fit_preparation(df, "V2", linear=True, sketch=True)
    assert rough.medians["total_amount"] == pytest.approx(prep.medians["total_amount"], rel=0.01)
    assert preparation.fit_preparation(df.limit(0), "V2", linear=True).numeric == []


def test_preparation(rows):
    prep = preparation.fit_preparation(rows, "V2", linear=True)
    assert prep.with_missing == ["workers"] and len(prep.categories["activity"]) == 29
    assert prep.categories["region"] == ["LIMA", "DESCONOCIDO"]
    shaped = rows.select(*[e.alias(n) for n, e in {**prep.numeric_columns(), **prep.category_columns()}.items()])
    assert shaped.filter("num_workers IS NULL OR num_total_amount IS NULL").count() == 0
    assert shaped.filter("missing_workers = 1").count() == rows.filter("workers IS NULL").count()
    assert shaped.filter("cat_activity = 'infrequent'").count() > 0


def test_top_coding(spark):
    df = spark.range(1000).select(F.when(F.col("id") == 999, 1e8).when(F.col("id") == 0, None).otherwise(F.col("id") % 100 + 1.0).alias("total_amount"), F.lit(0.0).alias("n_buyers"))
    prep = preparation.fit_preparation(df, "V2", linear=True)
    assert prep.caps["total_amount"] < 1000 and "n_buyers" not in prep.caps
    capped = df.select(preparation.top_coded(F.col("total_amount"), F.lit(prep.caps["total_amount"])).alias("x"))
    assert capped.agg(F.max("x")).first()[0] < 1000 and capped.filter("x IS NULL").count() == 1


def test_negative_sample(rows):
    positives = rows.filter("label = 1").count()
    got = preparation.sample_negatives(rows, 2)
    assert got.filter("label = 1").count() == positives and got.filter("label = 0").count() == 2 * positives
    assert preparation.sample_negatives(rows, 1000).count() == 500 and preparation.sample_negatives(rows, 0).count() == 500
    again = {r["id"] for r in preparation.sample_negatives(rows.repartition(5), 2).collect()}
    assert again == {r["id"] for r in got.collect()}


def test_rounds(rows):
    sizes = {r["round"]: r for r in preparation.round_sizes(rows, preparation.forward_rounds(range(5))).collect()}
    per_fold = {k: rows.filter(F.col("fold") == k).count() for k in range(5)}
    assert sorted(sizes) == [1, 2, 3, 4]
    assert all(sizes[k]["valid_rows"] == per_fold[k] and sizes[k]["train_rows"] == sum(per_fold[j] for j in range(k)) for k in sizes)
    assert [k for k, _, _ in preparation.block_rounds(range(5))] == [0, 1, 2, 3, 4]


def test_class_weights(rows):
    got = rows.withColumn("w", preparation.class_weight(rows)).groupBy("label").agg(F.sum("w").alias("w")).collect()
    assert {round(r["w"], 6) for r in got} == {250.0}


@pytest.mark.parametrize("model, setting", [("LR", {"c": 1.0, "max_iter": 30}), ("DT", {"depth": 3, "leaf": 5}), ("RF", {"trees": 5, "depth": 3, "leaf": 5}), ("GBT", {"rounds": 3, "depth": 2, "leaf": 5})])
def test_models_find_the_signal(spark, rows, model, setting):
    fitted = models.Learner(model, per_positive=3).fit_all(rows.filter("split = 'train'"), [setting])[0]
    scored = models.score_population(rows, fitted, "risk-run-x")
    assert scored.count() == 500 and scored.agg(F.countDistinct("rank_global")).first()[0] == 500
    area = rank_areas(scored.filter("split = 'test'")).first()
    assert area["pr_auc"] > 3 * area["n_positives"] / area["n"]
    if model == "LR":
        table = models.coefficients(spark, fitted).collect()
        assert {r["effect"] for r in table} <= {models.RAISES, models.LOWERS} and any(r["feature"] == "num_total_amount" for r in table)
    elif model == "DT":
        assert models.importances(spark, fitted).first()["importance"] > 0 and "num_total_amount" in models.tree_rules(fitted)


def test_cross_validation_and_record(spark, rows):
    learner = models.Learner("DT", per_positive=3)
    grid = models.settings({"depth": [1, 3], "leaf": [5]})
    per_round = models.cross_validate(rows, learner, grid)
    assert per_round.count() == 10 and models.grid_summary(per_round).count() == 2
    assert per_round.agg(F.sum("n")).first()[0] == 2 * rows.filter("split = 'train'").count()
    fitted = learner.fit_all(rows.filter("split = 'train'"), grid[:1])[0]
    record = models.run_record(
        models.score_population(rows, fitted, "risk-run-E2"),
        {"dataset_version": "v2", "variant": "V2", "model": "DT", "weighted": True, "setting": grid[0], "grid": grid, "seed": 42, "features": 7}, per_round, 0, 1.234,
    ).first()
    assert record["grilla_probada"] == {"depth": "1, 3", "leaf": "5"} and record["hiperparametros_ganadores"] == {"depth": "1", "leaf": "5"}
    assert (record["semilla"], record["n_features_transformadas"]) == (42, 7)
    assert record["n_train"] == 350 and len(record["metricas_cv"]["cv_pr_auc_folds"]) == 5
    assert record["segundos_entrenamiento"] == 1.23


def test_permutation_importance(rows):
    fitted = models.Learner("DT").fit_all(rows.filter("split = 'train'"), [{"depth": 3, "leaf": 5}])[0]
    got = {r["feature"]: r["importance"] for r in models.permutation_importance(fitted, rows, ["total_amount", "workers"], repeats=1).collect()}
    assert got["total_amount"] > 0.2 > abs(got["workers"])


def test_permuted_rows(spark, rows):
    """Each variant holds the values of its column once more, no row its own, and nothing else changes."""
    base = rows.select("id", "label", "total_amount", F.col("id").alias("copy"), "region")
    made = models.permuted(base, ["copy", "region"], repeats=2).collect()
    assert len(made) == 2 * 2 * 500 and {(r["feature"], r["repeat"]) for r in made} == {(c, k) for c in ("copy", "region") for k in (0, 1)}
    before = {r["id"]: r for r in base.collect()}
    drawn = []
    for k in (0, 1):
        mine = {r["id"]: r["copy"] for r in made if r["feature"] == "copy" and r["repeat"] == k}
        assert sorted(mine.values()) == sorted(before) and all(i != v for i, v in mine.items())
        drawn.append(mine)
    assert drawn[0] != drawn[1]
    assert all(r["total_amount"] == before[r["id"]]["total_amount"] and (r["feature"] == "region" or r["region"] == before[r["id"]]["region"]) for r in made)
    assert models.permuted(base.limit(1), ["copy"]).count() == 3 and models.permuted(base.limit(0), ["copy"]).count() == 0


def test_permutation_of_all_columns(rows):
    fitted = models.Learner("DT").fit_all(rows.filter(F.col("split") == "train"), [{"depth": 3, "leaf": 5}])[0]
    got = {r["feature"]: r for r in models.permutation_importance(fitted, rows).collect()}
    assert set(got) == {*fitted.prep.numeric, *fitted.prep.categorical}
    assert max(got, key=lambda c: got[c]["importance"]) == "total_amount" and got["total_amount"]["spread"] < 0.2


def test_permutation_scores_only_columns_in_use(rows, monkeypatch):
    """A column without a split is not shuffled and loses 0; what a split of an encoding stands on counts as in use."""
    fitted = models.Learner("DT").fit_all(rows.filter(F.col("split") == "train"), [{"depth": 1, "leaf": 5}])[0]
    asked, plain = [], models.permuted
    monkeypatch.setattr(models, "permuted", lambda base, columns, *rest: asked.append(list(columns)) or plain(base, columns, *rest))
    got = {r["feature"]: (r["importance"], r["spread"]) for r in models.permutation_importance(fitted, rows).collect()}
    assert asked == [["total_amount"]] and models.used_columns(fitted) == {"total_amount"}
    assert set(got) == {*fitted.prep.numeric, *fitted.prep.categorical} and got["total_amount"][0] > 0.2
    assert {v for c, v in got.items() if c != "total_amount"} == {(0.0, 0.0)}
