import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakerisk.operators import curation, encoding, quality

BASE = "entity_id bigint, activity string, region string, workers double, n_orders int, status string, condition string, id_sequence bigint, excluded boolean"


def features(spark, n=300):
    rows = [
        (20000000000 + i, f"A{i % 7}", ("LIMA", "CUSCO", None)[i % 3], float(i % 5), i % 4, "ACTIVO", "HABIDO", i * 1000, False)
        for i in range(1, n + 1)
    ]
    return spark.createDataFrame(rows, BASE)


def register(spark, n=30, reps=None):
    reps = reps or {}
    rows = [(20000000000 + i, dt.date(2025, 1, 1) + dt.timedelta(days=i), dt.date(2025, 2, 1) + dt.timedelta(days=i),
             dt.date(2026, 1, 31), reps.get(i)) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, "entity_id bigint, issue_date date, firm_date date, publication_date date, representative string")


def excluded(spark):
    return spark.createDataFrame([(20000000000 + i,) for i in range(281, 301)], "entity_id bigint")


def curated(spark, **kwargs):
    return curation.curate(features(spark), register(spark, reps=kwargs.pop("reps", None)), excluded(spark), **kwargs)


def number(row_id):
    return int(row_id) - 20000000000


def test_curated_table(spark):
    got = curated(spark).collect()
    assert len(got) == len({r["id"] for r in got}) == 280
    assert not {number(r["id"]) for r in got} & set(range(281, 301))
    assert sum(r["label"] for r in got) == 30
    test = [r for r in got if r["split"] == "test"]
    assert {r["fold"] for r in test} == {-1} and {r["fold"] for r in got if r["split"] == "train"} == {0, 1, 2, 3, 4}
    # The newest 30 % of the positives are test: 9 of 30.
    assert sorted(number(r["id"]) for r in test if r["label"]) == list(range(22, 31))
    assert all(r["te_activity"] is not None for r in got)
    again = {(r["id"], r["split"], r["fold"]) for r in curated(spark).collect()}
    assert again == {(r["id"], r["split"], r["fold"]) for r in got}


def test_block_folds_ascend_with_issue_date(spark):
    got = [r for r in curated(spark, keep_dates=True).collect() if r["label"] and r["split"] == "train"]
    ordered = [r["fold"] for r in sorted(got, key=lambda r: r["issue_date"])]
    assert ordered == sorted(ordered)
    sizes = [ordered.count(k) for k in range(5)]
    assert max(sizes) - min(sizes) <= 1


def test_group_moves_together(spark):
    got = {number(r["id"]): r for r in curated(spark, reps={1: "R", 30: "R"}).collect()}
    assert got[1]["split"] == got[30]["split"] == "test"
    got = {number(r["id"]): r for r in curated(spark, reps={1: "R", 15: "R"}).collect()}
    assert got[1]["fold"] == got[15]["fold"] == 0


def test_cutoff_drops_early_positives(spark):
    kept = curated(spark, cutoff="2025-01-06", keep_dates=True)
    assert kept.filter("label = 1").count() == 25
    assert sorted(number(r["id"]) for r in kept.filter("label = 1 AND split = 'test'").collect()) == list(range(24, 31))


def test_label_end(spark):
    rows = [(1, "2026-05-10"), (2, "2026-09-30"), (3, "2026-10-01")]
    reg = spark.createDataFrame(rows, "entity_id bigint, d string").select(
        "entity_id", F.to_date("d").alias("issue_date"), F.lit("2026-10-31").cast("date").alias("publication_date"))
    end = curation.label_end(reg)
    assert end == dt.date(2026, 9, 30)
    labelled = curation.attach_label(reg.select(F.format_string("%011d", "entity_id").alias("id")), reg)
    assert curation.within_label_window(labelled, "2026-03-31", end).count() == 2
    with pytest.raises(ValueError, match="publication_date"):
        curation.label_end(reg.drop("publication_date"))


def test_population_filter(spark):
    rows = [(1, "SOCIEDAD ANONIMA", "ACTIVO", 1), (2, "OTRO", "ACTIVO", 1), (3, "SOCIEDAD ANONIMA", "BAJA", 1), (4, "SOCIEDAD ANONIMA", "ACTIVO", 0), (5, None, "ACTIVO", 1)]
    df = spark.createDataFrame(rows, "entity_id bigint, entity_type string, status string, affiliated int")
    assert [r["entity_id"] for r in curation.eligible_population(df).collect()] == [1]
    with pytest.raises(ValueError, match="affiliated"):
        curation.eligible_population(df.drop("affiliated"))


def test_register_repeat_keeps_the_oldest(spark):
    reg = register(spark, 1).unionAll(register(spark, 1).withColumn("issue_date", F.lit("2020-01-01").cast("date")))
    labelled = curation.attach_label(features(spark, 1).withColumn("id", F.lit("20000000001")), reg)
    assert [str(r["issue_date"]) for r in labelled.collect()] == ["2020-01-01"]


ENC = "id string, split string, fold int, label int, cat string"


def test_out_of_fold_encoding(spark):
    rows = [("1", "train", 0, 1, "a"), ("2", "train", 0, 1, "a"), ("3", "train", 1, 0, "a"), ("4", "train", 1, 0, "a"), ("5", "test", -1, 0, "a"), ("6", "test", -1, 0, "new"), ("7", "test", -1, 0, None)]
    df = spark.createDataFrame(rows, ENC)
    got = {r["id"]: r["te"] for r in encoding.encode_out_of_fold(df, F.col("cat"), "te", m=0.000001).collect()}
    assert [round(got[str(i)], 3) for i in range(1, 6)] == [0.0, 0.0, 1.0, 1.0, 0.5]
    smooth = {r["id"]: r["te"] for r in encoding.encode_out_of_fold(df, F.col("cat"), "te").collect()}
    assert smooth["6"] == smooth["7"] == 0.5


def test_weighted_encoding(spark):
    rows = [("1", "train", 0, 1, "a"), ("2", "train", 1, 0, "a"), ("3", "test", -1, 0, "a")]
    weight = F.when(F.col("label") == 1, 1.0).otherwise(3.0)
    got = encoding.encode_out_of_fold(spark.createDataFrame(rows, ENC), F.col("cat"), "te", m=4, weight=weight)
    assert {r["id"]: r["te"] for r in got.collect()}["3"] == (1 + 4 * 0.25) / (4 + 4)


def test_negative_weight(spark):
    rows = [(str(i), "train", 0, int(i == 0), "a") for i in range(21)]
    df = spark.createDataFrame(rows, ENC)
    got = df.withColumn("w", encoding.negative_weight(df, 5))
    assert {(r["label"], r["w"]) for r in got.collect()} == {(1, 1.0), (0, 4.0)}


def test_feature_audit(spark):
    rows = [("1", "train", 1, 0.5, None, 1.0, None), ("2", "train", 0, 0.2, None, 1.0, 3.0), ("3", "test", 0, 0.1, None, 1.0, 4.0)]
    df = spark.createDataFrame(rows, "id string, split string, label int, ok double, empty double, same double, nohit double")
    got = {r["feature"]: r["verdict"] for r in quality.feature_audit(df, ["ok", "empty", "same", "nohit"]).collect()}
    assert got == {"ok": "ok", "empty": "empty", "same": "constant", "nohit": "null in train positives"}
    assert {r["feature"]: r["verdict"] for r in quality.feature_faults(df, ["ok", "empty", "same", "nohit"]).collect()} == got
    assert [r[:] for r in quality.feature_audit(df, ["nohit"]).collect()] == [("nohit", 2, 0, 2, "null in train positives")]
    for audit in (quality.feature_audit, quality.feature_faults):
        assert {r["verdict"] for r in audit(df.limit(0), ["ok", "same"]).collect()} == {"empty"}
    with pytest.raises(quality.QualityError, match="same constant"):
        quality.gate_features_filled(df, ["ok", "same"])
    with pytest.raises(quality.QualityError, match="absent"):
        quality.feature_audit(df, ["absent"])


def test_dataset_gate(spark):
    good = spark.createDataFrame([("1", 1), ("2", 0)], "id string, label int")
    quality.gate_dataset(good)
    for bad, reason in ((good.filter("false"), "empty"), (good.filter("label = 0"), "no positives"), (good.unionAll(good), "repeats")):
        with pytest.raises(quality.QualityError, match=reason):
            quality.gate_dataset(bad)


def test_coverage_and_scoring(spark):
    feats = spark.createDataFrame([(1,), (1,), (2,)], "entity_id bigint")
    reg = spark.createDataFrame([(1, True), (9, True)], "entity_id bigint, positive boolean")
    assert curation.label_coverage(feats, reg).first()[:] == (2, 1)
    assert sorted(r["positive"] for r in curation.scoring_dataset(feats, reg).collect()) == [False, True, True]


def test_a_sixth_fold_is_left_out_too(spark):
    """Each fold holds one row of the category; the last one's label must not reach its own encoding."""
    rows = [(str(i), "train", i, int(i == 5), "a") for i in range(6)] + [("t", "test", -1, 0, "a")]
    df = spark.createDataFrame(rows, ENC)
    got = {r["id"]: r["te"] for r in encoding.encode_out_of_fold(df, F.col("cat"), "te", m=4).collect()}
    assert got["5"] == pytest.approx((0 + 4 / 6) / (5 + 4)) and got["0"] == pytest.approx((1 + 4 / 6) / (5 + 4))
    assert got["t"] == pytest.approx((1 + 4 / 6) / (6 + 4))
