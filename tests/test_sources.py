import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.config import staging_path
from lakerisk.operators import quarantine
from lakerisk.sources import readers, writers

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType())])


def csv(folder, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.csv").write_text(text)
    return str(folder)


def test_bad_rows_are_kept_apart(spark, tmp_path):
    path = csv(tmp_path / "anio=2025" / "mes=1", "id,amount\n1,2.5\nx,3.5\n3,\n")
    clean, bad = quarantine.split_by_schema(readers.read_raw_csv(spark, str(tmp_path), SCHEMA))
    assert sorted(r["id"] for r in clean.collect()) == [1, 3] and "anio" in clean.columns
    kept = bad.first()
    assert kept[readers.CORRUPT] == "x,3.5" and kept["amount"] == 3.5
    assert len(SCHEMA) == 2 and path


def test_renamed_header_fails(spark, tmp_path):
    path = csv(tmp_path, "id,monto\n1,2.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_raw_csv(spark, path, SCHEMA).collect()


def test_narrow_and_optional_scans(spark, tmp_path, plan_of):
    path = csv(tmp_path / "n", "a,b,c\n1,x,2\n")
    assert readers.read_narrow_csv(spark, path, ["c", "a"]).first()[:] == ("2", "1")
    typed = readers.read_narrow_csv(spark, path, ["a", "b"], "a bigint, b double")
    assert typed.first()[:] == (1, None) and "ReadSchema: struct<a:string,b:string>" in plan_of(typed)
    assert readers.read_optional(spark, str(tmp_path / "none")) is None
    assert readers.written_rows(spark, str(tmp_path / "none")) == 0


def test_partitioned_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, k string")
    writers.write_partitioned(df, path, ["k"])
    writers.write_partitioned(df.filter("k = 'b'").withColumn("x", F.lit(9)), path, ["k"], only_touched=True)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [1, 9]
    writers.write_partitioned(df.filter("k = 'b'"), path, ["k"])
    assert readers.written_rows(spark, path) == 1


def test_empty_outputs(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, k string")
    whole, some = str(tmp_path / "q"), str(tmp_path / "s")
    writers.write_whole(df, whole)
    writers.write_whole(df.filter("false"), whole)
    assert readers.written_rows(spark, whole) == 0
    assert writers.write_if_any(df.filter("false"), some, ["k"]) is False and readers.read_optional(spark, some) is None
    assert writers.write_if_any(df, some, ["k"]) is True


def test_publish(spark, tmp_path):
    live = str(tmp_path / "silver" / "orders")
    df = spark.range(5)
    with pytest.raises(writers.PublishError, match="nothing staged"):
        writers.publish(spark, live)
    writers.write_whole(df, staging_path(live))
    with pytest.raises(writers.PublishError, match="expected 6"):
        writers.publish(spark, live, expected_rows=6)
    assert readers.read_optional(spark, live) is None
    assert writers.publish(spark, live, expected_rows=5) == 5
    writers.write_whole(spark.range(2), staging_path(live))
    assert writers.publish(spark, live) == 2 and readers.written_rows(spark, live) == 2
    # An optional output that was not staged clears the live table of an earlier run.
    assert writers.publish(spark, live, optional=True) == 0 and readers.read_optional(spark, live) is None


def test_metric_rows(spark, tmp_path):
    df = spark.createDataFrame([("r", float("nan"), float("inf"), 0.5, None)], "run_id string, a double, b double, c double, d string")
    writers.write_metric_rows(df, str(tmp_path / "m"))
    lines = [line for f in (tmp_path / "m").glob("part*") for line in f.read_text().splitlines()]
    assert [json.loads(x) for x in lines] == [{"run_id": "r", "a": None, "b": None, "c": 0.5, "d": None}]


def test_run_records(spark, tmp_path):
    good = {"run_id": "r1", "model_name": "LR", "variant": "V2", "dataset_version": "v2", "metricas_cv": {"cv_pr_auc_mean": 0.1, "cv_pr_auc_folds": [0.1]}}
    lines = [json.dumps(good), json.dumps({**good, "variant": None}), json.dumps({**good, "metricas_cv": {}}), "{broken"]
    (tmp_path / "r.json").write_text("\n".join(lines))
    valid, rejected = readers.read_run_records(spark, str(tmp_path))
    assert [(r["run_id"], r["metricas_cv"]["cv_pr_auc_folds"]) for r in valid.collect()] == [("r1", [0.1])]
    reasons = sorted(r["errors"] for r in rejected.collect())
    assert len(reasons) == 3 and reasons[0] == "missing metricas_cv.cv_pr_auc_mean" and reasons[1] == "missing variant"
    assert reasons[2].startswith("unreadable json")
