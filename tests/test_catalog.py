"""Registered queries against their SQL twins, and the shape of their plans."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from lakerisk.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()
# One query per area by default; ORACLE_ALL=1 compares every one.
SAMPLE = [
    "contract_profile", "registry_history", "feature_table", "regional_summary", "ingest_split", "keep_latest", "quality_report",
    "curated_dataset", "weighted_encoding", "prevalence_by_split", "rank_in_split", "ranking_metrics", "segment_metrics", "gain_lift",
    "score_density", "view_audit_ranking", "view_leaderboard", "champion", "eda_amounts_by_class", "prep_winsor_log", "negative_sample",
    "publish_roundtrip", "ingest_incremental", "cleaned_months",
]
CHOSEN = sorted(ORACLE) if os.environ.get("ORACLE_ALL") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return db


def test_registry_is_consistent():
    assert set(ORACLE) <= set(QUERIES)
    own = catalog.queries()
    assert set(own) <= set(QUERIES)
    assert {n for n in own if n not in ORACLE} == {
        "bootstrap_interval", "flat_metrics", "model_lr", "model_dt", "model_rf", "model_gbt", "model_hgb", "model_cross_validation",
        "model_forward_validation", "model_coefficients", "model_permutation",
    }


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    columns = sorted(ours.columns)
    theirs = duck.execute(ORACLE[name])
    names = [c[0] for c in theirs.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    want = sorted(repr(tuple(row[i] for i in place)) for row in theirs.fetchall())
    got = sorted(repr(tuple(row)) for row in ours.select(*columns).collect())
    assert got == want


@pytest.mark.parametrize("name", ["contract_profile", "feature_table", "regional_summary", "view_quadrants", "keep_latest", "segment_metrics"])
def test_plans_have_no_nested_loops_or_python(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for word in ("CartesianProduct", "NestedLoop", "Python"):
        assert word not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_a_task_of_the_feed_join_takes_a_bounded_number_of_rows(spark, duck, monkeypatch):
    from pyspark.sql import functions as F

    from lakerisk.plans import bindings

    rows = duck.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    monkeypatch.setattr(bindings, "TASK_ROWS", rows // 12, raising=False)
    monkeypatch.setattr(bindings, "SPREAD_FROM", rows // 2, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in bindings.bind_spread(spark, FOLDER, "feed").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == rows and max(sizes) < rows / 6
        assert [tuple(r) for r in QUERIES["layer_losses"](spark, FOLDER).collect()] == duck.execute(ORACLE["layer_losses"]).fetchall()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def large_entities(tmp_path_factory):
    """30 copies of the orders, most of them of three of five customers: about 60 000 facts each, of unlike amounts.
    The other two are in the label register."""
    folder, db = tmp_path_factory.mktemp("large"), duckdb.connect()
    copied = {t: f"SELECT * FROM '{FOLDER}/{t}.parquet'" for t in TABLES}
    copied["customer"] = f"SELECT * REPLACE (CASE WHEN c_custkey > 3 THEN 8500 ELSE 5000 END::DOUBLE AS c_acctbal) FROM ({copied['customer']}) WHERE c_custkey <= 5"
    copied["orders"] = f"""SELECT * REPLACE (o_orderkey + k * 1000000 AS o_orderkey, CASE WHEN o_orderkey % 97 < 2 THEN 4 + o_orderkey % 97 ELSE 1 + o_orderkey % 3 END AS o_custkey)
        FROM ({copied['orders']}), range(30) t(k)"""
    copied["lineitem"] = f"""SELECT * REPLACE (l_orderkey + k * 1000000 AS l_orderkey, round(l_extendedprice + k * 0.37, 2) AS l_extendedprice)
        FROM ({copied['lineitem']}), range(30) t(k)"""
    for t, rows in copied.items():
        db.execute(f"COPY (SELECT * {'EXCLUDE (k)' if t in ('orders', 'lineitem') else ''} FROM ({rows})) TO '{folder}/{t}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", ["contract_profile", "feature_table", "feature_table_multi_cutoff", "preparation_fitted"])
def test_query_equals_sql_where_entities_are_large(spark, large_entities, monkeypatch, name):
    from functools import partial

    from lakerisk.operators import features

    monkeypatch.setattr(features, "contract_profiles", partial(features.contract_profiles, most=1000))
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{large_entities}/{t}.parquet'")
    ours, theirs = QUERIES[name](spark, large_entities), db.execute(ORACLE[name])
    columns = [c[0] for c in theirs.description]
    assert sorted(map(repr, map(tuple, ours.select(*columns).collect()))) == sorted(map(repr, theirs.fetchall()))


def test_models_learn_from_exact_medians_of_large_entities(spark, large_entities, monkeypatch):
    """The rows that model_forward_validation and the other model queries learn from; these have no SQL themselves."""
    from functools import partial

    from lakerisk.operators import features

    monkeypatch.setattr(features, "contract_profiles", partial(features.contract_profiles, most=1000))
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{large_entities}/{t}.parquet'")
    want = dict(db.execute(f"SELECT entity_id, median_amount FROM ({ORACLE['feature_table']}) WHERE n_orders > 1000").fetchall())
    got = catalog._model_rows(spark, large_entities).filter("n_orders > 1000").select("entity_id", "median_amount").collect()
    assert len(got) > 1 and all(r["median_amount"] == want[r["entity_id"]] for r in got)
