import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakerisk.operators import features, quality, regional

ORDERS = "contractor_id string, amount double, order_status string, buyer_id bigint, buyer_name string, issue_date string, currency string"
ID = "20123456789"


def orders(spark, *rows):
    full = [(ID, a, s, b, None, d, c) for a, s, b, d, c in rows]
    return spark.createDataFrame(full, ORDERS).withColumn("issue_date", F.to_date("issue_date"))


def profile(spark, *rows, cutoff=None):
    return features.contract_profile(orders(spark, *rows), cutoff).first()


def test_annulled_orders_count_but_add_nothing(spark):
    got = profile(spark, (1000.0, "Vigente", 1, "2025-01-01", None), (2000.0, None, 1, "2025-01-02", None), (5000.0, "ANULADA", 2, "2025-01-03", None))
    assert (got["total_amount"], got["n_orders"], got["max_amount"], got["n_buyers"]) == (3000.0, 3, 2000.0, 2)
    assert got["annulled_share"] == pytest.approx(1 / 3) and got["top_buyer_share"] == 1.0
    assert got["first_order_date"] == dt.date(2025, 1, 1)


def test_median_ignores_annulled(spark):
    rows = [(x, None, 1, "2025-01-01", None) for x in (2000.0, 4000.0, 6000.0)] + [(10000.0, "anulada", 1, "2025-01-01", None)]
    got = profile(spark, *rows)
    assert (got["median_amount"], got["total_amount"]) == (4000.0, 12000.0)


def test_currency_and_cutoff(spark):
    rows = [(10.0, None, 1, "2025-01-01", "Nuevos Soles"), (99.0, None, 1, "2025-01-01", "USD"), (5.0, None, 1, "2025-09-01", None)]
    assert profile(spark, *rows)["total_amount"] == 15.0 and profile(spark, *rows)["n_orders"] == 3
    assert profile(spark, *rows, cutoff="2025-06-30")["total_amount"] == 10.0


def test_buyer_share(spark):
    rows = [(30.0, None, 1, "2025-01-01", None), (10.0, None, 2, "2025-01-01", None)]
    assert profile(spark, *rows)["top_buyer_share"] == 0.75
    assert profile(spark, (9.0, "anulada", 1, "2025-01-01", None))["top_buyer_share"] == 0.0


def registry(spark, rows):
    return spark.createDataFrame(rows, "entity_id bigint, workers_text string, status string, condition string, entity_type string, region string, year int, month int")


def test_worker_text(spark):
    rows = [(i, w, "ACTIVO", "HABIDO", None, None, 2025, 6) for i, w in ((1, "NO DISPONIBLE"), (2, "0"), (3, "5"))]
    got = {r["entity_id"]: r for r in features.registry_features(registry(spark, rows), "202506").collect()}
    assert [(got[i]["workers_known"], got[i]["no_workers"]) for i in (1, 2, 3)] == [(0, 0), (1, 1), (1, 0)]
    assert got[1]["entity_type"] == got[1]["region"] == "DESCONOCIDO"


def test_entity_without_orders(spark):
    base = features.registry_features(registry(spark, [(1, "2", "ACTIVO", "HABIDO", "X", "LIMA", 2025, 6)]), "202506")
    contracts = features.contract_profile(orders(spark, (10.0, None, 1, "2025-01-15", None)))
    got = features.combine_features(base, contracts, features.exclusion_flag(spark.createDataFrame([(9,)], "entity_id bigint"))).first()
    assert (got["n_orders"], got["total_amount"], got["n_buyers"], got["has_contracts"], got["annulled_share"]) == (0, 0.0, 0, 0, 0.0)
    assert got["median_amount"] is None and got["excluded"] is False and got["amount_per_worker"] == 0.0


def test_history(spark):
    rows = [
        (1, "A", " ACTIVO", 2025, 1), (1, "B", "ACTIVO", 2025, 2), (1, "B", "ACTIVO ", 2025, 3),
        (2, "A", "ACTIVO", 2025, 2), (2, "A", "ACTIVO", 2025, 4),
        (3, "A", "ACTIVO", 2025, 1), (3, "Z", "BAJA", 2025, 5),
    ]
    df = spark.createDataFrame(rows, "entity_id bigint, billing_mode string, status string, year int, month int")
    got = {r["entity_id"]: r for r in features.registry_history(df, "202504").collect()}
    pick = lambda i: tuple(got[i][c] for c in ("months_seen", "new_in_period", "months_gap", "billing_changed", "status_changed"))
    assert [pick(i) for i in (1, 2, 3)] == [(3, 0, 0, 1, 0), (2, 1, 1, 0, 0), (1, 0, 0, 0, 0)]


def test_affiliations(spark):
    rows = [(1, "factura portal", "2025-01-01"), (2, "honorarios", "2026-04-01"), (3, "x", None), (4, "recibo por honorarios", "2026-01-01"), (4, "recibo por honorarios", "2026-02-01")]
    df = spark.createDataFrame(rows, "entity_id bigint, voucher_type string, start_date string").withColumn("start_date", F.to_date("start_date"))
    known = features.affiliation_features(df, "2026-03-31")
    base = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "entity_id bigint")
    got = {r["entity_id"]: r for r in features.attach_affiliations(base, known).collect()}
    assert (got[1]["aff_age_days"], got[1]["aff_n_types"], got[1]["aff_invoice_portal"], got[1]["affiliated"]) == (454, 1, 1, 1)
    assert got[2]["affiliated"] == got[3]["affiliated"] == 0 and got[2]["aff_age_days"] is None
    assert got[4]["aff_fees_only"] == 1 and got[4]["aff_n_types"] == 1


def test_feature_gate(spark):
    df = spark.createDataFrame([(1, "202506"), (2, "202506")], "entity_id bigint, ref_month string")
    quality.gate_features(df, ["202506"])
    with pytest.raises(quality.QualityError, match="202512"):
        quality.gate_features(df, ["202506", "202512"])
    with pytest.raises(quality.QualityError, match="repeat"):
        quality.gate_features(df.unionAll(df), ["202506"])


def test_latest_snapshot(spark):
    df = spark.createDataFrame([(1, 2025, 1), (2, 2025, 12), (3, 2025, 6)], "entity_id int, year int, month int")
    snapshot, year, month = regional.reference_snapshot(df)
    assert (year, month, [r["entity_id"] for r in snapshot.collect()]) == (2025, 12, [2])
    assert regional.reference_snapshot(df, 2025, 6)[0].count() == 1


def test_revenue_counts_nothing_twice(spark):
    rows = [("Lima", 100.0), ("Lima Metropolitana", 80.0), ("Lima Provincias", 10.0), ("Callao", 10.0), ("Cusco", 5.0), ("Total", 115.0)]
    got = regional.revenue_by_region(spark.createDataFrame(rows, "region string, amount double")).collect()
    assert {r["region"]: r["revenue"] for r in got} == {"LIMA": 90.0, "CALLAO": 10.0, "CUSCO": 5.0}


def test_two_rates_for_one_region_fail(spark):
    df = spark.createDataFrame([("LIMA", 1.0), ("LIMA", 2.0)], "region string, informal_pct double")
    with pytest.raises(ValueError, match="LIMA"):
        features.regional_rate(df)


def test_cutoff_reaches_the_scan(spark, plan_of, tmp_path):
    orders(spark, (1.0, None, 1, "2025-01-01", None)).write.parquet(str(tmp_path / "o"))
    plan = plan_of(features.contract_profile(spark.read.parquet(str(tmp_path / "o")), "2025-06-30"))
    assert "LessThanOrEqual(issue_date,2025-06-30)" in plan
    assert "CartesianProduct" not in plan and "Python" not in plan


def _orders_of_few_buyers(spark):
    rows = [
        (i, f"{i % 7}", f"{i % 7 % 3 * 1000 + i % 4}", float(i * 37 % 101) - 20, "Anulada" if i % 9 == 0 else None, f"2025-0{i % 6 + 1}-10")
        for i in range(200)
    ]
    rows += [(200 + i, "99", "1", float(i), None, "2025-01-01") for i in range(60)]
    return spark.createDataFrame(rows, "o long, contractor_id string, buyer_id string, amount double, order_status string, d string").withColumn("issue_date", F.to_date("d"))


def test_profile_sends_every_fact_to_its_entity_once(spark, plan_of):
    """One exchange of the facts, whatever the number of cut-offs; the feed behind them is not read again."""
    cutoffs = [("202503", "2025-03-31"), ("202506", "2025-06-30")]
    plan = plan_of(features.contract_profiles(_orders_of_few_buyers(spark), cutoffs))
    assert plan.count("Exchange") == 1 and plan.count("Scan parquet") == 1


def test_profile_of_large_entities_equals_that_of_usual_ones(spark):
    cutoffs = [("202503", "2025-03-31"), ("202506", "2025-06-30")]
    whole, mixed, spread = (features.contract_profiles(_orders_of_few_buyers(spark), cutoffs, most) for most in (1000, 30, 0))
    shown = lambda df: sorted(map(repr, df.select(*sorted(whole.columns)).collect()))
    assert shown(whole) == shown(mixed) == shown(spread)
    first = whole.filter("entity_id = 99 and ref_month = '202503'").first()
    assert (first["n_orders"], first["n_buyers"], first["median_amount"], first["total_amount"], first["top_buyer_share"]) == (60, 1, 29.0, 1770.0, 1.0)


def test_registry_history_sorts_no_rows(spark, plan_of):
    rows = [(1, 2025, 1, " A ", "X"), (1, 2025, 2, "A", None), (1, 2025, 3, None, "Y "), (2, 2025, 3, "B", None)]
    seen = spark.createDataFrame(rows, "entity_id long, year int, month int, status string, billing_mode string")
    got = features.registry_history(seen, "202503")
    assert "SortAggregate" not in plan_of(got)
    assert {r["entity_id"]: (r["status_changed"], r["billing_changed"]) for r in got.collect()} == {1: (0, 1), 2: (0, 0)}


def test_median_of_an_entity_is_exact_and_no_sketch(spark, plan_of):
    """Taken from the rows in order: the middle one, the lower of two, null without amounts; annulled ones are left out."""
    rows = [(1, f"{i}.25", None, i % 9) for i in range(60_001)] + [(2, f"{x}", None, 1) for x in (4, 1, 3, 2)] + [(2, "0", "anulada", 1), (3, "5", "anulada", 2)]
    orders = spark.createDataFrame(rows, "contractor_id long, amount string, order_status string, buyer_id long").select(
        "contractor_id", "buyer_id", "order_status", F.col("amount").cast("double").alias("amount"), F.to_date(F.lit("2025-03-01")).alias("issue_date")
    )
    made = features.contract_profiles(orders, [("202503", "2025-03-31"), ("202506", "2025-06-30")])
    assert "percentile_approx" not in plan_of(made)
    got = {(r["entity_id"], r["ref_month"]): r["median_amount"] for r in made.collect()}
    assert got == {(e, m): v for e, v in ((1, 30000.25), (2, 2.0), (3, None)) for m in ("202503", "202506")}


def _orders_of_many_amounts(spark):
    """Entity 1 has 120 001 unlike amounts, the lower even ones known in March and all in June; 3 has 1 200 annulled orders."""
    many = spark.range(120_001).select(F.lit(1).alias("contractor_id"), (F.col("id") * 7919 % 120_001).alias("x"), F.lit(None).cast("string").alias("order_status"))
    few = spark.createDataFrame([(2, x, None) for x in (4, 1, 3, 2)] + [(3, 5, "anulada")] * 1200, "contractor_id int, x long, order_status string")
    early = (F.col("contractor_id") == 1) & (F.col("x") % 2 == 0) & (F.col("x") < 119_998)
    day = F.to_date(F.when(early, "2025-03-01").otherwise("2025-06-01"))
    return many.unionByName(few).select("*", (F.col("x") + 0.25).alias("amount"), (F.col("x") % 9).alias("buyer_id"), day.alias("issue_date"))


def test_median_of_a_large_entity_is_exact_too(spark, plan_of):
    """Entities above the limit are spread over tasks; their medians equal those of the middle row at every cut-off."""
    cutoffs = [("202503", "2025-03-31"), ("202506", "2025-06-30")]
    whole, spread = (features.contract_profiles(_orders_of_many_amounts(spark), cutoffs, most) for most in (1_000_000, 1000))
    shown = lambda df: {(r["entity_id"], r["ref_month"]): r["median_amount"] for r in df.collect()}
    exact = {(1, "202503"): 59998.25, (1, "202506"): 60000.25, (2, "202506"): 2.25, (3, "202506"): None}
    assert shown(whole) == exact and shown(spread) == exact
    assert "percentile_approx" not in plan_of(spread)


def test_profile_of_one_date_has_the_exact_median_too(spark, plan_of):
    """Below and above the limit, at a date and over everything; an order without a date counts only in the latter."""
    made = _orders_of_many_amounts(spark)
    undated = made.limit(1).select(F.lit(4).alias("contractor_id"), "x", "order_status", F.lit(7.0).alias("amount"), "buyer_id", F.lit(None).cast("date").alias("issue_date"))
    for most in (1_000_000, 1000):
        everything, march = (features.contract_profile(made.unionByName(undated), date, most) for date in (None, "2025-03-31"))
        assert "percentile_approx" not in plan_of(everything)
        assert {r["entity_id"]: r["median_amount"] for r in everything.collect()} == {1: 60000.25, 2: 2.25, 3: None, 4: 7.0}
        assert {r["entity_id"]: r["median_amount"] for r in march.collect()} == {1: 59998.25}
