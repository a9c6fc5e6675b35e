import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakerisk.operators import dedup, quality, quarantine
from lakerisk.sources import schemas, small

ORDERS = "order_no string, buyer_id bigint, contractor_id string, amount double, region string, year int, month int"
GOOD = 20123456789


def test_registry_split(spark):
    rows = [(GOOD, "lima ", 202501, 2025, 1), (123, "Cusco", 202501, 2025, 1), (None, "Puno", 202501, 2025, 1), (GOOD, "lima ", 202501, 2025, 1)]
    entered = dedup.registry_snapshot(spark.createDataFrame(rows, "entity_id bigint, region string, period int, year int, month int"))
    silver, rejected = quarantine.split_registry(entered)
    assert [r["region"] for r in silver.collect()] == ["LIMA"]
    assert {r[quarantine.REASON] for r in rejected.collect()} == {"ruc_invalido"} and rejected.count() == 2


def test_orders_split(spark):
    rows = [
        ("1", GOOD, None, 10.0, "lima", 2025, 1),
        ("2", GOOD, "12345678", 10.0, None, 2025, 1),
        ("3", 99, "20123456789", 10.0, None, 2025, 1),
        ("4", 99, "12345678", 10.0, None, 2025, 1),
        ("5", GOOD, None, -1.0, None, 2025, 1),
        ("6", GOOD, None, None, None, 2025, 1),
    ]
    silver, rejected = quarantine.split_orders(spark.createDataFrame(rows, ORDERS))
    assert [r["order_no"] for r in silver.collect()] == ["1"]
    assert {r["order_no"]: r[quarantine.REASON] for r in rejected.collect()} == {
        "2": "ruc_contratista_invalido",
        "3": "ruc_entidad_invalido",
        "4": "ruc_entidad_invalido;ruc_contratista_invalido",
        "5": "monto_negativo",
        "6": "monto_nulo",
    }


def test_keep_latest(spark, plan_of):
    rows = [("O1", GOOD, None, 1.0, None, 2025, m) for m in (1, 3, 2)] + [(None, GOOD, None, 5.0, None, 2025, 1)] * 2
    kept = dedup.keep_latest_order(spark.createDataFrame(rows, ORDERS))
    assert sorted((r["order_no"] or "", r["month"]) for r in kept.collect()) == [("", 1), ("", 1), ("O1", 3)]
    # The limit must run before the shuffle, or a hot order number would fill one task.
    assert plan_of(kept).count("WindowGroupLimit") >= 2


def test_report_and_gates(spark):
    rows = [("1", GOOD, None, 1.0, None, 2025, 1), ("2", 9, None, 1.0, None, 2025, 1), ("3", GOOD, None, 1.0, None, 2025, 2)]
    entered = spark.createDataFrame(rows, ORDERS)
    silver, rejected = quarantine.split_orders(entered)
    report = quality.quality_report("orders", entered, entered, silver, rejected, entered.limit(1))
    got = {r["month"]: r for r in report.collect()}
    assert (got[1]["n_bronze"], got[1]["n_silver"], got[1]["n_rejected"], got[1]["reject_rate"]) == (2, 1, 1, 0.5)
    assert got[1]["bronze_reject_rate"] == pytest.approx(1 / 3) and got[2]["reject_rate"] == 0.0
    quality.gate_reject_rate(report, 0.5)
    with pytest.raises(quality.QualityError, match="2025-1"):
        quality.gate_reject_rate(report, 0.4)
    quality.gate_written(report, silver)
    with pytest.raises(quality.QualityError):
        quality.gate_written(report, silver.filter("month = 1"))


def test_year_quarantine_keeps_null_dates(spark):
    df = spark.createDataFrame([(1, None, "2024-05-01"), (2, "2202-01-01", None), (3, "2024-01-01", "1999-01-01")], "id int, a string, b string")
    dated = df.select("id", F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    clean, bad = quarantine.split_by_year(dated, ["a", "b"])
    assert [r["id"] for r in clean.collect()] == [1]
    assert sorted(r["id"] for r in bad.collect()) == [2, 3]


def test_contracts(tmp_path):
    schemas.check_contract(schemas.ORDERS_SCHEMA, "orders")
    renamed = schemas._struct([("monto", "double", "x")] + schemas.ORDER_COLUMNS[:-1])
    with pytest.raises(schemas.ContractError, match="monto"):
        schemas.check_contract(renamed, "orders")
    retyped = schemas._struct([(n, "string" if n == "monto_total_orden_original" else k, x) for n, k, x in schemas.ORDER_COLUMNS])
    with pytest.raises(schemas.ContractError, match="expected double"):
        schemas.check_contract(retyped, "orders")
    written = schemas.export_contracts(tmp_path)
    assert sorted(p.name for p in written) == ["orders.v1.json", "registry.v1.json"]


@pytest.mark.parametrize("name", sorted(schemas.CONTRACTS))
def test_stored_contract_equals_the_schema(name):
    stored = Path(__file__).resolve().parents[1] / "contracts" / f"{name}.v1.json"
    assert json.loads(stored.read_text()) == schemas.contract_json(name)


def test_label_register(spark):
    raw = spark.createDataFrame(
        [("20123456789", "45651", "x ", "1"), ("20123456789", "45000", " y", "2"), ("20999999999", "45100", None, "3")],
        "RUC string, `Fecha de emisión de la resolución` string, `Documento de identidad del representante legal` string, note string",
    )
    got = {r["entity_id"]: r for r in small.label_register(raw).collect()}
    assert str(got[20123456789]["issue_date"]) == "2023-03-15" and got[20123456789]["representative"] == "y"
    assert len(got) == 2 and got[20999999999]["positive"] is True and "note" not in got[20123456789]
    text = raw.withColumn("Fecha de emisión de la resolución", F.lit("25/12/2024"))
    assert str(small.label_register(text).first()["issue_date"]) == "2024-12-25"
    with pytest.raises(ValueError, match="issue_date"):
        small.label_register(raw.select("RUC", "note"))


def test_affiliation_source(spark):
    rows = [("20123456789", " FACTURA PORTAL ", "2025-01-01")] * 20 + [("20123456780", "x", "not a date")] * 5
    got = small.affiliations(spark.createDataFrame(rows, "entity_id string, voucher_type string, start_date string")).collect()
    assert sorted((r["entity_id"], r["voucher_type"], str(r["start_date"])) for r in got) == [
        (20123456780, "x", "None"), (20123456789, "factura portal", "2025-01-01")]


def test_exclusion_source_and_id_guard(spark):
    rows = [("20123456789", "A")] * 10 + [("20999999999", "B")] * 10 + [("(*) footnote", None)]
    assert small.exclusion_list(spark.createDataFrame(rows, "entity_id string, name string")).count() == 2
    with pytest.raises(ValueError, match="11-digit"):
        small.checked_ids(spark.createDataFrame([("1",), ("2",)], "entity_id string"), "x")
    with pytest.raises(ValueError):
        small.checked_ids(spark.createDataFrame([], "entity_id string"), "x")


def test_survey_and_revenue_sources(spark):
    rows = [(15.0, 1.0, 1.0, 2.0, "x"), (None, 1.0, 1.0, 2.0, "x"), (3.0, 1.0, 1.0, None, "x")]
    got = small.survey(spark.createDataFrame(rows, "code double, employed double, informal double, weight double, extra string"))
    assert got.columns == ["code", "employed", "informal", "weight"] and [r["code"] for r in got.collect()] == [15]
    long = spark.createDataFrame([("Cusco", "2025_Ene.", 2025, "Ene.", "1500.5"), ("Cusco", "2025_Feb.", 2025, "Feb.", "n.d.")],
                                 "region string, period string, year int, month string, amount string")
    assert [r["amount"] for r in small.revenue(long).collect()] == [1500.5]
    with pytest.raises(ValueError):
        small.revenue(long.drop("month"))


def test_revenue_long(spark):
    wide = spark.createDataFrame(
        [("Cusco", None, "1.5", "n.d.", "9"), (None, "Provincia Constitucional del Callao", "2", "3", "9"), (" ", None, "7", "7", "9")],
        "c1 string, c2 string, `2025_Set.` string, `2026_ene` string, `2026_Total` string",
    )
    got = sorted((r["region"], r["period"], r["year"], r["month"], r["amount"]) for r in small.revenue_long(wide, ("c1", "c2")).fillna(-1.0).collect())
    assert got == [("Callao", "2025_Sep.", 2025, "Sep.", 2.0), ("Callao", "2026_Ene.", 2026, "Ene.", 3.0),
                   ("Cusco", "2025_Sep.", 2025, "Sep.", 1.5), ("Cusco", "2026_Ene.", 2026, "Ene.", -1.0)]
