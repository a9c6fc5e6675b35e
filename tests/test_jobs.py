"""The whole pipeline on small raw files."""

import pytest
from pyspark.sql import functions as F

from lakerisk.config import LakePaths
from lakerisk.operators.quality import QualityError
from lakerisk.plans import jobs, lake_queries
from lakerisk.sources import schemas
from lakerisk.sources.commits import Publication, latest, parts_table, read_table, vacuum
from lakerisk.sources.readers import read_run_records
from lakerisk.sources.writers import PublishError

BASE = 20000000000


def write_csv(paths, feed, month, columns, rows):
    folder = paths.table("raw", feed) + f"/anio=2025/mes={month}"
    import os

    os.makedirs(folder)
    with open(f"{folder}/part.csv", "w", encoding="utf-8") as f:
        f.write(",".join(c for c, _, _ in columns) + "\n")
        for row in rows:
            f.write(",".join("" if row.get(c) is None else str(row[c]) for c, _, _ in columns) + "\n")


def registry_rows(month):
    for i in range(1, 61):
        yield {
            "RUC": BASE + i, "Estado": "ACTIVO", "Condicion": "HABIDO", "Tipo": "SOCIEDAD ANONIMA",
            "Actividad_Economica_CIIU_revision4_Principal": f"A{i % 3}", "NroTrab": i % 4, "TipoFacturacion": "MANUAL" if month == 5 else "PC",
            "UBIGEO": 1, "Departamento": "Lima" if i % 2 else "Cuzco", "PERIODO_PUBLICACION": 202500 + month,
        }
    yield {"RUC": 77, "Estado": "ACTIVO", "PERIODO_PUBLICACION": 202500 + month}
    yield {"RUC": "broken", "Estado": "ACTIVO", "PERIODO_PUBLICACION": 202500 + month}


def order_rows(month):
    for i in range(1, 41):
        yield {
            "ruc_entidad": 20100000000 + i % 3, "orden": f"OC{i}", "monto_total_orden_original": 100.0 * i, "moneda": "Nuevos Soles",
            "ruc_contratista": BASE + i, "fecha_de_emision": "2025-05-0%d" % (1 + i % 9), "estadocontratacion": "Anulada" if i % 10 == 0 else "Vigente",
        }
    for i in range(5):
        yield {"ruc_entidad": 20100000001, "orden": f"only{month}-{i}", "monto_total_orden_original": 1, "fecha_de_emision": "2025-05-01"}
    yield {"ruc_entidad": 20100000001, "orden": f"late{month}", "monto_total_orden_original": 5, "fecha_de_emision": "2202-01-01"}
    yield {"ruc_entidad": 20100000001, "orden": f"neg{month}", "monto_total_orden_original": -5}


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    paths = LakePaths.under(str(tmp_path_factory.mktemp("lake")))
    for month in (5, 6):
        write_csv(paths, "registry", month, schemas.REGISTRY_COLUMNS, registry_rows(month))
        write_csv(paths, "orders", month, schemas.ORDER_COLUMNS, order_rows(month))
    return paths


def test_pipeline(spark, lake):
    assert jobs.ingest(spark, lake, jobs.REGISTRY) == {"clean": 122, "rejected": 2}
    assert jobs.ingest(spark, lake, jobs.ORDERS) == {"clean": 92, "rejected": 2}

    report = {r["month"]: r for r in jobs.clean(spark, lake, jobs.REGISTRY).collect()}
    assert (report[5]["n_bronze"], report[5]["n_bronze_rejected"], report[5]["n_silver"], report[5]["n_rejected"]) == (61, 1, 60, 1)
    jobs.clean(spark, lake, jobs.ORDERS)
    orders = read_table(spark, lake, "silver", "orders")
    # The repeats of the earlier load are gone: each order is kept from month 6.
    assert orders.count() == 50 and orders.filter("order_no LIKE 'OC%'").select("month").distinct().collect()[0][0] == 6
    assert read_table(spark, lake, "silver", "quarantine_orders").count() == 2
    assert read_table(spark, lake, "silver", "quality_report").select("source").distinct().count() == 2

    side = {
        "exclusions": spark.createDataFrame([(str(BASE + 60), "X")] * 20, "entity_id string, name string"),
        "register": spark.createDataFrame(
            [(str(BASE + i), f"{i:02d}/08/2025", f"{i:02d}/08/2025", "01/10/2025", "D%d" % (i // 3)) for i in range(1, 16)],
            "RUC string, `fecha de emisión` string, `quedó firme` string, `fecha de publicación` string, `documento de identidad del representante` string"),
        "affiliations": spark.createDataFrame([(str(BASE + i), "FACTURA PORTAL", "2024-01-01") for i in range(1, 61)], "entity_id string, voucher_type string, start_date string"),
        "survey": spark.createDataFrame([(15, 1.0, 1.0, 3.0), (15, 1.0, 2.0, 1.0), (8, 1.0, 2.0, 1.0)], "code int, employed double, informal double, weight double"),
        "revenue": spark.createDataFrame([("Lima Metropolitana", "2025_Ene.", 2025, "Ene.", "10.5"), ("Total", "2025_Ene.", 2025, "Ene.", "99")],
                                         "region string, period string, year bigint, month string, amount string"),
    }
    for name, raw in side.items():
        assert jobs.prepare_side_source(spark, lake, name, raw, jobs.SIDE_SOURCES[name]) > 0
    assert jobs.build_regional(spark, lake) >= 2
    regional = {r["region"]: r for r in read_table(spark, lake, "gold", "regional_summary").collect()}
    assert (regional["LIMA"]["active_entities"], regional["LIMA"]["informal_pct"], regional["LIMA"]["revenue"]) == (30, 75.0, 10.5)

    assert jobs.build_features(spark, lake, "202505:2025-05-31,202506:2025-06-30") == 120
    feats = read_table(spark, lake, "gold", "features")
    changed = feats.groupBy("ref_month").agg(F.sum("billing_changed").alias("n")).collect()
    assert {r["ref_month"]: r["n"] for r in changed} == {"202505": 0, "202506": 60}
    assert feats.filter("ref_month = 202506 AND region = 'LIMA'").first()["regional_informal_pct"] == 75.0

    rows, coverage = jobs.build_scoring(spark, lake)
    assert rows == 120 and coverage.first()[:] == (15, 15)

    report = jobs.build_curated(spark, lake, "v1", ("202506", "2025-06-30")).first()
    assert (report["rows"], report["positives"]) == (59, 15)
    inputs = read_table(spark, lake, "gold", "model_inputs")
    assert inputs.select("id").distinct().count() == 59
    assert inputs.filter("label = 1").groupBy("split").count().count() == 2

    run_id = jobs.train(spark, lake, "v1", "E6", "t", [{"depth": 2, "leaf": 2}], replicates=50, ks=(5,))
    assert run_id == "risk-run-E6-dt-v2-w0-t"
    assert read_table(spark, lake, "gold", "model_outputs").count() == 59
    valid, rejected = read_run_records(spark, lake.table("gold", "model_runs"))
    record = valid.first()
    assert record["model_name"] == "DT" and rejected.count() == 0
    assert record["hiperparametros_ganadores"] == {"depth": "2", "leaf": "2"} == record["grilla_probada"]
    assert record["semilla"] == 42 and record["n_features_transformadas"] > 20
    assert read_table(spark, lake, "gold", "runs").select("run_id").first()[0] == run_id
    metrics = spark.read.json(lake.table("gold", "model_metrics")).first()
    assert metrics["run_id"] == run_id and metrics["pr_auc_low"] <= metrics["pr_auc_high"]


def test_bad_month_publishes_nothing(spark, lake, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    rows = [{"RUC": i, "PERIODO_PUBLICACION": 202507} for i in range(5)]
    write_csv(paths, "registry", 7, schemas.REGISTRY_COLUMNS, rows)
    jobs.ingest(spark, paths, jobs.REGISTRY)
    with pytest.raises(QualityError):
        jobs.clean(spark, paths, jobs.REGISTRY)
    assert read_table(spark, paths, "silver", "registry") is None


def test_contract_breach_stops_before_writing(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path))
    with Publication(spark, paths, "test") as out:
        out.stage("bronze", "registry", spark.createDataFrame([(1, 2025, 1)], "RUC bigint, anio int, mes int"), ["anio", "mes"])
    with pytest.raises(schemas.ContractError, match="missing column Estado"):
        jobs.clean(spark, paths, jobs.REGISTRY)


def test_ingest_keeps_the_months_it_does_not_touch(spark, tmp_path):
    import shutil

    paths = LakePaths.under(str(tmp_path / "lake"))
    for month in (5, 6):
        write_csv(paths, "registry", month, schemas.REGISTRY_COLUMNS, registry_rows(month))
        jobs.ingest(spark, paths, jobs.REGISTRY)
        shutil.rmtree(paths.table("raw", "registry"))
    bronze = read_table(spark, paths, "bronze", "registry")
    assert {r["mes"]: r["count"] for r in bronze.groupBy("mes").count().collect()} == {5: 61, 6: 61}
    assert read_table(spark, paths, "bronze", "quarantine/registry").count() == 2
    write_csv(paths, "registry", 5, schemas.REGISTRY_COLUMNS, list(registry_rows(5))[:10])
    assert jobs.ingest(spark, paths, jobs.REGISTRY) == {"clean": 71, "rejected": 1}
    # A month reloaded with nothing but rejects loses its old clean rows.
    shutil.rmtree(paths.table("raw", "registry"))
    write_csv(paths, "registry", 6, schemas.REGISTRY_COLUMNS, [{"RUC": "broken"}] * 3)
    assert jobs.ingest(spark, paths, jobs.REGISTRY) == {"clean": 10, "rejected": 3}
    assert [r["part"] for r in parts_table(spark, paths, "bronze", "registry").collect()] == ["anio=2025/mes=5"]


@pytest.fixture()
def small_lake(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path / "lake"))
    rows = spark.createDataFrame([(i, i % 3, None if i % 4 else "x y/z") for i in range(24)], "id long, month int, kind string")
    with Publication(spark, paths, "first") as out:
        out.stage("silver", "orders", rows, ["month", "kind"])
        out.stage("gold", "total", rows.groupBy().count(), single_file=True)
    return paths, rows


def state(spark, paths):
    return {key: sorted(map(tuple, read_table(spark, paths, *key.split("/", 1)).collect()), key=str) for key in latest(spark, paths)["tables"]}


def test_a_job_killed_between_two_outputs_changes_nothing(spark, small_lake):
    paths, rows = small_lake
    before, number = state(spark, paths), latest(spark, paths)["number"]
    with pytest.raises(RuntimeError, match="killed"):
        with Publication(spark, paths, "second") as out:
            out.stage("silver", "orders", rows.filter("id < 3"), ["month", "kind"])
            raise RuntimeError("killed")
    assert state(spark, paths) == before and latest(spark, paths)["number"] == number
    assert vacuum(spark, paths, older_than_seconds=0) > 0 and state(spark, paths) == before


def test_only_replaced_parts_change(spark, small_lake, plan_of):
    paths, rows = small_lake
    with Publication(spark, paths, "second") as out:
        out.stage("silver", "orders", rows.filter("month = 1 AND kind IS NULL").limit(2), ["month", "kind"], replaces=[(1, None), (2, "x y/z")])
        assert out.observed("silver", "orders") == {"rows": 2}
    table = read_table(spark, paths, "silver", "orders")
    counts = {(r["month"], r["kind"]): r["count"] for r in table.groupBy("month", "kind").count().collect()}
    assert counts == {(0, None): 6, (0, "x y/z"): 2, (1, None): 2, (1, "x y/z"): 2, (2, None): 6}
    assert plan_of(table.filter("month = 1").select("id")).count("PartitionFilters: [isnotnull(month") == 1
    first = read_table(spark, paths, "silver", "orders", commit={"tables": latest(spark, paths)["tables"]})
    assert first.count() == 18


def test_a_table_changed_meanwhile_is_not_overwritten(spark, small_lake):
    paths, rows = small_lake
    slow, other = Publication(spark, paths, "slow"), Publication(spark, paths, "other")
    slow.stage("silver", "orders", rows.filter("id = 1"), ["month", "kind"])
    other.stage("gold", "total", rows.limit(1), single_file=True)
    assert other.commit() == 2 and slow.commit() == 3
    assert read_table(spark, paths, "silver", "orders").count() == 1 and read_table(spark, paths, "gold", "total").count() == 1
    late, early = Publication(spark, paths, "late"), Publication(spark, paths, "early")
    for job in (late, early):
        job.stage("gold", "total", rows.limit(2), single_file=True)
    early.commit()
    with pytest.raises(PublishError, match="changed by commit 4"):
        late.commit()


def test_empty_and_map_columns_are_published(spark, tmp_path):
    paths = LakePaths.under(str(tmp_path / "lake"))
    odd = spark.createDataFrame([({"a": "1"}, [1], None)], "m map<string,string>, l array<int>, s struct<x: int>")
    with Publication(spark, paths, "odd") as out:
        out.stage("gold", "odd", odd)
        assert out.stage("gold", "none", odd.filter("false")).count() == 0
    assert read_table(spark, paths, "gold", "odd").first()["m"] == {"a": "1"}
    assert read_table(spark, paths, "gold", "none").columns == ["m", "l", "s"] and read_table(spark, paths, "gold", "other") is None


def test_rows_lost_on_the_way_are_noticed(spark, tmp_path, monkeypatch):
    paths = LakePaths.under(str(tmp_path / "lake"))
    monkeypatch.setattr(Publication, "_written", lambda self, *a: {})
    with pytest.raises(PublishError, match="3 rows were written, 0 are read back"):
        Publication(spark, paths, "x").stage("gold", "t", spark.range(3))


def test_training_refuses_a_cutoff_above_the_test_rows(spark, lake):
    before = latest(spark, lake)["number"]
    with pytest.raises(ValueError, match="exceed"):
        jobs.train(spark, lake, "v1", "E6", "big", [{"depth": 2, "leaf": 2}], replicates=5)
    assert latest(spark, lake)["number"] == before


def test_roundtrip_makes_the_feed_once(spark, tmp_path, monkeypatch):
    """Every later job of the round trip scans what the first load wrote, not the tables behind the feed."""
    rows = [(2001, m, n, float(n) if n else None, n) for m in (1, 2, 3, 4) for n in (0, 1, 2)]
    spark.createDataFrame(rows, "year int, month int, line_no int, amount double, n int").write.parquet(f"{tmp_path}/feed")
    scanned, stage = [], lake_queries.Publication.stage
    monkeypatch.setattr(lake_queries, "bind", lambda s, d, name: s.read.parquet(f"{d}/{name}"))
    monkeypatch.setattr(lake_queries.Publication, "stage", lambda self, layer, name, df, *a, **k: scanned.append(set(df.inputFiles())) or stage(self, layer, name, df, *a, **k))
    got = {(r["year"], r["month"]): (r["rows"], r["committed_rows"], r["amount"]) for r in lake_queries.publish_roundtrip(spark, str(tmp_path)).collect()}
    assert got == {(2001, 1): (3, 3, 3.0), (2001, 2): (2, 2, 3.0), (2001, 4): (3, 3, 3.0)}
    assert [any("/feed/" in file for file in files) for files in scanned] == [True] + [False] * (len(scanned) - 1) and len(scanned) == 5


def test_incremental_loads_make_the_feed_and_read_the_parsed_rows_once(spark, tmp_path, monkeypatch):
    """Both raw loads are one write with few files a month, and each side of an ingest is one scan of the parsed rows."""
    rows = [("OC-1", 20000000001, None, "20000000002", 1.5, None, None, 1996, m, n) for m in range(1, 13) for n in range(1, 9)]
    types = "order_no string, buyer_id long, buyer_name string, contractor_id string, amount double, currency string, order_status string, year int, month int, line_no int"
    feed = spark.createDataFrame(rows, types).withColumn("issue_date", F.lit("1996-01-31").cast("date")).repartition(8)
    for name in ("bind", "bind_spread"):
        monkeypatch.setattr(lake_queries, name, lambda s, d, name: feed, raising=False)
    folders, scans, write, stage = [], [], lake_queries._write_raw, Publication.stage
    monkeypatch.setattr(lake_queries, "_write_raw", lambda df, path, *a: folders.append(path) or write(df, path, *a))
    scanned = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    monkeypatch.setattr(Publication, "stage", lambda self, layer, name, df, *a, **k: scans.append(scanned(df)) or stage(self, layer, name, df, *a, **k))
    got = {r["month"]: (r["n_clean"], r["n_rejected"]) for r in lake_queries.ingest_incremental(spark, str(tmp_path)).collect()}
    assert got == {1: (0, 8), 2: (3, 0)} | {m: (7, 1) for m in range(3, 13)}
    assert len(folders) == 1 and scans == [1] * 4
    files = [f for f in spark.read.option("recursiveFileLookup", True).text(folders[0]).inputFiles()]
    assert len(files) == 6 + 8


def test_checksum_is_the_sum_of_the_row_hashes(spark, small_lake):
    paths, rows = small_lake
    hashes = rows.select("month", "kind", F.pmod(F.xxhash64("id", "month", "kind"), F.lit(1 << 31)).alias("h")).collect()
    total = sum(int(p["checksum"]) for p in parts_table(spark, paths, "silver", "orders").collect())
    assert total == sum(r["h"] for r in hashes) > 1 << 31
