import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakerisk.config import LakePaths, cutoff_of, parse_cutoffs, staging_path
from lakerisk.functions import dates, ids, numbers, regions, text


def values(spark, expr, rows, ddl="x string"):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr.alias("v")).collect()]


def test_valid_id(spark):
    rows = [("20123456789",), (" 20123456789 ",), ("12345678",), ("2012345678A",), (None,)]
    assert values(spark, ids.valid_id(F.col("x")), rows) == [True, True, False, False, False]


def test_id_parts(spark):
    rows = [(20123456789,), (10000000012,)]
    assert values(spark, ids.id_prefix(F.col("x")), rows, "x bigint") == ["20", "10"]
    assert values(spark, ids.id_sequence(F.col("x")), rows, "x bigint") == [12345678, 1]
    assert values(spark, ids.padded_id(F.col("x")), [(5,), (None,)], "x bigint") == ["00000000005", None]


def test_order_hash_is_never_negative(spark):
    df = spark.range(5000).select(ids.order_hash(F.col("id").cast("string"), "s").alias("h"))
    assert df.filter("h < 0").count() == 0
    with pytest.raises(ValueError):
        ids.order_hash(F.col("x"), "s", "sha")


def test_hash_uniform_covers_the_unit_interval(spark):
    df = spark.range(20000).select(ids.hash_uniform(F.col("id").cast("string"), 7).alias("u"))
    low, high, mean = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= low < 0.01 and 0.99 < high < 1 and abs(mean - 0.5) < 0.01


def test_normalise_region(spark):
    rows = [("lima ",), ("Áncash",), ("Junín\n",), ("Lima Metropolitana",), ("NO DISPONIBLE",), (None,), ("Ñuñoa",), ("Junín",)]
    got = values(spark, regions.normalise_region(F.col("x")), rows)
    assert got == ["LIMA", "ANCASH", "JUNIN", "LIMA", None, None, "NUNOA", "JUNIN"]


def test_region_codes_and_months(spark):
    assert values(spark, regions.region_from_code(F.col("x")), [(15,), (7,), (None,)], "x int") == ["LIMA", None, None]
    assert values(spark, regions.month_label(F.col("x")), [("SET",), ("dic.",), ("total",)]) == ["Sep.", "Dic.", None]


def test_region_display(spark):
    df = spark.createDataFrame([(" ", "Cusco"), ("Provincia Constitucional del Callao", None), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(regions.region_display(F.col("a"), F.col("b"))).collect()]
    assert got == ["Cusco", "Callao", None]


def test_dates(spark):
    assert values(spark, dates.day_first_date(F.col("x")), [("25/12/2024",), ("2024-01-03",), ("x",)]) == [
        dt.date(2024, 12, 25), dt.date(2024, 1, 3), None]
    assert values(spark, dates.serial_date(F.col("x")), [("45651",)]) == [dt.date(2024, 12, 25)]
    assert values(spark, dates.month_end(F.col("x")), [("202502",)]) == [dt.date(2025, 2, 28)]
    assert values(spark, dates.month_index(F.col("x")), [("202501",)]) == [2025 * 12 + 1]
    age = dates.age_days(dates.month_end(F.col("x")), F.lit("2025-01-15").cast("date"))
    assert values(spark, age, [("202501",), ("202502",), ("202412",)]) == [16, 44, None]
    closed = dates.closed_month_end(F.col("x").cast("date"))
    assert values(spark, closed, [("2026-10-31",)]) == [dt.date(2026, 9, 30)]


def test_numbers(spark):
    assert values(spark, numbers.soft_log(F.col("x")), [(-5.0,), (0.0,), (None,)], "x double") == [0.0, 0.0, None]
    assert values(spark, numbers.clean_number(F.col("x")), [("1.23456",), ("NaN",), ("abc",), (None,)]) == [1.2346, 0.0, 0.0, 0.0]
    rows = [(10.0, 2.0), (10.0, 0.0), (10.0, None), (None, 2.0)]
    assert values(spark, numbers.amount_per_worker(F.col("a"), F.col("w")), rows, "a double, w double") == [5.0, None, None, None]
    assert values(spark, numbers.percent(F.col("a"), F.col("b"), 2), [(1, 3), (1, 0)], "a int, b int") == [33.33, None]
    assert values(spark, numbers.finite_or_null(F.col("x")), [(float("nan"),), (float("inf"),), (2.0,)], "x double") == [None, None, 2.0]


def test_run_ids(spark):
    rows = [("risk-run-E5-lr-v2-w1",), ("other",)]
    assert values(spark, text.experiment_of(F.col("x"), "risk-run"), rows) == ["E5", None]
    built = text.run_id_of("risk-run", F.lit("E1"), F.lit("LR"), F.lit("V2"), F.lit(False), F.col("x"))
    assert values(spark, built, [("t1",), ("",)]) == ["risk-run-E1-lr-v2-w0-t1", "risk-run-E1-lr-v2-w0"]


def test_cutoffs_and_paths():
    assert parse_cutoffs("202506:2025-06-30, 202512:2025-12-31") == [("202506", "2025-06-30"), ("202512", "2025-12-31")]
    assert parse_cutoffs("") == parse_cutoffs("todas") == parse_cutoffs(None) and len(parse_cutoffs()) == 3
    for bad in ("202513:2025-06-30", "2025:2025-06-30", "202506:junio"):
        with pytest.raises(ValueError):
            parse_cutoffs(bad)
    assert cutoff_of("v3") == ("202603", "2026-03-31")
    with pytest.raises(ValueError):
        cutoff_of("v9")
    assert staging_path("s3://bucket/silver/orders") == "s3://bucket/_staging/silver/orders"
    assert LakePaths.under("/lake").quarantine("silver", "orders") == "/lake/silver/quarantine_orders"


def test_all_bad_cutoffs_are_named_at_once():
    with pytest.raises(ValueError, match="202513.*junio"):
        parse_cutoffs("202513:2025-06-30,202506:2025-06-30,202506:junio")


def test_scratch_needs_a_shared_folder_off_one_machine():
    from types import SimpleNamespace

    from lakerisk.session import shared_folder

    for master, fails in (("spark://host:7077", True), ("yarn", True), ("local-cluster[2,1,1024]", True), ("local[4]", False)):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        fake = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default, set=lambda key, value: None), sparkContext=context)
        if fails:
            with pytest.raises(RuntimeError):
                shared_folder(fake)
        else:
            assert shared_folder(fake).startswith("/tmp/spark-")
