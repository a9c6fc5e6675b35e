from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakerisk.operators import selection
from lakerisk.operators.ordering import with_rank, with_running_totals
from lakerisk.operators.quantiles import exact_quantiles
from lakerisk.operators.selection import BOUND, rank_cuts, values_at
from lakerisk.session import drop_scratch, drop_staged, scratch_path, shared_folder, stage_table


@pytest.fixture(autouse=True)
def many_slices(spark):
    """Small test data would be coalesced into one slice; keep four."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def skewed(spark):
    """A third of the rows share one group and one score; one group is null."""
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 7))
    score = F.when(F.col("id") % 3 == 0, 0.5).otherwise((F.col("id") * 37 % 101) / 100)
    return spark.range(3000).select("id", group.alias("g"), score.alias("score"), (F.col("id") % 5 == 0).cast("int").alias("y"))


def test_rank_equals_the_plain_window(spark):
    order = [F.col("score").desc(), F.col("id")]
    window = Window.partitionBy("g").orderBy(*order)
    ranked = with_rank(skewed(spark), order, ["g"], total="n")
    both = ranked.withColumns({"w": F.row_number().over(window), "m": F.count("*").over(Window.partitionBy("g"))})
    assert both.count() == 3000
    assert both.filter("rank <> w OR n <> m OR rank IS NULL").count() == 0


def test_global_rank_has_no_gaps(spark):
    ranked = with_rank(skewed(spark), [F.col("score").desc(), F.col("id")])
    assert ranked.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()[:] == (1, 3000, 3000)


def test_hot_group_is_spread_over_slices(spark):
    from lakerisk.operators.ordering import _sliced

    df = skewed(spark).repartition(4)
    rows = _sliced(df, ["g"], [F.col("score").desc(), F.col("id")])
    assert rows.filter("g = 'hot'").select("_slice").distinct().count() > 1


def test_running_totals(spark):
    order = [F.col("score").desc(), F.col("id")]
    window = Window.partitionBy("g").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    walked = with_running_totals(skewed(spark), order, {"k": F.lit(1), "s": F.col("y")}, ["g"])
    both = walked.withColumns({"kw": F.count("*").over(window), "sw": F.sum("y").over(window), "all": F.sum("y").over(Window.partitionBy("g"))})
    assert both.filter("k <> kw OR s <> sw OR s_all <> all").count() == 0


def test_exact_quantiles(spark):
    import numpy as np

    df = skewed(spark)
    got = exact_quantiles(df, "score", {"a": 0.25, "b": 0.5, "c": 0.995}).first()
    want = np.quantile([r[0] for r in df.select("score").collect()], [0.25, 0.5, 0.995])
    assert np.allclose(list(got), want)


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_scratch_belongs_to_the_application(spark):
    table = stage_table(spark.range(3))
    assert table.count() == 3 and spark.sparkContext.applicationId in scratch_path(spark, "x")
    assert drop_scratch(spark) is True
    with pytest.raises(Exception, match="(?i)not exist|FAILED_READ_FILE"):
        table.count()


def test_superseded_tables_go_and_others_stay(spark, tmp_path):
    first, second = stage_table(spark.range(5), "first"), stage_table(spark.range(7), "second")
    folders = [Path(t.inputFiles()[0].removeprefix("file://")).parent for t in (first, second)]
    spark.range(3).write.parquet(f"{tmp_path}/plain")
    plain = spark.read.parquet(f"{tmp_path}/plain")
    drop_staged(first, plain, second.filter("id > 2"))
    assert [f.exists() for f in folders] == [False, True]
    assert (plain.count(), second.count()) == (3, 7)


def test_running_totals_exchange_no_row_twice(spark, plan_of):
    """Many small batches, groups that begin and end inside them, and null groups; then no exchange but that of slice totals."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(["a", None, "b", "c"][i % 4] if i < 300 else "a", i, i % 5 if i % 11 else None) for i in range(900)]
        df = spark.createDataFrame(rows, "g string, id long, v long").repartition(6)
        got = with_running_totals(df, [F.col("id").desc()], {"n": F.lit(1), "s": F.col("v")}, ["g"])
        expected, seen = {}, {}
        for g, i, v in sorted(rows, key=lambda r: -r[1]):
            n, s = seen.get(g, (0, 0))
            seen[g] = expected[i] = (n + 1, s + (v or 0))
        assert {r["id"]: (r["n"], r["s"]) for r in got.collect()} == expected
        assert all((r["n_all"], r["s_all"]) == seen[r["g"]] for r in got.collect())
        assert plan_of(got).count("Exchange hashpartitioning") <= 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def long_tailed(spark, n=1500):
    """Values over 600 orders of magnitude, a heap of equal ones, signs, nulls, infinities and NaN; a hot, a null and a one-row group."""
    import math

    odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 5e-324]
    value = lambda i: odd[i % 700] if i % 700 < 7 else 7.5 if i % 3 == 0 else (-1) ** i * 10.0 ** ((i * 7919) % 601 - 300)
    rows = [("hot" if i % 3 else [None, "a", "b"][i % 9 // 3], i, value(i)) for i in range(n)] + [("single", n, 2.0), ("void", n + 1, None)]
    return rows, spark.createDataFrame(rows, "g string, id long, score double").repartition(5)


@pytest.mark.parametrize("few", [20, 65_536])
def test_values_at_places_equal_sorting(spark, few):
    import math

    rows, df = long_tailed(spark)
    n = F.col("n")
    got = values_at(df, F.col("score"), {"first": F.lit(0), "mid": F.floor(n / 2), "last": n - 1, "past": n, "before": F.lit(-1)}, ["g"], few)
    held = {}
    for g, _, x in rows:
        if x is not None:
            held.setdefault(g, []).append(BOUND if math.isnan(x) else max(-BOUND, min(BOUND, x)))
    found = {r["g"]: (r["n"], r["first"], r["mid"], r["last"], r["past"], r["before"]) for r in got.collect()}
    assert found == {g: (len(v), min(v), sorted(v)[len(v) // 2], max(v), None, None) for g, v in held.items()}


def test_values_of_a_small_group_beside_a_large_one(spark):
    """Only the large group needs another histogram; the values of the small one are counted all the same."""
    rows = [("large", float(i)) for i in range(200)] + [("small", x) for x in (117.0, 118.0, 120.0, 120.0, 120.0)]
    got = values_at(spark.createDataFrame(rows, "g string, score double"), F.col("score"), {"mid": F.floor(F.col("n") / 2)}, ["g"], few=50)
    assert {r["g"]: r["mid"] for r in got.collect()} == {"large": 100.0, "small": 120.0}


def test_values_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "g string, id long, score double")
    assert values_at(empty, F.col("score"), {"x": F.lit(0)}).count() == 0
    assert rank_cuts(empty, {"x": F.lit(1)}, ["g"]).count() == 0


@pytest.mark.parametrize("few", [20, 65_536])
def test_rank_cuts_equal_the_plain_window(spark, few, monkeypatch):
    if few == 20:  # ties too large for a window
        monkeypatch.setattr(selection, "WINDOW_ROWS", 5)
    df = skewed(spark).withColumn("score", F.when(F.col("id") % 97 != 0, F.col("score")))
    n = F.col("n")
    cuts = {"none": F.lit(0), "one": F.lit(1), "part": F.floor(n * 0.3), "half": F.floor(n * 0.5), "all": n, "more": n + 5, "missing": F.lit(None)}
    got = {(r["g"], r["cut"]): r for r in rank_cuts(df, cuts, ["g"], few).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r["g"], []).append((-(r["score"] if r["score"] is not None else -BOUND), r["id"]))
    assert set(got) == {(g, c) for g in groups for c in ("one", "part", "half", "all", "more")}
    for (g, c), r in got.items():
        ordered = sorted(groups[g])
        size = len(ordered)
        want = ordered[: {"one": 1, "part": int(size * 0.3), "half": int(size * 0.5), "all": size, "more": size}[c]]
        taken = [t for t in ordered if -t[0] > r["cut_score"] or (-t[0] == r["cut_score"] and (r["cut_id"] is None or t[1] <= r["cut_id"]))]
        assert taken == want and r["take"] == len(want)


def test_selection_sorts_no_row(spark, plan_of):
    """Histograms are combined before the shuffle: what is exchanged are bins and values of small bins, never rows."""
    got = values_at(skewed(spark), F.col("score"), {"mid": F.floor(F.col("n") / 2)}, ["g"])
    assert "rangepartitioning" not in plan_of(got)
