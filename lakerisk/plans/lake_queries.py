"""Registered queries that run whole jobs on a lake of their own in the scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.config import LakePaths
from lakerisk.operators import quality
from lakerisk.plans import jobs
from lakerisk.plans.bindings import bind, bind_spread, binding_sql
from lakerisk.session import scratch_path, stage_table
from lakerisk.sources import commits, schemas
from lakerisk.sources.commits import Publication


def _by_month(table: DataFrame) -> DataFrame:
    total = F.sum(F.col("amount").cast("decimal(18,2)")).cast("double")
    return table.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"), total.alias("amount"))


def publish_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Orders through four jobs: a first load, one killed after its first output, one that replaces February and
    empties March, one that lost a race. What readers see then, with the rows the commits hold.

    The feed is made once, by the first load; the later jobs take their rows from the folders it wrote, which hold all of
    them and stay as they are, so they read only the months they need.
    """
    lake = LakePaths.under(scratch_path(spark, "lake"))
    with Publication(spark, lake, "load") as out:
        feed = out.stage("silver", "orders", bind(spark, d, "feed"), jobs.MONTHLY)
        out.stage("silver", "totals", _by_month(feed), single_file=True)
    try:
        with Publication(spark, lake, "killed") as out:
            out.stage("silver", "orders", feed.filter(F.col("line_no") == 1), jobs.MONTHLY)
            raise InterruptedError("killed between two outputs")
    except InterruptedError:
        pass
    spring = feed.filter(F.col("month").isin(2, 3))
    months = [tuple(r) for r in spring.select("year", "month").distinct().collect()]  # two a year
    late = Publication(spark, lake, "late")
    late.stage("silver", "orders", spring, jobs.MONTHLY)
    with Publication(spark, lake, "spring") as out:
        kept = spring.filter((F.col("month") == 2) & F.col("amount").isNotNull())
        out.stage("silver", "orders", kept, jobs.MONTHLY, replaces=months)
    try:
        late.commit()
    except commits.PublishError:
        pass  # "spring" changed the table meanwhile, so the late job must not win
    parts = commits.parts_table(spark, lake, "silver", "orders")
    counted = parts.select(
        *[F.regexp_extract("part", f"{c}=([0-9]+)", 1).cast("int").alias(c) for c in jobs.MONTHLY], F.col("rows").alias("committed_rows")
    )
    return _by_month(commits.require_table(spark, lake, "silver", "orders")).join(counted, jobs.MONTHLY, "full").select("year", "month", "rows", "committed_rows", "amount")


def _write_raw(feed: DataFrame, path: str, broken, *above: str) -> None:
    """The feed as raw CSV with its source headers, by load month and by the columns above it; rows marked broken get a
    text as amount.

    The rows of a month are brought together first, in tasks of bounded size: else every task leaves a file in every month.
    """
    own = {raw: F.col(name) for raw, _, name in schemas.ORDER_COLUMNS if name in feed.columns}
    # Dates move ten years on, into the range that ingest accepts.
    own["fecha_de_emision"] = F.add_months("issue_date", 120)
    own["monto_total_orden_original"] = F.when(broken, F.lit("no number")).otherwise(F.col("amount").cast("decimal(18,2)").cast("string"))
    columns = [own.get(raw, F.lit(None)).cast("string").alias(raw) for raw, _, _ in schemas.ORDER_COLUMNS]
    by = [*above, "anio", "mes"]
    out = feed.withColumns({"anio": F.col("year"), "mes": F.col("month")}).select(*columns, *by).hint("rebalance", *by)
    out.write.option("header", True).partitionBy(*by).csv(path)


def ingest_incremental(spark: SparkSession, d: str) -> DataFrame:
    """Two loads: months 1 to 6, then 7 to 12 with January reloaded as nothing but rejects and February in part.

    The files of both are written at once, so the feed is made once.
    """
    lake, month, line = LakePaths.under(scratch_path(spark, "lake")), F.col("month"), F.col("line_no")
    again = (month == 1) | ((month == 2) & (line <= 3)) | (month >= 7)
    loads = F.array_compact(F.array(F.when(month <= 6, 1), F.when(again, 2)))
    feed = bind_spread(spark, d, "feed").withColumn("load", F.explode(loads))
    _write_raw(feed, lake.table("raw", "orders"), (line == 7) | ((F.col("load") == 2) & (month == 1)), "load")
    for load in (1, 2):
        jobs.ingest(spark, lake, jobs.ORDERS, f"{lake.table('raw', 'orders')}/load={load}")
    sides = {"clean": "orders", "rejected": "quarantine/orders"}
    rows = [commits.require_table(spark, lake, "bronze", name).select("anio", "mes", F.lit(side).alias("side")) for side, name in sides.items()]
    counts = rows[0].unionByName(rows[1]).groupBy("anio", "mes").agg(*[F.count_if(F.col("side") == s).alias(f"n_{s}") for s in sides])
    return counts.select(F.col("anio").alias("year"), F.col("mes").alias("month"), "n_clean", "n_rejected")


def cleaned_months(spark: SparkSession, d: str) -> DataFrame:
    """Orders through ingest and clean; the published quality report by month with the verdict of both gates.

    Orders go without number here, so none counts as a repeat. Every tenth part has a buyer with a broken id, and all have in
    February, which the reject-rate gate must flag.
    """
    lake = LakePaths.under(scratch_path(spark, "lake"))
    feed = bind(spark, d, "feed").filter(F.col("order_no").isNotNull())
    one = feed.filter("line_no = 1").withColumn("buyer_id", F.when((F.col("part_key") % 10 == 0) | (F.col("month") == 2), 5).otherwise(F.lit(20000000001)))
    sound = one.withColumns({"order_no": F.lit(None).cast("string"), "contractor_id": F.lit(None).cast("string"), "amount": F.abs("amount")}).filter(F.col("amount").isNotNull())
    _write_raw(sound, lake.table("raw", "orders"), F.lit(False))
    jobs.ingest(spark, lake, jobs.ORDERS)
    jobs.clean(spark, lake, jobs.ORDERS, maximum=1.0)
    report = commits.require_table(spark, lake, "silver", "quality_report")
    parts = commits.parts_table(spark, lake, "silver", "orders")
    judged = quality.reject_verdicts(stage_table(report, "report"))
    written = quality.written_verdicts(report, parts)
    return judged.join(written, ["year", "month"]).select("year", "month", "n_bronze", "n_input", "n_rejected", "n_silver", "reject_rate", "reject_verdict", "n_written", "written_verdict")


QUERIES = {"publish_roundtrip": publish_roundtrip, "ingest_incremental": ingest_incremental, "cleaned_months": cleaned_months}

_AMOUNT = "CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"

ORACLE = {
    "publish_roundtrip": f"""SELECT year, month, count(*) AS rows, count(*) AS committed_rows, {_AMOUNT} AS amount
        FROM ({binding_sql('feed')}) WHERE month <> 3 AND (month <> 2 OR amount IS NOT NULL) GROUP BY 1, 2""",
    "ingest_incremental": f"""SELECT year, month, count(*) FILTER (WHERE NOT bad) AS n_clean, count(*) FILTER (WHERE bad) AS n_rejected
        FROM (SELECT *, month = 1 OR (line_no = 7 AND month <> 2) AS bad FROM ({binding_sql('feed')}) WHERE month <> 2 OR line_no <= 3) GROUP BY 1, 2""",
    "cleaned_months": f"""SELECT year, month, count(*) AS n_bronze, count(*) AS n_input, count(*) FILTER (WHERE bad) AS n_rejected, count(*) FILTER (WHERE NOT bad) AS n_silver,
          count(*) FILTER (WHERE bad)::DOUBLE / count(*) AS reject_rate, CASE WHEN count(*) FILTER (WHERE bad) * 2 > count(*) THEN 'above the limit' ELSE 'ok' END AS reject_verdict,
          count(*) FILTER (WHERE NOT bad) AS n_written, 'ok' AS written_verdict
        FROM (SELECT *, part_key % 10 = 0 OR month = 2 AS bad FROM ({binding_sql('feed')}) WHERE order_no IS NOT NULL AND line_no = 1 AND amount IS NOT NULL) GROUP BY 1, 2""",
}
