"""Neutral inputs projected from the driver's tables.

Each binding is one SELECT in the dialect Spark and DuckDB share, with the table names
in braces. They only shape test inputs; no operator logic lives here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels"]

# Region spellings of nation 0, 1, ... as a careless source would write them.
PLACES = [
    "Amazonas", "Áncash ", "APURÍMAC", "arequipa", "Ayacucho", " Cajamarca", "Prov. Const. del Callao",
    "Cusco", "Huancavelica", "Huánuco", "Ica", "Junín", "La Libertad", "Lambayeque", "Lima Metropolitana",
    "Loreto", "Madre de Dios", "Moquegua", "Pasco", "Piura", "PUNO ", "San Martín", "Tacna",
    "NO DISPONIBLE", "Ucayalí",
]
# The revenue source adds roll-up rows and splits the capital.
REVENUE_PLACES = PLACES[:20] + [" Lima ", "Total", "Lima Provincias", "Provincia Constitucional del Callao", "Ucayali"]


def _place(key: str, names: list[str]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names))
    return f"CASE {key} {cases} END"


def _entity(key: str) -> str:
    return f"(10000000000 * (1 + {key} % 2) + {key})"


def _snapshot(year: int, month: int, shift: int) -> str:
    return f"""
    SELECT {_entity('c_custkey')} AS entity_id,
      CASE WHEN (c_custkey + {shift}) % 7 = 3 THEN 'BAJA DE OFICIO' ELSE 'ACTIVO' END AS status,
      CASE c_custkey % 5 WHEN 0 THEN 'NO HABIDO' WHEN 1 THEN ' no hallado ' ELSE 'HABIDO' END AS condition,
      CASE c_mktsegment WHEN 'BUILDING' THEN ' SOCIEDAD ANONIMA ' WHEN 'AUTOMOBILE' THEN 'PERSONA NATURAL CON NEGOCIO'
        WHEN 'MACHINERY' THEN 'SOCIEDAD IRREGULAR' WHEN 'HOUSEHOLD' THEN 'PERSONA NATURAL SIN NEGOCIO' END AS entity_type,
      CASE WHEN c_custkey % 17 <> 0 THEN 'C' || CAST(c_custkey % 40 AS STRING) END AS activity,
      CASE c_custkey % 4 WHEN 0 THEN 'S1' WHEN 1 THEN '  ' END AS activity_secondary,
      CASE WHEN c_acctbal < 0 THEN 'NO DISPONIBLE' WHEN (c_custkey + {shift}) % 6 = 0 THEN '0'
        ELSE CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS STRING) END AS workers_text,
      CASE c_custkey % 3 WHEN 0 THEN ' MANUAL ' WHEN 1 THEN 'COMPUTARIZADO' END AS billing_mode,
      CASE c_custkey % 4 WHEN 0 THEN 'MANUAL ' ELSE 'COMPUTARIZADO' END AS accounting_mode,
      {_place('n_nationkey', PLACES)} AS region,
      CAST({year} AS INT) AS year, CAST({month} AS INT) AS month
    FROM {{customer}} JOIN {{nation}} ON n_nationkey = c_nationkey"""


BINDINGS = {
    "registry": f"{_snapshot(2001, 3, 0)} UNION ALL {_snapshot(2001, 6, 2)}",
    "snapshots": f"""
    SELECT {_entity('o_custkey')} AS entity_id,
      CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
      CASE WHEN o_orderstatus = 'P' AND o_orderkey % 9 = 0 THEN 'BAJA' ELSE 'ACTIVO ' END AS status,
      CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 5 = 0 THEN 'MANUAL' WHEN o_custkey % 11 = 0 THEN NULL
        ELSE ' COMPUTARIZADO' END AS billing_mode
    FROM {{orders}}""",
    "feed": f"""
    SELECT CASE WHEN o_orderkey % 50 <> 0 THEN 'OC-' || CAST(o_orderkey AS STRING) END AS order_no,
      CASE WHEN l_suppkey % 41 = 0 THEN NULL WHEN l_suppkey % 43 = 0 THEN l_suppkey
        ELSE 20000000000 + l_suppkey END AS buyer_id,
      CASE WHEN l_suppkey % 82 = 0 THEN 'Buyer ' || CAST(l_suppkey AS STRING) END AS buyer_name,
      CASE WHEN o_custkey % 53 = 0 THEN NULL WHEN o_custkey % 59 = 0 THEN CAST(10000000 + o_custkey AS STRING)
        ELSE CAST({_entity('o_custkey')} AS STRING) END AS contractor_id,
      CASE WHEN l_linenumber = 7 AND l_quantity < 10 THEN NULL WHEN l_discount > 0.095 THEN -l_extendedprice
        ELSE l_extendedprice END AS amount,
      CASE WHEN l_linestatus = 'O' THEN 'Nuevos Soles' WHEN l_quantity < 25 THEN 'Dolares' END AS currency,
      CASE l_returnflag WHEN 'R' THEN 'Anulada' WHEN 'A' THEN 'Vigente' END AS order_status,
      CAST(o_orderdate AS DATE) AS issue_date,
      CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month,
      l_partkey AS part_key, l_linenumber AS line_no
    FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey""",
    "affiliations": f"""
    SELECT {_entity('user_id')} AS entity_id,
      CASE WHEN user_id % 9 = 4 THEN 'recibo por honorarios' WHEN event_type = 'view' THEN 'factura portal'
        WHEN event_type = 'click' AND user_id % 2 = 0 THEN 'boleta portal' WHEN event_type = 'error' THEN 'recibo por honorarios'
        WHEN event_type = 'signup' AND user_id % 3 = 0 THEN 'desde los sistemas del contribuyente' ELSE 'otros' END AS voucher_type,
      CASE WHEN event_id % 97 <> 0 THEN CAST(ts AS DATE) - 8340 END AS start_date
    FROM {{events}}""",
    "exclusions": f"SELECT {_entity('c_custkey')} AS entity_id FROM {{customer}} WHERE c_acctbal > 9000",
    "register": f"""
    SELECT {_entity('o_custkey')} AS entity_id, CAST(max(o_orderdate) AS DATE) AS issue_date,
      CASE WHEN o_custkey % 4 <> 0 THEN CAST(max(o_orderdate) AS DATE) + 20 END AS firm_date,
      CAST(max(o_orderdate) AS DATE) + 3 AS publication_date,
      CASE WHEN o_custkey % 3 = 0 THEN 'R' || CAST(o_custkey % 20 AS STRING) END AS representative,
      TRUE AS positive
    FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey
    WHERE c_acctbal > 8000 AND c_acctbal < 9400 GROUP BY o_custkey""",
    "survey": """
    SELECT s_nationkey + 1 AS code, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 2 END AS employed,
      CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 END AS informal, l_quantity AS weight
    FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey""",
    "revenue": f"""
    SELECT {_place('n_nationkey', REVENUE_PLACES)} AS region, CAST(year(o_orderdate) AS BIGINT) AS year,
      o_totalprice AS amount
    FROM {{orders}} JOIN {{customer}} ON c_custkey = o_custkey JOIN {{nation}} ON n_nationkey = c_nationkey""",
    "preds": """
    SELECT CASE d.doc_id % 5 WHEN 0 THEN 'risk-run-E1-lr-v2-w1' WHEN 1 THEN 'risk-run-E2-dt-v2-w1'
        WHEN 2 THEN 'risk-run-E3-lr-v1-w1' WHEN 3 THEN 'risk-run-E1-lr-v2-w1-b' ELSE 'adhoc' END AS run_id,
      CASE WHEN source IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src15', 'src16', 'src17', 'src18', 'src19')
        THEN 'test' ELSE 'train' END AS split,
      10000000000 * (1 + d.doc_id % 2) + d.doc_id AS id,
      least(n_chars, 20000) AS points,
      CASE WHEN n_chars >= 20000 THEN CAST(1 AS DOUBLE) ELSE CAST(n_chars AS DOUBLE) / 20011 END AS score,
      coalesce(toxic, 0) AS label,
      CASE WHEN n_chars % 13 = 0 THEN NULL WHEN lang = 'en' THEN 'LIMA' WHEN lang = 'es' THEN 'CALLAO'
        WHEN lang = 'fr' THEN ' Cusco' ELSE 'PUNO' END AS region,
      CASE WHEN n_chars % 17 = 0 THEN NULL WHEN coalesce(quality, 0) = 1 THEN 0 ELSE 1 END AS has_contracts
    FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
}
BINDINGS["runs"] = f"""
    SELECT run_id,
      CASE WHEN run_id LIKE '%-dt-%' THEN 'DT' ELSE 'LR' END AS model_name,
      CASE WHEN run_id LIKE '%-v1-%' THEN 'V1' ELSE 'V2' END AS variant,
      CASE WHEN run_id LIKE '%E1%' THEN 'v1' WHEN run_id LIKE '%E2%' THEN 'v2' ELSE 'v3' END AS dataset_version,
      CASE WHEN run_id LIKE '%-b' THEN '2026-02-01T00:00:00' ELSE '2026-01-01T00:00:00' END AS run_date,
      run_id LIKE '%-w1%' AS weighted,
      count(CASE WHEN split = 'train' THEN 1 END) AS n_train, count(CASE WHEN split = 'test' THEN 1 END) AS n_test,
      CAST(sum(CASE WHEN split = 'train' THEN label ELSE 0 END) AS BIGINT) AS n_positives_train,
      CAST(sum(CASE WHEN split = 'test' THEN label ELSE 0 END) AS BIGINT) AS n_positives_test,
      CASE WHEN run_id LIKE '%-b' THEN NULL ELSE avg(points) / 20000 END AS cv_recall,
      avg(CASE WHEN label = 0 THEN points END) / 20000 AS cv_mean,
      avg(CASE WHEN split = 'train' THEN points END) / 20000 AS train_score,
      {", ".join(f"avg(CASE WHEN points % 5 = {k} THEN points END) / 20000 AS fold_{k}" for k in range(5))},
      CAST(sum(points) AS DOUBLE) / 1000 AS seconds
    FROM ({BINDINGS['preds']}) p GROUP BY run_id"""


_SCHEMAS: dict[str, StructType] = {}
_ROWS: dict[str, int] = {}

# Both sides of a large join go to tasks of about as many rows of the larger one. Spark sizes tasks by compressed bytes,
# and a few sorted numbers a row shrink so much that one task would sort millions of rows.
JOIN_KEYS = {"feed": {"orders": "o_orderkey", "lineitem": "l_orderkey"}}
TASK_ROWS = 1_000_000
# Rows up to which Spark's own sizes serve: there it may send the smaller side to all tasks and exchange nothing.
SPREAD_FROM = 24_000_000


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A driver table. Its schema is read once per process, not at every use."""
    path = f"{folder}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _rows(spark: SparkSession, folder: str, table: str) -> int:
    """Rows of a driver table, from its footers once per process; they only decide the number of tasks."""
    path = f"{folder}/{table}.parquet"
    if path not in _ROWS:
        _ROWS[path] = load(spark, folder, table).count()
    return _ROWS[path]


def _select(text: str, spark: SparkSession, folder: str, **spread: DataFrame) -> DataFrame:
    used = {t: load(spark, folder, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used | spread)


def bind(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A neutral input as a lazy DataFrame over the Parquet tables of `folder`."""
    return _select(BINDINGS[name], spark, folder)


def bind_spread(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same input, a large join of which is dealt to tasks by rows; not for what is written by month as it
    comes, since every task then leaves a file a month."""
    keys = JOIN_KEYS[name]
    most = max(_rows(spark, folder, t) for t in keys)
    if most <= SPREAD_FROM:
        return bind(spark, folder, name)
    spread = {t: load(spark, folder, t).repartition(most // TASK_ROWS + 1, key) for t, key in keys.items()}
    return _select(BINDINGS[name], spark, folder, **spread)


def binding_sql(name: str) -> str:
    """The same input as a DuckDB sub-select over the tables of the same names."""
    return BINDINGS[name].format(**{t: t for t in TABLES})


def run_records(spark: SparkSession, folder: str) -> DataFrame:
    """The runs binding in the nested shape of the run-record files."""
    flat = bind(spark, folder, "runs")
    cv = F.struct(
        F.col("cv_mean").alias("cv_pr_auc_mean"),
        F.lit(None).cast("double").alias("cv_pr_auc_std"),
        F.array(*[f"fold_{k}" for k in range(5)]).alias("cv_pr_auc_folds"),
        F.col("train_score").alias("train_pr_auc"),
        F.col("cv_recall").alias("cv_recall_1pct_mean"),
        F.lit(None).cast("double").alias("cv_recall_1pct_std"),
    )
    return flat.select(
        "run_id",
        F.col("run_date").alias("fecha"),
        "dataset_version",
        "variant",
        "model_name",
        F.col("weighted").alias("usa_pesos"),
        "n_train",
        "n_test",
        F.col("n_positives_train").alias("n_positivos_train"),
        F.col("n_positives_test").alias("n_positivos_test"),
        F.col("seconds").alias("segundos_entrenamiento"),
        cv.alias("metricas_cv"),
    )
