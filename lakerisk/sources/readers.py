"""Readers: raw CSV, layer tables, optional tables, narrow CSV and run records."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.sources.schemas import RUN_RECORD_DDL

CORRUPT = "_corrupt_record"


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header that must equal the schema; unreadable rows keep their raw text."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .options(header=True, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=CORRUPT)
        .csv(path)
    )


def read_narrow_csv(spark: SparkSession, path: str, columns: Iterable[str], types: str | None = None) -> DataFrame:
    """Only the named columns of a CSV; all text unless `types` (a DDL string) is given."""
    columns = list(columns)
    raw = spark.read.option("header", True).csv(path).select(*columns)
    if types is None:
        return raw
    wanted = T.StructType.fromDDL(types)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet table that may not exist yet; any other failure is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def written_rows(spark: SparkSession, path: str) -> int:
    """Rows found on reading a written table back; 0 when it does not exist."""
    table = read_optional(spark, path)
    return 0 if table is None else table.count()


def read_run_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) run records of an NDJSON folder.

    A record is valid when run id, model, variant, dataset version and the mean
    cross-validation score are present; the others keep the reasons and the raw text.
    """
    records = (
        spark.read.schema(f"{RUN_RECORD_DDL}, {CORRUPT} string")
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        .json(path)
    )
    return split_run_records(records)


def split_run_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    needed = ["run_id", "model_name", "variant", "dataset_version", "metricas_cv"]
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in needed]
    missing.append(
        F.when(
            F.col("metricas_cv").isNotNull() & F.col("metricas_cv.cv_pr_auc_mean").isNull(),
            F.lit("missing metricas_cv.cv_pr_auc_mean"),
        )
    )
    if CORRUPT in records.columns:
        missing.insert(0, F.when(F.col(CORRUPT).isNotNull(), F.lit("unreadable json")))
    judged = records.withColumn("errors", F.concat_ws(";", *missing))
    valid = judged.filter(F.col("errors") == "").drop("errors", CORRUPT)
    return valid, judged.filter(F.col("errors") != "")
