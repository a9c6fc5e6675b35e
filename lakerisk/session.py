"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Sizes of shuffle partitions and broadcasts are left
# to AQE, which measures them at run time; nothing in the package forces a broadcast.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the job settings; `extra` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    A checkpoint folder set on the context counts as well. Only when there is none
    (tests, a laptop) a fresh local folder is made and recorded in the session, so
    later calls agree on it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/lakerisk/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under this application's part of the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write `df` to the shared folder and read it back.

    This cuts the lineage with a durable table: a lost executor only costs a re-read,
    values that depend on the physical layout (partition numbers) stay fixed, and
    later scans still prune columns, which an RDD checkpoint cannot do.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_path = path
    return staged


def _delete(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def drop_staged(*tables: DataFrame) -> None:
    """Remove tables that `stage_table` returned, once all that reads them is stored itself.

    Shared disk then holds what is still needed and not every step of a long job. Other tables
    (a plain scan, a table derived from a staged one) are left alone.
    """
    for table in tables:
        if path := vars(table).get("_staged_path"):
            _delete(table.sparkSession, path)


def drop_scratch(spark: SparkSession) -> bool:
    """Remove the tables this application has staged; call it once results are written.

    Other applications keep theirs.
    """
    return _delete(spark, _own_folder(spark))
