"""Catalog and path tables in parquet (SK7, SK8, SC5, SC6), without a transactional table format."""

from __future__ import annotations

import contextlib

from pyspark.logger import PySparkLogger
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from voltstream import schemas

_ERROR_LOGGERS = ("DataFrameQueryContextLogger", "SQLQueryContextLogger")


@contextlib.contextmanager
def _quiet_probe():
    """Silence PySpark's error-context loggers while an expected miss is probed."""
    loggers = [PySparkLogger.getLogger(n) for n in _ERROR_LOGGERS]
    before = [lg.disabled for lg in loggers]
    for lg in loggers:
        lg.disabled = True
    try:
        yield
    finally:
        for lg, old in zip(loggers, before):
            lg.disabled = old


def folder_exists(spark: SparkSession, path: str) -> bool | None:
    """If there is something at ``path`` on whatever file system it names; None where the session can't tell."""
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))
    except Exception:  # noqa: BLE001 - no JVM at hand (remote session)
        return None


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove scratch folders that nothing reads any more, where the session can."""
    for path in paths:
        if folder_exists(spark, path):
            delete_folder(spark, path)


def read_parquet_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None when nothing has been written there yet.

    Works on any file system Spark can read (no driver-local path checks). A
    missing folder and one without any data file (a first write that died) are
    "nothing written"; any other error is raised, so that an unreadable table
    never passes for an empty one.
    """
    if folder_exists(spark, path) is False:
        return None
    with _quiet_probe():
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise


def ensure_table(spark: SparkSession, name: str, ddl: str, path: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` from a DDL column list, stored as parquet."""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schemas.ddl(ddl)}) USING parquet{location}")


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a parquet table by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
