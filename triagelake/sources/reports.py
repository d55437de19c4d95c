"""Report and reply sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _task_from_path(path: Column) -> Column:
    """Analysis folder of ``.../<task>/reports/<file>.json``, else the file name."""
    folder = F.regexp_extract(path, r"([^/]+)/reports/[^/]+$", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(path, r"([^/]+?)(?:\.[A-Za-z0-9]+)?$", 1))


def read_reports(spark: SparkSession, path: str, pattern: str = "report.json") -> DataFrame:
    """``task_id, raw`` from a folder tree with one report per file; other JSON files beside the reports are left alone."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=pattern)
    return files.select(_task_from_path(F.col("_metadata.file_path")).alias("task_id"), F.col("value").alias("raw"))


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """``task_id, raw`` from JSON lines, which suits large collections better than one file per report."""
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", "$.info.id").alias("task_id"), F.col("value").alias("raw"))


def from_table(rows: DataFrame, task_id: str, raw: str) -> DataFrame:
    """``task_id, raw`` from any table that holds report text."""
    return rows.select(F.col(task_id).cast("string").alias("task_id"), F.col(raw).alias("raw"))


def keyed(reports: DataFrame) -> DataFrame:
    """Name reports that have no task id by a checksum of their text, so that no key is NULL and none is shared by chance."""
    name = F.concat(F.lit("sha256:"), F.sha2(F.coalesce("raw", F.lit("")), 256))
    return reports.withColumn("task_id", F.coalesce("task_id", name))
