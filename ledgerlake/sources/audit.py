"""Audit log of pipeline steps (append-only, day-partitioned by start date)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import PIPELINE_RUNS


def audit_row(spark: SparkSession, *, run_id: str, pipeline_name: str, step: str, status: str,
              rows_processed: int | None, started_at: dt.datetime, finished_at: dt.datetime | None,
              rows_failed: int | None = 0, error_message: str | None = None,
              triggered_by: str = "manual", git_commit_sha: str | None = None) -> DataFrame:
    """One audit row with the fixed schema, real start and finish times."""
    row = (run_id, pipeline_name, step, status, rows_processed, rows_failed, started_at, finished_at,
           error_message, triggered_by, git_commit_sha)
    return spark.createDataFrame([row], PIPELINE_RUNS)


def append_audit(rows: DataFrame, path: str) -> None:
    """Append to the audit table, partitioned by the start day."""
    (rows.withColumn("started_date", F.to_date("started_at"))
     .write.mode("append").partitionBy("started_date").parquet(path))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
