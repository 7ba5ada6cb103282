"""The append-only log of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.operators.reports import run_record


def append_run(
    citizens: DataFrame, path: str, run_ts: str, status: str = "success", run_id: str | None = None,
    seconds: float | None = None,
) -> None:
    run_record(citizens, run_ts, status, run_id, seconds).write.mode("append").parquet(path)


def run_history(spark: SparkSession, path: str) -> DataFrame:
    """Runs, latest first."""
    return spark.read.parquet(path).orderBy("run_date", ascending=False)
