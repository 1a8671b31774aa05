"""Rows of the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lake_ingest import schemas

NOT_EXECUTED = "NOT EXECUTED"
SUCCEEDED = "SUCCESS"
FAILED = "FAILED"


def run_row(
    spark: SparkSession,
    run_id: str,
    target_table: str,
    status: str,
    started_at: datetime,
    finished_at: datetime,
    *,
    source_key: str | None = None,
    rows_in: int | None = None,
    rows_written: int | None = None,
    rows_rejected: int | None = None,
    message: str | None = None,
) -> DataFrame:
    """One executed run."""
    row = (
        run_id,
        source_key,
        target_table,
        status,
        rows_in,
        rows_written,
        rows_rejected,
        started_at,
        finished_at,
        message,
    )
    return spark.createDataFrame([row], schemas.RUN_LOG)


def not_executed_rows(saves: DataFrame, saved_at: datetime) -> DataFrame:
    """One row per save ``(ingestion_id, source_key, target_table)``, which nobody has executed yet."""
    return saves.select(
        F.col("ingestion_id").alias("run_id"),
        "source_key",
        "target_table",
        F.lit(NOT_EXECUTED).alias("status"),
        *[F.expr(f"CAST(NULL AS bigint) AS {c}") for c in ("rows_in", "rows_written", "rows_rejected")],
        F.expr("CAST(NULL AS timestamp) AS started_at"),
        F.lit(saved_at).alias("finished_at"),
        F.lit("The source loader was generated and saved for review.").alias("message"),
    )
