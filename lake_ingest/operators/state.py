"""Ingestion state: an append-only log of records, read as the latest record per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lake_ingest import schemas
from lake_ingest.constants import DONE_STATUSES
from lake_ingest.functions.documents import with_document
from lake_ingest.operators.tables import (
    BATCH,
    batch_folders,
    drop_folders,
    read_table,
    write_batch,
)


def latest(log: DataFrame, key: str, *newest_first: str | Column) -> DataFrame:
    """The newest row per key.

    Spark cuts each task's input to one row per key before the shuffle (``WindowGroupLimit``), so a key
    with any number of records costs one row per task.
    """
    order = [F.desc(c) if isinstance(c, str) else c for c in newest_first]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return log.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def load_state(spark: SparkSession, table: str, without_batch: str | None = None) -> DataFrame:
    """Latest state record per source key; empty when no state was ever written.

    A batch that is being repeated leaves its own earlier records out by ``without_batch``: it is about
    to replace them, and must find the work it found the first time.
    """
    log = read_table(spark, table, schemas.STATE)
    if without_batch is not None:
        log = log.where(F.col(BATCH) != without_batch)
    return latest(log, "source_key", "processed_at", "proposal_id").drop(BATCH)


def compact_state(spark: SparkSession, table: str, batch_id: str) -> None:
    """Replace all batches of the log by one with the latest record per key.

    The old folders go only after the new one is complete, and until then both say the same, so it may
    be interrupted. It is not to run while an ingestion reads the log.
    """
    old = batch_folders(spark, table)
    if any(folder.endswith(f"={batch_id}") for folder in old):
        raise ValueError(f"batch exists: {batch_id}")
    write_batch(load_state(spark, table), table, batch_id)
    drop_folders(spark, old)


def status_groups(state: DataFrame) -> DataFrame:
    """Number of records per status, marked as done or pending."""
    done = F.col("status").isin(*DONE_STATUSES)
    progress = F.when(F.coalesce(done, F.lit(False)), "done").otherwise("pending")
    return state.groupBy("status", progress.alias("progress")).agg(F.count("*").alias("count"))


def check_documents(documents: DataFrame, body: str) -> DataFrame:
    """State documents with ``version`` and ``error``: each must be an object whose ``processed`` is one."""
    return _parse_documents(documents, body).drop("_state")


def _parse_documents(documents: DataFrame, body: str) -> DataFrame:
    parsed = with_document(documents, body, "_state")
    processed = "try_variant_get(_state, '$.processed', 'variant')"
    entries = "map<string,variant>"
    error = f"""CASE
        WHEN _state IS NULL THEN 'Ingestion state is not valid JSON'
        WHEN try_variant_get(_state, '$', '{entries}') IS NULL THEN 'Ingestion state must be a JSON object'
        WHEN {processed} IS NOT NULL AND try_variant_get(_state, '$.processed', '{entries}') IS NULL
          THEN "Ingestion state 'processed' must be a JSON object" END"""
    version = "if(error IS NULL, coalesce(try_variant_get(_state, '$.version', 'bigint'), 1L), NULL)"
    return parsed.withColumn("error", F.expr(error)).withColumn("version", F.expr(version))


def import_documents(documents: DataFrame, body: str) -> DataFrame:
    """State rows of JSON documents ``{version, processed: {key: record}}``.

    Missing ``processed`` gives no rows, null records are dropped and empty ones kept. A malformed
    document fails the query rather than passing for an empty state.
    """
    entries = """map_filter(
        if(error IS NULL, try_variant_get(_state, '$.processed', 'map<string,variant>'),
           CAST(raise_error(error) AS map<string,variant>)),
        (k, v) -> NOT is_variant_null(v))"""
    record = f"try_variant_get(value, '$', '{schemas.STATE_RECORD}') AS r"
    # explode would add a filter that computes the map a second time.
    return (
        _parse_documents(documents, body)
        .selectExpr("version", f"explode_outer({entries})")
        .where("key IS NOT NULL")
        .selectExpr("version", "key AS source_key", record)
        .select(
            "source_key",
            "version",
            "r.status",
            "r.proposal_id",
            "r.source_bucket",
            "r.etag",
            F.try_to_timestamp("r.processed_at").alias("processed_at"),
            "r.raw_bucket",
            "r.raw_location",
            "r.artifacts",
            "r.target_table",
            "r.dependencies",
            "r.execution_performed",
        )
    )


def record_lines(state: DataFrame) -> DataFrame:
    """One JSON text per record, for export with ``write.text``. No single document is built."""
    return state.selectExpr("to_json(struct(*)) AS value")


def import_state_file(spark: SparkSession, path: str) -> DataFrame:
    """State rows of one JSON state file, such as an earlier system left behind."""
    return import_documents(spark.read.text(path, wholetext=True), "value")
