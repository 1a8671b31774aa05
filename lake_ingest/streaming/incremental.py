"""Incremental ingestion of newly arriving files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from lake_ingest.operators.tables import BATCH, batch_folders, path_exists, write_batch
from lake_ingest.plans.lake import Lake
from lake_ingest.plans.save_batch import PROPOSAL_COLUMNS, save_batch


def stream_files(
    spark: SparkSession,
    source_dir: str,
    fmt: str,
    schema: T.StructType | str,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Hand all files not seen before to ``sink(rows, batch_id)``, then stop.

    Spark knows a file by its path: one whose content changed is not read again. Such files are found
    by ``operators.discovery.discover`` over a fingerprinted listing. The option ``maxFilesPerTrigger``
    cuts a long backlog into several batches.
    """
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .options(**(options or {}))
        .load(source_dir)
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_new_files(
    spark: SparkSession,
    source_dir: str,
    fmt: str,
    schema: T.StructType | str,
    target: str,
    checkpoint: str,
    conform: Callable[[DataFrame], DataFrame] | None = None,
    options: Mapping[str, str] | None = None,
    stream_name: str = "stream",
) -> StreamingQuery:
    """Write new files' rows to the Parquet table ``target``.

    Each batch owns the folder ``batch_id=<stream_name>-<n>`` and overwrites it, so a batch that is
    repeated after a lost driver leaves its rows once, and streams of different names may share a
    target. A checkpoint that does not exist yet would number its batches anew over those of an earlier
    run of the stream, so it is refused where the stream's folders exist.
    """
    prefix = f"/{BATCH}={stream_name}-"
    if not path_exists(spark, checkpoint) and any(prefix in f for f in batch_folders(spark, target)):
        raise ValueError(f"{target} has batches of stream {stream_name!r}, but {checkpoint} does not exist")

    def write(rows: DataFrame, batch_id: int) -> None:
        write_batch(conform(rows) if conform else rows, target, f"{stream_name}-{batch_id}")

    return stream_files(spark, source_dir, fmt, schema, checkpoint, write, options)


def save_new_proposals(
    spark: SparkSession,
    lake: Lake,
    proposals_dir: str,
    listing: Callable[[], DataFrame],
    read_parts: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    stream_name: str = "proposals",
) -> StreamingQuery:
    """Save proposals as their JSON Lines files arrive, each batch as one ``save_batch`` run.

    ``listing`` is called per batch, for the sources as they are then.
    """

    def save(rows: DataFrame, batch_id: int) -> None:
        run_id = f"{stream_name}-{batch_id}"
        save_batch(
            spark, lake, rows, listing(), read_parts, run_id, datetime.now(timezone.utc)
        )

    schema = T.StructType([T.StructField(c, T.StringType()) for c in PROPOSAL_COLUMNS])
    return stream_files(spark, proposals_dir, "json", schema, checkpoint, save)
