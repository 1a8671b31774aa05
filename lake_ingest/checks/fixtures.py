"""Inputs derived from the given tables, in Spark and, as CTE texts, in DuckDB SQL.

``documents`` are the incoming objects and ``labels`` say which of them were ingested before, and how
that went; ``pages`` serve where bodies of many bytes and awkward keys are wanted.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lake_ingest.checks.registry import table
from lake_ingest.operators.listing import table_listing
from lake_ingest.sources.store import join, open_store

DOCUMENT_KEY = "concat(source, '/', lang, '/', doc_id, '.txt')"


def document_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    modified = F.expr(
        "cast('2024-01-01 00:00:00' AS timestamp_ntz) + make_dt_interval(0, 0, 0, n_chars)"
    )
    documents = table(spark, sf_dir, "documents").withColumn("key", F.expr(DOCUMENT_KEY))
    return table_listing(documents, "key", "text", last_modified=modified)


SQL_DOCUMENT_LISTING = """
objects AS (
  SELECT source || '/' || lang || '/' || doc_id || '.txt' AS key, 'incoming' AS bucket,
         CAST(octet_length(encode(text)) AS BIGINT) AS size, md5(text) AS etag,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n_chars) AS last_modified, doc_id
  FROM documents)"""


def document_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier records: done, done with other content, or failed, by the two label values."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(DOCUMENT_KEY).alias("source_key"), F.md5("text").alias("etag")
    )
    labels = table(spark, sf_dir, "labels")
    status = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 1), "failed")
        .when((F.col("quality") == 0) & (F.col("toxic") == 0), "artifacts_saved")
        .otherwise("success")
    )
    stale = (F.col("quality") == 0) & (F.col("toxic") == 1)
    return documents.join(labels, "doc_id").select(
        "source_key", status.alias("status"), F.when(stale, "stale").otherwise(F.col("etag")).alias("etag")
    )


SQL_DOCUMENT_STATE = """
state AS (
  SELECT o.key AS source_key,
         CASE WHEN quality = 1 AND toxic = 1 THEN 'failed'
              WHEN quality = 0 AND toxic = 0 THEN 'artifacts_saved' ELSE 'success' END AS status,
         CASE WHEN quality = 0 AND toxic = 1 THEN 'stale' ELSE o.etag END AS etag
  FROM labels l JOIN objects o ON o.doc_id = l.doc_id)"""


SQL_DISCOVERED = f"""{SQL_DOCUMENT_LISTING}, {SQL_DOCUMENT_STATE},
discovered AS (
  SELECT o.key, o.bucket, o.size, o.etag, o.last_modified,
         s.source_key IS NOT NULL AS previously_seen, s.status AS previous_status
  FROM objects o LEFT JOIN state s ON s.source_key = o.key
  WHERE NOT coalesce(s.status IN ('success', 'artifacts_saved') AND s.etag = o.etag, FALSE))"""


def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_listing(table(spark, sf_dir, "pages"), "url", "html")


SQL_PAGE_LISTING = """
objects AS (
  SELECT url AS key, 'incoming' AS bucket, CAST(octet_length(encode(html)) AS BIGINT) AS size,
         md5(html) AS etag, page_id
  FROM pages)"""


def write_objects(objects: DataFrame, root: str) -> None:
    """Write rows ``(key, content)`` as files below a folder the executors share."""

    def write(batches):
        store, base = open_store(root)
        for batch in batches:
            for row in batch.to_pylist():
                path = join(base, row["key"])
                store.create_dir(path.rpartition("/")[0], recursive=True)
                with store.open_output_stream(path) as file:
                    file.write(row["content"])
            yield pa.RecordBatch.from_pydict({"written": [batch.num_rows]})

    rows = objects.select("key", F.col("content").cast("binary").alias("content"))
    rows.mapInArrow(write, "written bigint").agg(F.sum("written")).collect()


def remove_objects(objects: DataFrame, root: str) -> None:
    """Remove the files of rows ``key`` below a folder the executors share."""

    def remove(batches):
        store, base = open_store(root)
        for batch in batches:
            for key in batch["key"].to_pylist():
                store.delete_file(join(base, key))
            yield pa.RecordBatch.from_pydict({"removed": [batch.num_rows]})

    objects.select("key").mapInArrow(remove, "removed bigint").agg(F.sum("removed")).collect()
