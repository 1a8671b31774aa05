"""Byte ranges, chunks and read requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from lake_ingest.checks.fixtures import document_listing
from lake_ingest.checks.registry import query, table
from lake_ingest.functions.text import decode_lossy
from lake_ingest.operators import sampling

CHUNK = 8192


@query(
    "read_range",
    """WITH requests AS (
      SELECT page_id, encode(html) AS raw, CAST(octet_length(encode(html)) AS BIGINT) AS size,
             CAST(length(url) * 300 AS BIGINT) AS start_byte,
             greatest(1, least(page_id * 700 - 10000, 65536)) AS max_bytes
      FROM pages),
    read AS (
      SELECT *, octet_length(array_slice(raw, start_byte + 1, start_byte + max_bytes)) AS n FROM requests)
    SELECT page_id, size AS file_size_bytes, start_byte, CAST(max_bytes AS BIGINT) AS max_bytes,
           CAST(n AS BIGINT) AS bytes_read,
           CASE WHEN start_byte >= size THEN size ELSE start_byte + n END AS next_start_byte,
           start_byte + n >= size AS eof,
           md5(array_slice(raw, start_byte + 1, start_byte + max_bytes)) AS content_md5,
           CASE WHEN n > 0 THEN 1 END AS next_read_count
    FROM read""",
)
def read_range(spark, sf_dir):
    """One request per page; many start past the end, and lengths run over both clamps."""
    requests = table(spark, sf_dir, "pages").select(
        "page_id",
        F.lit("").alias("bucket"),
        F.col("url").alias("key"),
        (F.length("url") * 300).cast("bigint").alias("start_byte"),
        (F.col("page_id") * 700 - 10000).alias("max_bytes"),
        F.lit(0).alias("read_count"),
        "html",
    )
    checked = sampling.validate_reads(requests, ["incoming", "lake"], "incoming")
    return sampling.read_table_ranges(checked, "html").select(
        "page_id",
        "file_size_bytes",
        "start_byte",
        "max_bytes",
        "bytes_read",
        "next_start_byte",
        "eof",
        F.md5("content").alias("content_md5"),
        "next_read_count",
    )


def _chunks(spark, sf_dir, name, key, body):
    return sampling.sample_chunks(table(spark, sf_dir, name), key, body, CHUNK)


def _chunk_sql(name, key, body):
    return f"""
    SELECT key, file_size_bytes, CAST(i AS INTEGER) AS read_count, CAST(i * {CHUNK} AS BIGINT) AS start_byte,
           CAST(octet_length(piece) AS BIGINT) AS bytes_read,
           CAST(i * {CHUNK} + octet_length(piece) AS BIGINT) AS next_start_byte,
           i * {CHUNK} + octet_length(piece) >= file_size_bytes AS eof, md5(piece) AS content_md5
    FROM (SELECT key, file_size_bytes, i, array_slice(raw, i * {CHUNK} + 1, (i + 1) * {CHUNK}) AS piece
          FROM (SELECT *, unnest(range(0, greatest(1, least(5, CAST(ceil(file_size_bytes / {CHUNK}.0) AS BIGINT))))) AS i
                FROM (SELECT {key} AS key, encode({body}) AS raw,
                             CAST(octet_length(encode({body})) AS BIGINT) AS file_size_bytes
                      FROM {name})))"""


def _chunk_rows(chunks):
    return chunks.withColumn("content_md5", F.md5("content")).drop("content")


@query("sample_chunks", _chunk_sql("pages", "url", "html"))
def sample_pages(spark, sf_dir):
    return _chunk_rows(_chunks(spark, sf_dir, "pages", "url", "html"))


@query("sample_document_chunks", _chunk_sql("documents", "doc_id", "text"))
def sample_documents(spark, sf_dir):
    return _chunk_rows(_chunks(spark, sf_dir, "documents", "doc_id", "text"))


# A piece of valid UTF-8 is broken at its two ends only: up to three bytes that continue a character
# before it, and up to three that begin one whose rest is missing. Each of the former is one replacement
# character, and the latter together are one.
DECODE_SQL = f"""
WITH objects AS (SELECT url AS key, encode(html) AS raw FROM pages),
pieces AS (
  SELECT key, CAST(i AS INTEGER) AS read_count, array_slice(raw, i * {CHUNK} + 1, (i + 1) * {CHUNK}) AS piece
  FROM (SELECT *, unnest(range(0, greatest(1, least(5, CAST(ceil(octet_length(raw) / {CHUNK}.0) AS BIGINT))))) AS i
        FROM objects)),
digits AS (SELECT *, hex(piece) AS h, octet_length(piece) AS n FROM pieces),
ends AS (
  SELECT *, CASE WHEN NOT regexp_matches(h, '^[89AB]') THEN 0 WHEN NOT regexp_matches(h, '^[89AB].[89AB]') THEN 1
                 WHEN NOT regexp_matches(h, '^[89AB].[89AB].[89AB]') THEN 2 ELSE 3 END AS lead,
         CASE WHEN regexp_matches(h, '[CDEF].$') AND n > 0 THEN 1 WHEN regexp_matches(h, '[EF].[89AB].$') THEN 2
              WHEN regexp_matches(h, 'F.[89AB].[89AB].$') THEN 3 ELSE 0 END AS trail
  FROM digits)
SELECT key, read_count,
       repeat(chr(65533), lead) || decode(unhex(substr(h, 2 * lead + 1, 2 * (n - lead - trail))))
         || CASE WHEN trail > 0 THEN chr(65533) ELSE '' END AS text
FROM ends"""


@query("decode_sample", DECODE_SQL)
def decode_sample(spark, sf_dir):
    """Chunks cut characters in two; both halves show the replacement character."""
    chunks = _chunks(spark, sf_dir, "pages", "url", "html")
    return chunks.select("key", "read_count", decode_lossy("content").alias("text"))


@query(
    "validate_reads",
    """WITH requests AS (
      SELECT event_id, CASE event_type WHEN 'click' THEN '' WHEN 'view' THEN '/abs' ELSE 'events/' || event_id END AS key,
             CAST(json_extract(props, '$.k') AS BIGINT) - 15 AS start_byte, user_id % 9 AS read_count,
             CASE WHEN value < 1 THEN 'other' WHEN value < 3 THEN '' WHEN value < 6 THEN 'lake' ELSE 'incoming' END AS bucket,
             event_id * 10 - 500 AS max_bytes
      FROM events)
    SELECT event_id, CASE bucket WHEN '' THEN 'incoming' ELSE bucket END AS bucket,
           CAST(greatest(1, least(max_bytes, 65536)) AS BIGINT) AS max_bytes,
           CASE WHEN key = '' OR starts_with(key, '/') THEN 'source_key must be a relative object key'
                WHEN start_byte < 0 THEN 'start_byte must be non-negative'
                WHEN read_count > 5 THEN 'a single file can be read max. 5 times. please proceed with the next step in the instructions'
                WHEN bucket = 'other' THEN 'Bucket is not permitted' END AS error
    FROM requests""",
)
def validate_reads(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    requests = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", "")
        .when(kind == "view", "/abs")
        .otherwise(F.concat(F.lit("events/"), F.col("event_id").cast("string")))
        .alias("key"),
        (F.get_json_object("props", "$.k").cast("bigint") - 15).alias("start_byte"),
        (F.col("user_id") % 9).alias("read_count"),
        F.when(value < 1, "other").when(value < 3, "").when(value < 6, "lake").otherwise("incoming").alias("bucket"),
        (F.col("event_id") * 10 - 500).alias("max_bytes"),
    )
    return sampling.validate_reads(requests, ["incoming", "lake"], "incoming").select(
        "event_id", "bucket", "max_bytes", "error"
    )


@query(
    "sample_plan",
    """WITH objects AS (
      SELECT source || '/' || lang || '/' || doc_id || '.txt' AS key,
             CAST(octet_length(encode(text)) AS BIGINT) AS size FROM documents)
    SELECT key, CAST(i AS INTEGER) AS read_count, CAST(i * 8192 AS BIGINT) AS start_byte
    FROM (SELECT key, unnest(range(0, greatest(1, least(5, CAST(ceil(size / 8192.0) AS BIGINT))))) AS i FROM objects)""",
)
def sample_plan(spark, sf_dir):
    """Read requests planned from the listing alone."""
    requests = sampling.sample_requests(document_listing(spark, sf_dir), CHUNK)
    return requests.select("key", "read_count", "start_byte")
