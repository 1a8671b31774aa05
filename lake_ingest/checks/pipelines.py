"""Sources, sinks and whole pipelines. These queries write to a scratch folder and read back."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import functions as F

from lake_ingest import schemas
from lake_ingest.checks.conforming import LINEITEM
from lake_ingest.checks.fixtures import (
    DOCUMENT_KEY,
    SQL_DOCUMENT_LISTING,
    document_listing,
    remove_objects,
    write_objects,
)
from lake_ingest.checks.registry import query, scratch, table
from lake_ingest.checks.validation import SQL_DESTINATIONS, page_saves
from lake_ingest.operators import artifacts
from lake_ingest.operators.conform import convert_types
from lake_ingest.operators.discovery import discover
from lake_ingest.operators.listing import (
    combine_part_hashes,
    content_etag,
    fingerprint,
    fingerprint_changed,
    list_objects,
    split_into_parts,
    spread,
    table_listing,
)
from lake_ingest.operators.sampling import read_ranges, sample_files, validate_reads
from lake_ingest.operators.sink import create_or_append, register_views
from lake_ingest.operators.state import load_state
from lake_ingest.operators.tables import read_batch, read_table, write_batch
from lake_ingest.operators.validate import check_dataset
from lake_ingest.plans.lake import Lake
from lake_ingest.plans.run_ingestion import ingest_objects, run_ingestion, run_saved
from lake_ingest.plans.save_batch import save_batch
from lake_ingest.sources.json_arrays import array_elements
from lake_ingest.sources.loaders import load_source, register_loader
from lake_ingest.sources.store import join, open_store, read_range, store_options
from lake_ingest.streaming.changes import CHANGES, stream_changes
from lake_ingest.streaming.incremental import ingest_new_files

WHEN = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _table_name(prefix):
    return f"{prefix}_{uuid.uuid4().hex}"


@query(
    "load_json",
    """SELECT event_id, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def load_json(spark, sf_dir):
    """Events as JSON Lines files, read by the loader for their ending."""
    path = f"{scratch(spark)}/events.jsonl"
    events = table(spark, sf_dir, "events")
    props = F.from_json("props", "k bigint").alias("props")
    events.select("event_id", "user_id", "event_type", "value", props).write.json(path)
    return load_source(spark, path).select("event_id", "user_id", "event_type", "value", "props.k")


@query(
    "load_formats",
    """SELECT format, l.* FROM lineitem l, (VALUES ('csv'), ('orc'), ('parquet')) f(format)""",
)
def load_formats(spark, sf_dir):
    """Order lines written in each format, loaded and brought to the declared types."""
    lines, root = table(spark, sf_dir, "lineitem"), scratch(spark)
    loaded = []
    for fmt in ("csv", "orc", "parquet"):
        path = f"{root}/lines.{fmt}"
        writer = lines.write.format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(path)
        rows = convert_types(load_source(spark, path), LINEITEM)
        loaded.append(rows.withColumn("format", F.lit(fmt)))
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


@query(
    "load_text",
    """SELECT unnest(string_split(replace(text, chr(13), ''), chr(10))) AS value FROM conversations""",
)
def load_text(spark, sf_dir):
    """Turns as text files, read line by line."""
    path = f"{scratch(spark)}/turns.txt"
    turns = table(spark, sf_dir, "conversations").select(F.replace("text", F.lit("\r"), F.lit("")))
    turns.write.text(path)
    return load_source(spark, path)


def _page_files(spark, sf_dir):
    """Pages as files of their own, in a folder per language, and the listing of these files."""
    root = scratch(spark)
    language = F.regexp_extract("url", r"\Ahttps?://[^/]+/(\w+)", 1)
    key = F.concat(language, F.lit("/"), F.col("page_id").cast("string"), F.lit(".html"))
    pages = table(spark, sf_dir, "pages").select(key.alias("key"), F.col("html").alias("content"))
    write_objects(pages, root)
    return root, list_objects(spark, root)


SQL_PAGE_FILES = r"""
files AS (
  SELECT regexp_extract(url, '^https?://[^/]+/(\w+)', 1) || '/' || page_id || '.html' AS key, encode(html) AS raw
  FROM pages)"""


@query(
    "list_files",
    f"""WITH {SQL_PAGE_FILES}
    SELECT key, 'incoming' AS bucket, CAST(octet_length(raw) AS BIGINT) AS size FROM files""",
)
def list_files(spark, sf_dir):
    _, listing = _page_files(spark, sf_dir)
    return listing.select("key", "bucket", "size")


@query(
    "fingerprint_files",
    f"""WITH {SQL_PAGE_FILES},
    parts AS (
      SELECT key, octet_length(raw) AS size, i, md5(array_slice(raw, i * 4096 + 1, (i + 1) * 4096)) AS digest
      FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil(octet_length(raw) / 4096.0) AS BIGINT)))) AS i FROM files))
    SELECT key, CAST(max(size) AS BIGINT) AS size,
           CASE WHEN count(*) = 1 THEN max(digest)
                ELSE md5(unhex(string_agg(digest, '' ORDER BY i))) || '-' || count(*) END AS etag
    FROM parts GROUP BY key""",
)
def fingerprint_files(spark, sf_dir):
    """Files hashed in parts of 4 KiB, each part by whichever task gets it."""
    root, listing = _page_files(spark, sf_dir)
    return fingerprint(listing, root, smallest=4096).select("key", "size", "etag")


@query(
    "fingerprint_blocks",
    f"""WITH {SQL_PAGE_FILES},
    parts AS (
      SELECT key, i, md5(array_slice(raw, i * 512 + 1, (i + 1) * 512)) AS digest
      FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil(octet_length(raw) / 512.0) AS BIGINT)))) AS i FROM files)),
    blocks AS (
      SELECT key, i // 4 AS b, count(*) AS n,
             CASE WHEN count(*) = 1 THEN max(digest) ELSE md5(unhex(string_agg(digest, '' ORDER BY i))) END AS digest
      FROM parts GROUP BY ALL),
    whole AS (
      SELECT key, CASE WHEN sum(n) = 1 THEN max(digest) WHEN count(*) = 1 THEN max(digest) || '-' || sum(n)
             ELSE md5(unhex(string_agg(digest, '' ORDER BY b))) || '-' || sum(n) END AS etag
      FROM blocks GROUP BY key)
    SELECT key, etag, TRUE AS same_as_column, TRUE AS same_as_copy FROM whole""",
)
def fingerprint_blocks(spark, sf_dir):
    """Files of more parts than one block of digests holds: as file, as column and as stored copy."""
    root, listing = _page_files(spark, sf_dir)
    files = fingerprint(listing, root, smallest=512, block_parts=4).select("key", "etag")
    language = F.regexp_extract("url", r"\Ahttps?://[^/]+/(\w+)", 1)
    name = F.concat(language, F.lit("/"), F.col("page_id").cast("string"), F.lit(".html"))
    contents = table(spark, sf_dir, "pages").select(name.alias("key"), F.col("html").cast("binary").alias("content"))
    columns = contents.select("key", content_etag("content", 512, 4).alias("of_column"))
    saves = listing.select(
        F.col("key").alias("ingestion_id"), F.col("key").alias("source_key"), F.lit("raw/").alias("raw_location"), "size"
    )
    copies = combine_part_hashes(artifacts.file_parts(root, 512)(saves), ["ingestion_id"], block_parts=4).select(
        F.col("ingestion_id").alias("key"), F.col("etag").alias("of_copy")
    )
    return files.join(columns, "key").join(copies, "key").select(
        "key", "etag",
        (F.col("of_column") == F.col("etag")).alias("same_as_column"),
        (F.col("of_copy") == F.col("etag")).alias("same_as_copy"),
    )


@query(
    "read_buckets",
    f"""WITH {SQL_PAGE_FILES},
    stored AS (SELECT key, 'incoming' AS bucket, raw FROM files
               UNION ALL SELECT key, 'lake', encode('copy of ' || key) FROM files),
    requests AS (SELECT * FROM stored UNION ALL SELECT key, 'other', NULL FROM files
                 UNION ALL SELECT '../' || key, 'lake', NULL FROM files)
    SELECT key, bucket, CAST(octet_length(raw) AS BIGINT) AS file_size_bytes,
           md5(array_slice(raw, 1, 2048)) AS content_md5,
           CASE WHEN bucket = 'other' THEN 'Bucket is not permitted'
                WHEN starts_with(key, '..') THEN 'source_key must be a relative object key' END AS error,
           CASE WHEN bucket = 'other' THEN 'incoming,lake' END AS allowed_buckets
    FROM requests""",
)
def read_buckets(spark, sf_dir):
    """The same key in two buckets, in a bucket that is not served, and one that climbs out of its bucket."""
    root, listing = _page_files(spark, sf_dir)
    other = scratch(spark)
    keys = listing.select("key")
    write_objects(keys.withColumn("content", F.concat(F.lit("copy of "), "key")), other)
    requests = keys.select("key", F.explode(F.array(*map(F.lit, ("incoming", "lake", "other")))).alias("bucket"))
    requests = requests.unionByName(keys.select(F.concat(F.lit("../"), "key").alias("key"), F.lit("lake").alias("bucket")))
    requests = requests.select("*", F.lit(0).alias("start_byte"), F.lit(2048).alias("max_bytes"), F.lit(0).alias("read_count"))
    checked = validate_reads(requests, ["lake", "incoming"], "incoming")
    return read_ranges(checked, {"incoming": root, "lake": other}).select(
        "key", "bucket", "file_size_bytes", F.md5("content").alias("content_md5"), "error",
        F.array_join("allowed_buckets", ",").alias("allowed_buckets"),
    )


@query(
    "fingerprint_changed",
    f"""WITH {SQL_PAGE_FILES}
    SELECT key, CAST(octet_length(raw) AS BIGINT) AS size,
           CASE WHEN starts_with(key, 'en/') THEN 'kept ' || key ELSE md5(raw) END AS etag FROM files""",
)
def fingerprint_edited(spark, sf_dir):
    """The state knows size and time of the English pages' files, so only the others are read."""
    root, listing = _page_files(spark, sf_dir)
    known = listing.where("key LIKE 'en/%'").select(
        F.col("key").alias("source_key"),
        F.concat(F.lit("kept "), "key").alias("etag"),
        F.col("size").alias("source_size"),
        F.col("last_modified").alias("source_modified"),
    )
    return fingerprint_changed(listing, known, root).select("key", "size", "etag")


@query(
    "sample_files",
    f"""WITH {SQL_PAGE_FILES},
    chunks AS (
      SELECT key, octet_length(raw) AS size, i, array_slice(raw, i * 8192 + 1, (i + 1) * 8192) AS piece
      FROM (SELECT *, unnest(range(0, greatest(1, least(5, CAST(ceil(octet_length(raw) / 8192.0) AS BIGINT))))) AS i FROM files))
    SELECT key, CAST(i AS INTEGER) AS read_count, CAST(size AS BIGINT) AS file_size_bytes,
           CAST(octet_length(piece) AS BIGINT) AS bytes_read,
           CAST(i * 8192 + octet_length(piece) AS BIGINT) AS next_start_byte,
           i * 8192 + octet_length(piece) >= size AS eof, md5(piece) AS content_md5
    FROM chunks""",
)
def sample_page_files(spark, sf_dir):
    """First chunks of files, by seek and read."""
    root, listing = _page_files(spark, sf_dir)
    return sample_files(listing, root, chunk_bytes=8192).select(
        "key",
        "read_count",
        "file_size_bytes",
        "bytes_read",
        "next_start_byte",
        "eof",
        F.md5("content").alias("content_md5"),
    )


@query(
    "create_or_append",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, times
    FROM customer, (VALUES (1), (2)) t(times)""",
)
def write_twice(spark, sf_dir):
    """Created by the first write; appended by column name, in another column order, by the second."""
    customers, name = table(spark, sf_dir, "customer"), _table_name("customers")
    path = f"{scratch(spark)}/{name}"
    create_or_append(customers.withColumn("times", F.lit(1)), name, path=path)
    reordered = customers.withColumn("times", F.lit(2)).select("times", *reversed(customers.columns))
    create_or_append(reordered, name, path=path)
    return spark.table(name)


@query(
    "raw_copy",
    """WITH files AS (SELECT url, encode(html) AS raw FROM pages)
    SELECT url AS source_key, i AS part, CAST(i * 4096 AS BIGINT) AS start_byte,
           md5(array_slice(raw, i * 4096 + 1, (i + 1) * 4096)) AS stored_md5, TRUE AS intact
    FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil(octet_length(raw) / 4096.0) AS BIGINT)))) AS i FROM files)""",
)
def raw_copy(spark, sf_dir):
    """Page bodies preserved in parts; the hash of what is read back, and whether it is what was noted."""
    lake = Lake(scratch(spark))
    contents = table(spark, sf_dir, "pages").select(F.col("url").alias("key"), F.col("html").alias("content"))
    saves = page_saves(spark, sf_dir).withColumn("raw_location", F.lit("raw/"))
    write_batch(artifacts.table_parts(contents, 4096)(saves), lake.raw, "check")
    stored = read_batch(spark, lake.raw, "check", schemas.RAW_PARTS)
    digest = F.md5("content")
    return stored.select(
        "source_key",
        "part",
        "start_byte",
        digest.alias("stored_md5"),
        (digest == F.col("part_md5")).alias("intact"),
    )


@query(
    "artifact_rows",
    f"""WITH {SQL_DESTINATIONS}
    SELECT ingestion_id, kind, key, content_type, CASE kind
        WHEN 'source_loader' THEN 'def load_data(spark, source_path): ...'
        WHEN 'profile' THEN '{{' || chr(10) || '  "source_key": "' || source_key || '",' || chr(10) || '  "dependencies": []' || chr(10) || '}}'
        WHEN 'prompt' THEN 'Inspect ' || source_key
        WHEN 'execution_log' THEN 'Status: NOT EXECUTED' || chr(10) || 'The source loader was generated and saved for review. No Spark job was submitted.' || chr(10)
        WHEN 'proposal' THEN html ELSE 'A web page.' END AS body
    FROM destinations JOIN (SELECT url, html FROM pages) p ON p.url = source_key WHERE kind <> 'source'""",
)
def artifact_rows(spark, sf_dir):
    """Six artifacts per page, written and read back."""
    lake = Lake(scratch(spark))
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("source_key"), "html")
    saves = page_saves(spark, sf_dir).join(pages, "source_key").select(
        "ingestion_id",
        "source_key",
        F.concat(F.lit("Inspect "), "source_key").alias("prompt"),
        F.lit("def load_data(spark, source_path): ...").alias("source_loader"),
        F.format_string('{"source_key": "%s"}', "source_key").alias("profile"),
        F.lit("A web page.").alias("semantic_metadata"),
        F.col("html").alias("proposal"),
    )
    write_batch(artifacts.artifact_rows(saves), lake.artifacts, "check")
    return read_batch(spark, lake.artifacts, "check", schemas.ARTIFACTS)


def _proposals(spark, sf_dir):
    """A proposal per document; some name another source, some have no loader or lack a text."""
    documents = table(spark, sf_dir, "documents").withColumn("source_key", F.expr(DOCUMENT_KEY))
    named = F.when(F.col("source") == "src5", "elsewhere").otherwise(F.col("source_key"))
    return documents.select(
        "source_key",
        F.when(F.col("n_chars") < 300, " \n").otherwise(F.concat(F.lit("Inspect "), "source_key")).alias("prompt"),
        F.when(F.col("source") == "src7", "def load_data(path):\n    pass\n")
        .otherwise("def load_data(spark, source_path):\n    return spark.read.text(source_path)\n")
        .alias("source_loader"),
        F.format_string('{"source_key": "%s", "dependencies": ["numpy"]}', named).alias("profile"),
        F.concat(F.lit("Language: "), "lang").alias("semantic_metadata"),
        F.lit("Load as text.").alias("proposal"),
        F.concat(F.lit("texts."), "lang").alias("target_table"),
    )


SQL_OUTCOMES = f"""{SQL_DOCUMENT_LISTING},
outcomes AS (
  SELECT o.key AS source_key, CASE WHEN d.source = 'src5' THEN 'SOURCE_KEY_MISMATCH'
         WHEN d.source = 'src7' THEN 'INVALID_LOADER' WHEN d.n_chars < 300 THEN 'MISSING_TEXT' WHEN d.lang = 'es' THEN 'SOURCE_MISSING'
         ELSE 'artifacts_saved' END AS outcome, o.etag, 'texts.' || d.lang AS target_table
  FROM objects o JOIN documents d ON d.doc_id = o.doc_id)"""


def _save_documents(spark, sf_dir):
    """Save the proposals, with the Spanish sources gone."""
    lake = Lake(scratch(spark))
    there = ~F.contains("key", F.lit("/es/"))
    contents = table(spark, sf_dir, "documents").select(
        F.expr(DOCUMENT_KEY).alias("key"), F.col("text").alias("content")
    )
    result = save_batch(
        spark,
        lake,
        _proposals(spark, sf_dir),
        document_listing(spark, sf_dir).where(there),
        artifacts.table_parts(contents.where(there)),
        "check",
        WHEN,
    )
    return lake, result


@query(
    "save_batch",
    f"""WITH {SQL_OUTCOMES}
    SELECT source_key, outcome, CASE WHEN outcome = 'artifacts_saved' THEN etag END AS etag,
           CASE WHEN outcome = 'artifacts_saved' THEN target_table END AS target_table,
           CASE WHEN outcome = 'artifacts_saved' THEN 6 END AS artifacts,
           CASE WHEN outcome = 'artifacts_saved' THEN 'numpy' END AS dependencies
    FROM outcomes""",
)
def save_documents(spark, sf_dir):
    _, result = _save_documents(spark, sf_dir)
    accepted = result.accepted.select(
        "source_key",
        F.col("status").alias("outcome"),
        "etag",
        "target_table",
        F.size("artifacts").alias("artifacts"),
        F.array_join("dependencies", ",").alias("dependencies"),
    )
    rejected = result.rejected.withColumnRenamed("error", "outcome")
    return accepted.unionByName(rejected, allowMissingColumns=True)


@query(
    "run_log",
    f"""WITH {SQL_OUTCOMES}
    SELECT source_key, target_table, 'NOT EXECUTED' AS status, CAST(NULL AS BIGINT) AS rows_written
    FROM outcomes WHERE outcome = 'artifacts_saved'""",
)
def run_log(spark, sf_dir):
    """The log says of every save that nothing was executed."""
    lake, _ = _save_documents(spark, sf_dir)
    return read_table(spark, lake.runs, schemas.RUN_LOG).select(
        "source_key", "target_table", "status", "rows_written"
    )


EVENT_OBJECT = "event_id bigint, user_id bigint, event_type string, value double, k int"


def _event_objects(spark, sf_dir):
    """Events as JSON objects ``(key, content)``; a click of small value has a text for ``k``."""
    k = F.get_json_object("props", "$.k")
    spoilt = (F.col("event_type") == "click") & (F.col("value") < 1)
    body = F.struct(
        "event_id", "user_id", "event_type", "value", F.when(spoilt, "n.a.").otherwise(k).alias("k")
    )
    return table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("/"), F.col("event_id").cast("string"), F.lit(".json")).alias("key"),
        F.to_json(body).alias("content"),
    )


@query(
    "run_ingestion",
    """WITH typed AS (
      SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type = 'click' AND value < 1 AS bad FROM events)
    SELECT 'first run' AS step, count(*) AS rows_in, count(*) FILTER (WHERE NOT bad) AS rows_written,
           count(*) FILTER (WHERE bad) AS rows_rejected, CAST(NULL AS BIGINT) AS sum_k
    FROM typed
    UNION ALL SELECT 'second run', 0, 0, 0, NULL
    UNION ALL SELECT 'table', NULL, count(*) FILTER (WHERE NOT bad), NULL,
                     CAST(sum(k) FILTER (WHERE NOT bad) AS BIGINT) FROM typed""",
)
def ingest_twice(spark, sf_dir):
    """Every event object is new to the first run; the second finds nothing to do."""
    lake, name = Lake(scratch(spark)), _table_name("events")
    objects = _event_objects(spark, sf_dir)
    listing = table_listing(objects, "key", "content")
    first, second = (
        ingest_objects(
            spark, lake, listing, objects, name, run, EVENT_OBJECT, path=f"{lake.root}/{name}"
        ).select(F.lit(f"{run} run").alias("step"), "rows_in", "rows_written", "rows_rejected")
        for run in ("first", "second")
    )
    written = spark.table(name).agg(F.count("*").alias("rows_written"), F.sum("k").alias("sum_k"))
    return first.unionByName(second).unionByName(
        written.withColumn("step", F.lit("table")), allowMissingColumns=True
    )


@query(
    "ingest_outcomes",
    """WITH objects AS (
      SELECT *, event_type || '/' || event_id || '.json' AS key, event_id % 7 AS form FROM events)
    SELECT key, CASE WHEN form IN (0, 1, 2, 6) THEN 'success' ELSE 'failed' END AS status,
           CAST(CASE form WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS BIGINT) AS rows_written,
           CAST(CASE WHEN form IN (3, 4, 6) THEN 1 ELSE 0 END AS BIGINT) AS rows_rejected, form IN (3, 4, 5) AS pending
    FROM objects""",
)
def ingest_outcomes(spark, sf_dir):
    """Objects of every kind: one document, an array, an empty one, two documents, no JSON, unread, unfit value."""
    lake, name = Lake(scratch(spark)), _table_name("events")
    form = F.col("event_id") % 7
    one = F.to_json(F.struct("event_id", "user_id", "event_type", "value", F.lit(1).alias("k")))
    body = (
        F.when(form == 0, one)
        .when(form == 1, F.concat(F.lit("["), one, F.lit(", "), one, F.lit("]")))
        .when(form == 2, F.lit("[ ]"))
        .when(form == 3, F.concat(one, F.lit("\n"), one))
        .when(form == 4, F.concat(one, F.lit(" and more")))
        .when(form == 6, F.replace(one, F.lit('"k":1'), F.lit('"k":"many"')))
        .otherwise(one)
    )
    key = F.concat("event_type", F.lit("/"), F.col("event_id").cast("string"), F.lit(".json"))
    objects = table(spark, sf_dir, "events").select(key.alias("key"), body.alias("content"), form.alias("form"))
    listing = table_listing(objects, "key", "content")
    ingest_objects(
        spark, lake, listing, objects.where("form <> 5"), name, "r", EVENT_OBJECT, path=f"{lake.root}/{name}"
    )
    state = load_state(spark, lake.state)
    number = F.regexp_extract("source_key", r"/(\d+)\.json\z", 1).cast("bigint")
    written = spark.table(name).groupBy("event_id").agg(F.count("*").alias("rows_written"))
    rejects = read_table(spark, lake.rejects, "source_key string, rejected_columns array<string>, record string")
    rejected = rejects.groupBy("source_key").agg(F.count("*").alias("rows_rejected"))
    pending = discover(listing, state).select(F.col("key").alias("source_key"), F.lit(True).alias("pending"))
    none = F.lit(0).cast("bigint")
    return (
        state.withColumn("event_id", number)
        .join(written, "event_id", "left")
        .join(rejected, "source_key", "left")
        .join(pending, "source_key", "left")
        .select(
            F.col("source_key").alias("key"), "status",
            F.coalesce("rows_written", none).alias("rows_written"),
            F.coalesce("rows_rejected", none).alias("rows_rejected"),
            F.coalesce("pending", F.lit(False)).alias("pending"),
        )
    )


@query(
    "run_saved",
    """WITH sources AS (SELECT *, event_type IN ('view', 'signup') AS run, event_id % 5 = 0 AS spoilt FROM events)
    SELECT event_type, CASE WHEN NOT run THEN 'artifacts_saved' WHEN spoilt THEN 'failed' ELSE 'success' END AS status,
           count(*) AS sources, TRUE AS keeps_copy,
           CAST(CASE WHEN max(run AND NOT spoilt) THEN sum(user_id) END AS BIGINT) AS users
    FROM sources GROUP BY ALL""",
)
def run_saved_sources(spark, sf_dir):
    """Events saved as reviewed sources; those of two target tables are then run from their preserved bytes."""
    lake, run = Lake(scratch(spark)), {kind: _table_name(kind) for kind in ("view", "signup")}
    key = F.concat("event_type", F.lit("/"), F.col("event_id").cast("string"), F.lit(".json"))
    events = table(spark, sf_dir, "events").withColumn("key", key)
    target = F.coalesce(
        *(F.when(F.col("event_type") == kind, F.lit(name)) for kind, name in run.items()), F.lit("later")
    )
    body = F.to_json(F.struct("event_id", "user_id"))
    spoilt = F.when(F.col("event_id") % 5 == 0, F.lit(" x")).otherwise("")
    contents = events.select("key", F.concat(body, spoilt).alias("content"))
    proposals = events.select(
        F.col("key").alias("source_key"),
        F.lit("Inspect").alias("prompt"),
        F.lit("def load_data(spark, source_path):\n    return spark.read.json(source_path)\n").alias("source_loader"),
        F.format_string('{"source_key": "%s"}', "key").alias("profile"),
        F.lit("Ids.").alias("semantic_metadata"),
        F.lit("Load as JSON.").alias("proposal"),
        target.alias("target_table"),
    )
    listing = table_listing(contents, "key", "content")
    save_batch(spark, lake, proposals, listing, artifacts.table_parts(contents), "check", WHEN)
    written = []
    for name in run.values():
        run_saved(spark, lake, name, "r", "event_id bigint, user_id bigint", path=f"{lake.root}/{name}")
        written.append(spark.table(name).select("event_id", "user_id"))
    state = load_state(spark, lake.state).withColumn(
        "event_id", F.regexp_extract("source_key", r"/(\d+)\.json\z", 1).cast("bigint")
    )
    return (
        state.join(written[0].unionByName(written[1]), "event_id", "left")
        .groupBy(F.split("source_key", "/")[0].alias("event_type"), "status")
        .agg(
            F.count("*").alias("sources"),
            F.bool_and(F.startswith("raw_location", F.concat(F.lit("raw/"), "proposal_id"))).alias("keeps_copy"),
            F.sum("user_id").alias("users"),
        )
    )


@query(
    "run_saved_formats",
    """WITH sources AS (
      SELECT *, event_id % 24 AS file, ['csv', 'jsonl', 'parquet'][event_id % 3 + 1] AS format FROM events)
    SELECT format, CAST(file AS BIGINT) AS file, 'success' AS status, count(*) AS rows_written,
           CAST(sum(user_id) AS BIGINT) AS users FROM sources GROUP BY ALL
    UNION ALL SELECT 'parquet', 100 + r_regionkey, 'failed', 0, NULL FROM region""",
)
def run_saved_formats(spark, sf_dir):
    """Events saved as CSV, JSON Lines and Parquet files, and files that are no Parquet: all are one run."""
    lake, name = Lake(scratch(spark)), _table_name("events")
    root = f"{lake.root}/incoming"
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", (F.col("event_id") % 24).alias("file")
    )
    for kind, fmt in enumerate(("csv", "json", "parquet")):
        some = events.where(F.col("event_id") % 3 == kind).repartition("file")
        writer = some.write.partitionBy("file").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(f"{root}/{fmt if fmt != 'json' else 'jsonl'}")
    broken = F.format_string("parquet/file=%s/broken.parquet", F.lit(100) + F.col("r_regionkey"))
    write_objects(table(spark, sf_dir, "region").select(broken.alias("key"), F.col("r_name").alias("content")), root)
    listing = fingerprint(list_objects(spark, root).where(F.rlike("key", F.lit(r"\.(csv|json|parquet)\z"))), root)
    proposals = listing.select(
        F.col("key").alias("source_key"),
        F.lit("Inspect").alias("prompt"),
        F.lit("def load_data(spark, source_path):\n    return spark.read.load(source_path)\n").alias("source_loader"),
        F.to_json(F.struct(F.col("key").alias("source_key"))).alias("profile"),
        F.lit("Ids.").alias("semantic_metadata"),
        F.lit("Load.").alias("proposal"),
        F.lit(name).alias("target_table"),
    )
    save_batch(spark, lake, proposals, listing, artifacts.file_parts(root), "check", WHEN)
    kind = F.split("source_key", "/")[0]
    run_saved(
        spark, lake, name, "r", "event_id bigint, user_id bigint, event_type string", loader=kind, path=f"{lake.root}/{name}"
    )
    written = spark.table(name).groupBy((F.col("event_id") % 24).alias("file")).agg(
        F.count("*").alias("rows_written"), F.sum("user_id").alias("users")
    )
    state = load_state(spark, lake.state).select(
        kind.alias("format"), F.regexp_extract("source_key", r"file=(\d+)", 1).cast("bigint").alias("file"), "status"
    )
    return state.join(written, "file", "left").select(
        "format", "file", "status", F.coalesce("rows_written", F.lit(0).cast("bigint")).alias("rows_written"), "users"
    )


@query(
    "quarantine_files",
    """WITH lines AS (SELECT *, o_orderkey % 10 AS form FROM orders)
    SELECT CASE form WHEN 0 THEN 'too many' WHEN 1 THEN 'too few' WHEN 2 THEN 'open quote' WHEN 3 THEN 'no number' ELSE 'good' END AS form,
           count(*) AS lines, count(*) FILTER (WHERE form > 3) AS rows_written, count(*) FILTER (WHERE form < 3) AS corrupt,
           CAST(sum(o_custkey) FILTER (WHERE form > 3) AS BIGINT) AS sum_custkey
    FROM lines GROUP BY 1""",
)
def quarantine_files(spark, sf_dir):
    """CSV files with lines of too many and too few fields, open quotes and unfit values: good rows and rejects."""
    lake, name = Lake(scratch(spark)), _table_name("orders")
    form = F.col("o_orderkey") % 10
    said = F.when(form == 2, F.concat(F.lit('"'), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
    fields = ["o_orderkey", F.when(form == 3, F.lit("lost")).otherwise(F.col("o_custkey").cast("string")), said]
    line = F.concat_ws(",", *(F.col(f) if isinstance(f, str) else f for f in fields))
    line = F.when(form == 0, F.concat(line, F.lit(",more"))).when(form == 1, F.col("o_orderkey").cast("string")).otherwise(line)
    file = (F.col("o_orderkey") % 8).alias("file")
    lines = table(spark, sf_dir, "orders").select(file, F.lit(1).alias("order"), line.alias("line"))
    headers = lines.select("file", F.lit(0), F.lit("o_orderkey,o_custkey,o_orderpriority")).distinct()
    ordered = lines.union(headers).repartition("file").sortWithinPartitions("file", "order")
    ordered.select("file", "line").write.partitionBy("file").text(f"{lake.root}/incoming/orders.csv")
    schema = "o_orderkey bigint, o_custkey bigint, o_orderpriority string"
    run_ingestion(
        spark, lake, f"{lake.root}/incoming/orders.csv", name, "r", schema=schema, path=f"{lake.root}/{name}"
    )
    rejects = read_table(spark, lake.rejects, "source_key string, rejected_columns array<string>, record string")
    corrupt = F.get_json_object("record", "$._corrupt_record")
    first = F.coalesce(F.split(corrupt, ",")[0], F.get_json_object("record", "$.o_orderkey")).cast("bigint")
    every = spark.table(name).select("o_orderkey", "o_custkey", F.lit(False).alias("corrupt")).unionByName(
        rejects.select(first.alias("o_orderkey"), F.lit(None).cast("bigint").alias("o_custkey"), corrupt.isNotNull().alias("corrupt"))
    )
    kind = F.col("o_orderkey") % 10
    label = F.when(kind == 0, "too many").when(kind == 1, "too few").when(kind == 2, "open quote").when(kind == 3, "no number")
    return every.groupBy(label.otherwise("good").alias("form")).agg(
        F.count("*").alias("lines"), F.count("o_custkey").alias("rows_written"),
        F.count_if("corrupt").alias("corrupt"), F.sum("o_custkey").alias("sum_custkey"),
    )


# Texts with line breaks, blank lines, quotes and commas, in both dialects.
_NOTE = """CASE o_orderkey % 4 WHEN 0 THEN o_orderpriority || chr(10) || o_orderstatus
    WHEN 1 THEN '"' || o_orderpriority || '",' || chr(10) || chr(10) || '"' || o_orderkey
    WHEN 2 THEN o_orderpriority ELSE 'a, "b' || chr(10) || '7,x,"y' || chr(10) || o_orderstatus || '"' END"""


@query(
    "csv_line_breaks",
    f"SELECT o_orderkey, o_custkey, o_totalprice, {_NOTE} AS note FROM orders",
)
def csv_line_breaks(spark, sf_dir):
    """CSV whose values hold line breaks, in splits small enough to be cut inside quotes many times."""
    lake, name = Lake(scratch(spark)), _table_name("notes")
    path = f"{lake.root}/incoming/notes.csv"
    notes = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "o_totalprice", f"{_NOTE} AS note")
    notes.write.options(header=True, escape='"').csv(path)
    # The size of splits is a session's setting; that of the caller stays as it is.
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", 64 * 1024)
    run_ingestion(
        small, lake, path, name, "r", loader="csv_multiline", path=f"{lake.root}/{name}",
        schema="o_orderkey bigint, o_custkey bigint, o_totalprice double, note string",
    )
    return spark.read.parquet(f"{lake.root}/{name}")


@query(
    "json_array_parts",
    """SELECT event_id, user_id, event_type, 'a "quoted\\" [' || event_type || '], {' AS note FROM events""",
)
def json_array_parts(spark, sf_dir):
    """All events as one JSON array in a file, split into its elements from parts of 4 KB."""
    root, part = scratch(spark), 4096
    note = F.concat(F.lit('a "quoted\\" ['), "event_type", F.lit("], {"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", note.alias("note"))
    lines = events.select(F.concat(F.lit(", "), F.to_json(F.struct("*"))).alias("value"))

    def bracketed(batches):
        # The first element is a null, so that every event follows a comma.
        yield pa.RecordBatch.from_pydict({"value": ["[null"]})
        yield from batches
        yield pa.RecordBatch.from_pydict({"value": ["]"]})

    # One file is one task's to write; the lines pass through it, it neither sorts nor holds them.
    lines.repartition(1).mapInArrow(bracketed, "value string").write.text(f"{root}/incoming")
    listed = list_objects(spark, f"{root}/incoming").where("key LIKE '%.txt' AND key NOT LIKE '.%'")
    options, folder = store_options(spark), f"{root}/incoming"

    def read(row):
        store, base = open_store(folder, options)
        return read_range(store, join(base, row["key"]), row["start_byte"], row["length"])[1]

    parts = spread(split_into_parts(listed.select("key", "size"), part), None, "key", "part")
    elements = array_elements(parts.select("key", "part", "start_byte", "length"), read)
    sound = elements.where("error IS NULL AND element <> 'null'").select(
        F.from_json("element", "event_id bigint, user_id bigint, event_type string, note string").alias("e")
    )
    return sound.select("e.*")


@query(
    "custom_loader",
    """SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS price FROM orders""",
)
def custom_loader(spark, sf_dir):
    """A loader of one's own, registered by name and checked like the built-in ones."""

    def load_data(spark, source_path):
        parts = F.split("value", ";")
        return spark.read.text(source_path).select(
            parts[0].alias("o_orderkey"), parts[1].alias("o_custkey"), parts[2].alias("price")
        )

    register_loader("semicolons", load_data)
    path = f"{scratch(spark)}/orders.dat"
    orders = table(spark, sf_dir, "orders")
    orders.select(F.concat_ws(";", "o_orderkey", "o_custkey", "o_totalprice")).write.text(path)
    rows = check_dataset(load_source(spark, path, "semicolons"))
    return convert_types(rows, "o_orderkey bigint, o_custkey bigint, price double")


@query(
    "incremental_streams",
    """SELECT 'a' AS stream, event_id FROM events UNION ALL SELECT 'b', event_id FROM events""",
)
def incremental_streams(spark, sf_dir):
    """Two streams with checkpoints of their own write into one target, neither over the other's rows."""
    root = scratch(spark)
    schema = table(spark, sf_dir, "events").schema
    for stream in "ab":
        ingest_new_files(
            spark, sf_dir, "parquet", schema, f"{root}/target", f"{root}/progress-{stream}",
            lambda rows: rows.select("event_id"), {"pathGlobFilter": "events.parquet"}, stream,
        ).awaitTermination()
    return spark.read.parquet(f"{root}/target").select(
        F.split("batch_id", "-")[0].alias("stream"), "event_id"
    )


@query(
    "changed_objects_stream",
    """WITH p AS (SELECT page_id, page_id % 5 AS form, md5(html) AS etag, md5(html || ' ') AS edited FROM pages)
    SELECT 0 AS batch, page_id, 'added' AS change, etag FROM p
    UNION ALL SELECT 1, page_id, 'changed', edited FROM p WHERE form = 1
    UNION ALL SELECT 1, page_id, 'removed', NULL FROM p WHERE form = 2
    UNION ALL SELECT 1, -1 - page_id, 'added', etag FROM p WHERE form = 3""",
)
def changed_objects_stream(spark, sf_dir):
    """Pages as files, some then edited, removed and added: a stream that is started again sees just that."""
    root = scratch(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("content"))
    key = F.concat(F.col("page_id") % 7, F.lit("/"), "page_id", F.lit(".html"))
    form = F.col("page_id") % 5

    def put(rows):
        write_objects(rows.select(key.alias("key"), "content"), f"{root}/incoming")

    def keep(changes, batch_id):
        write_batch(changes, f"{root}/changes", f"{batch_id}")

    def run():
        stream_changes(spark, f"{root}/incoming", f"{root}/progress", keep).awaitTermination()

    put(pages)
    run()
    put(pages.where(form == 1).withColumn("content", F.concat("content", F.lit(" "))))
    remove_objects(pages.where(form == 2).select(key.alias("key")), f"{root}/incoming")
    put(pages.where(form == 3).withColumn("page_id", -1 - F.col("page_id")))
    run()
    run()
    changes = read_table(spark, f"{root}/changes", CHANGES)
    number = F.regexp_extract("key", r"(-?\d+)\.html", 1).cast("bigint")
    return changes.select(F.col("batch_id").cast("int").alias("batch"), number.alias("page_id"), "change", "etag")


@query(
    "run_source",
    """SELECT count(*) AS rows_in, count(*) FILTER (WHERE l_returnflag <> 'R') AS rows_written,
           count(*) FILTER (WHERE l_returnflag = 'R') AS rows_rejected, 'SUCCESS' AS status
    FROM lineitem""",
)
def run_source(spark, sf_dir):
    """One CSV source by its loader into a typed table; returned lines have no usable quantity."""
    lake, name = Lake(scratch(spark)), _table_name("lines")
    path = f"{lake.root}/incoming/lines.csv"
    quantity = F.when(F.col("l_returnflag") == "R", "lost").otherwise(F.col("l_quantity").cast("string"))
    lines = table(spark, sf_dir, "lineitem").withColumn("l_quantity", quantity)
    lines.write.option("header", True).csv(path)
    log = run_ingestion(
        spark, lake, path, name, "check", schema=LINEITEM, path=f"{lake.root}/{name}"
    )
    return log.select("rows_in", "rows_written", "rows_rejected", "status")


@query(
    "sql_over_lake",
    f"""WITH {SQL_OUTCOMES}
    SELECT target_table, count(*) AS sources, 6 * count(*) AS artifacts,
           CAST(sum(octet_length(encode(d.text))) AS BIGINT) AS bytes
    FROM outcomes o JOIN documents d ON d.source || '/' || d.lang || '/' || d.doc_id || '.txt' = o.source_key
    WHERE outcome = 'artifacts_saved' GROUP BY target_table""",
)
def sql_over_lake(spark, sf_dir):
    """Plain SQL over the control tables of a save."""
    lake, _ = _save_documents(spark, sf_dir)
    names = {n: _table_name(n) for n in ("state", "raw", "artifacts")}
    paths = {"state": lake.state, "raw": lake.raw, "artifacts": lake.artifacts}
    register_views(spark, {names[n]: paths[n] for n in names})
    return spark.sql(
        f"""
        SELECT s.target_table, count(*) AS sources, sum(a.n) AS artifacts, sum(r.bytes) AS bytes
        FROM {names["state"]} s
        JOIN (SELECT ingestion_id, count(*) AS n FROM {names["artifacts"]} GROUP BY ingestion_id) a
          ON a.ingestion_id = s.proposal_id
        JOIN (SELECT ingestion_id, sum(bytes) AS bytes FROM {names["raw"]}
              GROUP BY ingestion_id) r ON r.ingestion_id = s.proposal_id
        GROUP BY s.target_table"""
    )


@query(
    "incremental_ingest",
    """SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
)
def incremental_ingest(spark, sf_dir):
    """The events file as a stream of files, run until nothing is new, and then once more."""
    root = scratch(spark)
    schema = table(spark, sf_dir, "events").schema

    def conform(rows):
        typed = rows.withColumn("k", F.get_json_object("props", "$.k"))
        return convert_types(typed, "event_id bigint, event_type string, k int")

    for _ in range(2):
        ingest_new_files(
            spark,
            sf_dir,
            "parquet",
            schema,
            f"{root}/target",
            f"{root}/progress",
            conform,
            {"pathGlobFilter": "events.parquet"},
        ).awaitTermination()
    return spark.read.parquet(f"{root}/target").drop("batch_id")
