"""Listing, discovery and state."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lake_ingest.checks.fixtures import (
    SQL_DISCOVERED,
    SQL_DOCUMENT_LISTING,
    SQL_DOCUMENT_STATE,
    SQL_PAGE_LISTING,
    document_listing,
    document_state,
    page_listing,
)
from lake_ingest.checks.registry import query, scratch, table
from lake_ingest.functions.keys import iso_utc, normalize_etag
from lake_ingest.operators.discovery import (
    discover,
    discovery_envelope,
    discovery_summary,
    pick_pending,
)
from lake_ingest.operators.keyed import KeyedLog
from lake_ingest.operators.listing import drop_markers, under_prefix
from lake_ingest.operators.state import import_documents, latest, status_groups


@query("list_objects", f"WITH {SQL_PAGE_LISTING} SELECT key, bucket, size, etag FROM objects")
def list_objects(spark, sf_dir):
    return page_listing(spark, sf_dir).drop("last_modified")


@query(
    "list_prefix",
    f"WITH {SQL_DOCUMENT_LISTING} SELECT key, size, etag FROM objects WHERE starts_with(key, 'src3/en/')",
)
def list_prefix(spark, sf_dir):
    return under_prefix(document_listing(spark, sf_dir), "src3/en").select("key", "size", "etag")


@query(
    "drop_markers",
    f"WITH {SQL_PAGE_LISTING} SELECT key, size FROM objects WHERE NOT ends_with(key, '/')",
)
def markers(spark, sf_dir):
    return drop_markers(page_listing(spark, sf_dir)).select("key", "size")


@query(
    "normalize_etag",
    """SELECT page_id, CASE WHEN ends_with(url, '/') THEN '' ELSE md5(html) END AS etag FROM pages""",
)
def etags(spark, sf_dir):
    """Quoted, bare and missing fingerprints, by the form of the address."""
    plain = F.md5("html")
    given = F.when(F.endswith("url", F.lit("/")), None).when(
        F.startswith("url", F.lit("https")), F.concat(F.lit('"'), plain, F.lit('"'))
    ).otherwise(plain)
    return table(spark, sf_dir, "pages").select("page_id", given.alias("etag")).select(
        "page_id", normalize_etag("etag").alias("etag")
    )


@query(
    "iso_utc",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN microsecond(ts) % 1000000 = 0 THEN ''
                 ELSE '.' || lpad(CAST(microsecond(ts) % 1000000 AS VARCHAR), 6, '0') END
         || '+00:00' AS last_modified FROM events""",
)
def iso_times(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", iso_utc("ts").alias("last_modified")
    )


def discovered_documents(spark, sf_dir):
    return discover(document_listing(spark, sf_dir), document_state(spark, sf_dir))


@query(
    "discover_changed",
    f"""WITH {SQL_DISCOVERED}
    SELECT key, bucket, size, etag, previously_seen, previous_status FROM discovered""",
)
def discover_changed(spark, sf_dir):
    return discovered_documents(spark, sf_dir).drop("last_modified")


@query(
    "discovery_summary",
    f"""WITH {SQL_DISCOVERED}
    SELECT bucket, previously_seen, previous_status, count(*) AS "count",
           CAST(sum(size) AS BIGINT) AS bytes
    FROM discovered GROUP BY ALL""",
)
def summary(spark, sf_dir):
    return discovery_summary(discovered_documents(spark, sf_dir))


@query(
    "discovery_envelope",
    f"""WITH {SQL_DISCOVERED}
    SELECT 'incoming' AS bucket, 'src3/en' AS prefix, 'lake' AS state_bucket, 'ingestion_state' AS state_key,
           count(*) AS "count" FROM discovered WHERE starts_with(key, 'src3/en/')""",
)
def envelope(spark, sf_dir):
    """Discovery below one folder."""
    found = under_prefix(discovered_documents(spark, sf_dir), "src3/en")
    return discovery_envelope(found, "incoming", "src3/en", "lake", "ingestion_state")


@query(
    "pick_pending",
    f"""WITH {SQL_DISCOVERED}
    SELECT key, size, previous_status FROM discovered ORDER BY last_modified, key LIMIT 25""",
)
def pending(spark, sf_dir):
    return pick_pending(discovered_documents(spark, sf_dir), 25).select(
        "key", "size", "previous_status"
    )


@query(
    "state_rows",
    f"""WITH {SQL_DOCUMENT_LISTING}, {SQL_DOCUMENT_STATE}
    SELECT source_key, CAST(1 AS BIGINT) AS version, status, etag FROM state
    UNION ALL SELECT source_key || '#empty', 1, NULL, NULL FROM state""",
)
def state_rows(spark, sf_dir):
    """State documents with a full, an empty and a null record each; the null one is dropped."""
    document = F.format_string(
        '{"processed": {"%s": {"status": "%s", "etag": "%s"}, "%s#empty": {}, "%s#null": null}}',
        "source_key",
        "status",
        "etag",
        "source_key",
        "source_key",
    )
    documents = document_state(spark, sf_dir).select(document.alias("body"))
    return import_documents(documents, "body").select("source_key", "version", "status", "etag")


@query(
    "state_latest",
    """SELECT conv_id, turn, role, text FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
)
def state_latest(spark, sf_dir):
    """Turns as a log of records, the last one of each conversation in force."""
    return latest(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@query(
    "state_base_deltas",
    """SELECT conv_id, turn, role, text FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
)
def state_base_deltas(spark, sf_dir):
    """Turns as records that come in three batches, with a fold after the first and the second one."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    schema = "conv_id bigint, turn bigint, role string, text string"
    log = KeyedLog(spark, f"turns_{uuid.uuid4().hex}", scratch(spark), schema, "conv_id", ["turn"])
    for batch in range(3):
        log.append(turns.where(F.pmod(F.col("turn") + F.col("conv_id"), F.lit(3)) == batch), f"b{batch}")
        if batch < 2:
            log.fold()
    return log.read()


@query(
    "state_status",
    f"""WITH {SQL_DOCUMENT_LISTING}, {SQL_DOCUMENT_STATE}
    SELECT status, CASE WHEN status IN ('success', 'artifacts_saved') THEN 'done' ELSE 'pending' END
             AS progress, count(*) AS "count"
    FROM state GROUP BY ALL""",
)
def state_status(spark, sf_dir):
    return status_groups(document_state(spark, sf_dir))
