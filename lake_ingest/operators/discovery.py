"""Finding new and changed objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lake_ingest.constants import DONE_STATUSES
from lake_ingest.functions.keys import normalize_etag, text_literal


def discover(listing: DataFrame, state: DataFrame) -> DataFrame:
    """Objects that are new, changed, or not yet done.

    ``state`` holds one record per ``source_key`` (``operators.state.latest``). Only keys, statuses
    and fingerprints travel through the join, never contents; Spark broadcasts the state while its
    statistics say it is small, else sorts and merges with skewed partitions split.
    """
    prior = state.select(
        F.col("source_key").alias("key"),
        F.lit(True).alias("_seen"),
        F.col("status").alias("previous_status"),
        F.col("etag").alias("_previous_etag"),
    )
    statuses = ", ".join(text_literal(s) for s in DONE_STATUSES)
    unchanged = f"coalesce(previous_status IN ({statuses}) AND _previous_etag = etag, false)"
    return (
        listing.withColumn("etag", normalize_etag("etag"))
        .join(prior, "key", "left")
        .where(f"NOT {unchanged}")
        .withColumn("previously_seen", F.expr("_seen IS NOT NULL"))
        .select(*listing.columns, "previously_seen", "previous_status")
    )


def discovery_summary(discovered: DataFrame) -> DataFrame:
    """Number and size of the discovered objects by what is known of them."""
    return discovered.groupBy("bucket", "previously_seen", "previous_status").agg(
        F.count("*").alias("count"), F.sum("size").alias("bytes")
    )


def discovery_envelope(
    discovered: DataFrame, bucket: str, prefix: str, state_bucket: str, state_key: str
) -> DataFrame:
    """One row that says what was searched, against which state, and how much was found.

    The files themselves stay rows of ``discovered``; no array of all of them is built.
    """
    labels = {"bucket": bucket, "prefix": prefix, "state_bucket": state_bucket, "state_key": state_key}
    return discovered.agg(F.count("*").alias("count")).select(
        *[F.lit(value).alias(name) for name, value in labels.items()], "count"
    )


def pick_pending(discovered: DataFrame, n: int | None = None) -> DataFrame:
    """The ``n`` objects waiting longest, ties by key; all of them when ``n`` is None."""
    if n is None:
        return discovered
    return discovered.orderBy("last_modified", "key").limit(n)
