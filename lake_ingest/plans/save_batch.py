"""Saving reviewed proposals: validate, preserve the sources, store the artifacts, verify, commit."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lake_ingest import schemas
from lake_ingest.constants import PART_BYTES, RAW_PREFIX, SAVED_STATUS
from lake_ingest.functions.keys import artifact_map, object_name, raw_location, text_literal
from lake_ingest.functions.text import has_text
from lake_ingest.operators.artifacts import artifact_rows, expected_keys, ingestion_id
from lake_ingest.operators.listing import combine_part_hashes
from lake_ingest.operators.runlog import not_executed_rows
from lake_ingest.operators.tables import read_batch, write_batch
from lake_ingest.operators.validate import is_loader_script, missing_keys, validate_profiles
from lake_ingest.plans.lake import Lake

# Columns of a proposal; all but the key must hold text.
REQUIRED = ("prompt", "source_loader", "profile", "semantic_metadata", "proposal", "target_table")
PROPOSAL_COLUMNS = ("source_key", *REQUIRED)

CHECKED = (
    ", ".join(f"{c} string" for c in PROPOSAL_COLUMNS)
    + ", dependencies array<string>, etag string, size bigint, last_modified timestamp, "
    "error string, ingestion_id string, raw_location string"
)


@dataclass(frozen=True)
class SaveResult:
    """``accepted`` has the state records written, ``rejected`` is ``(source_key, error)``."""

    accepted: DataFrame
    rejected: DataFrame


def check_proposals(
    proposals: DataFrame, listing: DataFrame, run_id: str, prefix: str = RAW_PREFIX
) -> DataFrame:
    """Proposals with the first failing test as ``error``, and the keys their ingestion gets.

    The identifier depends on the run and the proposal's content: repeating a run finds the same
    ones, and the same proposal given twice in a run is one save.
    """
    texts = f"md5(to_json(struct({', '.join(REQUIRED)})))"
    identity = ingestion_id(text_literal(run_id), "source_key", texts)
    identified = (
        proposals.select(*PROPOSAL_COLUMNS)
        .withColumn("ingestion_id", identity)
        .dropDuplicates(["source_key", "ingestion_id"])
    )
    sources = listing.select(
        F.col("key").alias("source_key"),
        F.lit(True).alias("_listed"),
        "etag",
        "size",
        F.col("last_modified").cast("timestamp").alias("last_modified"),
    )
    checked = (
        validate_profiles(identified, "profile", "source_key")
        .withColumn("_loader", is_loader_script("source_loader"))
        .join(sources, "source_key", "left")
    )
    error = """CASE
        WHEN verdict <> 'OK' THEN verdict
        WHEN NOT _loader THEN 'INVALID_LOADER'
        WHEN NOT _complete THEN 'MISSING_TEXT'
        WHEN _listed IS NULL THEN 'SOURCE_MISSING'
        WHEN _name = '' THEN 'NO_FILE_NAME' END"""
    return (
        checked.withColumns({"_complete": has_text(*REQUIRED), "_name": object_name("source_key")})
        .withColumns(
            {
                "error": F.expr(error),
                "raw_location": raw_location("source_key", "ingestion_id", prefix),
            }
        )
        .drop("verdict", "_loader", "_complete", "_name", "_listed")
    )


def state_records(saves: DataFrame, lake: Lake, processed_at: datetime) -> DataFrame:
    """State log rows of verified saves."""
    return saves.select(
        "source_key",
        F.lit(SAVED_STATUS).alias("status"),
        F.col("ingestion_id").alias("proposal_id"),
        F.lit(lake.incoming_bucket).alias("source_bucket"),
        "etag",
        F.col("size").alias("source_size"),
        F.col("last_modified").alias("source_modified"),
        F.lit(processed_at).cast("timestamp").alias("processed_at"),
        F.lit(lake.data_bucket).alias("raw_bucket"),
        "raw_location",
        artifact_map("source_key", "ingestion_id", lake.raw_prefix).alias("artifacts"),
        "target_table",
        "dependencies",
        F.lit(False).alias("execution_performed"),
    )


def verified_saves(spark: SparkSession, lake: Lake, batch: str, saves: DataFrame) -> DataFrame:
    """Saves whose seven keys and all bytes are stored, with the ``etag`` of the bytes stored."""
    raw = read_batch(spark, lake.raw, batch, schemas.RAW_PARTS)
    artifacts = read_batch(spark, lake.artifacts, batch, schemas.ARTIFACTS)
    stored = raw.where("part = 0").select(F.col("raw_location").alias("key")).unionByName(
        artifacts.select("key")
    )
    incomplete = missing_keys(expected_keys(saves, lake.raw_prefix), stored)
    copies = combine_part_hashes(raw, ["ingestion_id"], {"_stored": "bytes"})
    return (
        saves.drop("etag")
        .join(copies, "ingestion_id")
        .where("size = _stored")
        .drop("_stored")
        .join(incomplete.select("ingestion_id"), "ingestion_id", "left_anti")
    )


def save_batch(
    spark: SparkSession,
    lake: Lake,
    proposals: DataFrame,
    listing: DataFrame,
    read_parts: Callable[[DataFrame], DataFrame],
    run_id: str,
    processed_at: datetime,
) -> SaveResult:
    """Save every valid proposal; the state log is written last and is the commit.

    ``read_parts`` serves the sources' bytes: ``artifacts.table_parts`` or ``artifacts.file_parts``.
    The checked proposals are written once and read back, so that validation runs once, later steps
    read only the columns they need, and the accepted set cannot shift between the steps.
    """
    batch = f"save-{run_id}"
    write_batch(check_proposals(proposals, listing, run_id, lake.raw_prefix), lake.proposals, batch)
    checked = read_batch(spark, lake.proposals, batch, CHECKED)
    saves = checked.where("error IS NULL")

    write_batch(
        read_parts(saves.select("ingestion_id", "source_key", "raw_location", "size")),
        lake.raw,
        batch,
        # A row group is read whole, so it holds little more than a part.
        **{"parquet.block.size": PART_BYTES},
    )
    write_batch(artifact_rows(saves, lake.raw_prefix), lake.artifacts, batch)
    write_batch(not_executed_rows(saves, processed_at), lake.runs, batch)

    keys_only = saves.drop(*[c for c in REQUIRED if c != "target_table"])
    verified = verified_saves(spark, lake, batch, keys_only)
    write_batch(state_records(verified, lake, processed_at), lake.state, batch)

    accepted = read_batch(spark, lake.state, batch, schemas.STATE)
    unverified = saves.join(
        accepted.select(F.col("proposal_id").alias("ingestion_id")), "ingestion_id", "left_anti"
    ).select("source_key", F.lit("NOT_VERIFIED").alias("error"))
    rejected = checked.where("error IS NOT NULL").select("source_key", "error")
    return SaveResult(accepted, rejected.unionByName(unverified))


def orphaned_artifacts(artifacts: DataFrame, state_log: DataFrame) -> DataFrame:
    """Artifacts of saves that were interrupted before their state record."""
    committed = state_log.select(F.col("proposal_id").alias("ingestion_id"))
    return artifacts.join(committed, "ingestion_id", "left_anti")
