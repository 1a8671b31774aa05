"""Running ingestions: one source by its loader, or all discovered objects as one Spark job."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest import schemas
from lake_ingest.constants import FAILED_STATUS, SAVED_STATUS, SUCCESS_STATUS
from lake_ingest.functions.keys import quoted
from lake_ingest.functions.text import decode_lossy
from lake_ingest.operators import runlog
from lake_ingest.operators.conform import (
    NULL_TOKENS,
    REJECTED,
    Conformed,
    missing_values,
)
from lake_ingest.operators.discovery import discover
from lake_ingest.operators.sink import create_or_append, replace_load
from lake_ingest.operators.state import load_state
from lake_ingest.operators.tables import (
    batch_folders,
    drop_batch,
    drop_folders,
    file_names,
    read_batch,
    read_table,
    subfolders,
    write_batch,
)
from lake_ingest.operators.validate import check_dataset
from lake_ingest.plans.lake import Lake
from lake_ingest.sources.contents import Reader, table_contents
from lake_ingest.sources.loaders import CORRUPT_RECORD, as_texts, load_files, load_source
from lake_ingest.sources.restored import RESTORED, loader_of, preserved_contents, restore

DISCOVERED = (
    "key string, bucket string, size bigint, etag string, last_modified timestamp, "
    "previously_seen boolean, previous_status string"
)
REJECTS = "source_key string, rejected_columns array<string>, record string"


CARRIED = ("_source_key", "_kind", "_is_row")
# Loaders that read many files at a time.
BUILT_IN = ("csv", "csv_multiline", "jsonl", "text", "parquet", "orc")


class Staged(NamedTuple):
    """Staged rows, ``(source_key, status)`` of the sources, and what is to be removed after the run."""

    rows: DataFrame
    outcomes: DataFrame
    batches: list[str]
    # ``(ingestion_id, source_key)`` where the rows are of ingestions.
    names: DataFrame | None = None
    folders: list[str] = []


def _now() -> datetime:
    return datetime.now(timezone.utc)


def already_done(spark: SparkSession, lake: Lake, run_id: str, target_table: str) -> bool:
    """True when the run log has this run for this table as a success."""
    done = read_table(spark, lake.runs, schemas.RUN_LOG).where(
        (F.col("run_id") == run_id)
        & (F.col("target_table") == target_table)
        & (F.col("status") == runlog.SUCCEEDED)
    )
    return not done.isEmpty()


def batch_name(kind: str, run_id: str, target_table: str) -> str:
    """Folder name of a run's rows in the control tables: two tables of one run have two."""
    name = f"{kind}-{run_id}-{target_table}"
    plain = re.sub(r"[^A-Za-z0-9._-]", "_", name)
    return plain if plain == name else f"{plain}-{hashlib.md5(name.encode()).hexdigest()[:8]}"


def _staged(
    lake: Lake,
    rows: DataFrame,
    batch: str,
    schema: T.StructType | None,
    null_tokens: Sequence[str],
    carried: Sequence[str] = (),
) -> DataFrame:
    """The rows converted and flagged, written once: ``carried``, ``good``, ``rejected_columns``, ``record``.

    The source is read a single time, and good rows, rejects and counts are all of that reading. Without
    a schema the rows' own columns are taken as they are.
    """
    own = [f for f in rows.schema if f.name not in (*carried, CORRUPT_RECORD)]
    fields = schema or T.StructType(own)
    cleaned = missing_values(rows, null_tokens, columns=fields.names) if schema else rows
    conformed = Conformed(cleaned, fields)
    record = ", ".join(quoted(c) for c in rows.columns if c not in carried)
    staged = conformed.rows.select(
        *carried,
        F.struct(*conformed.converted()).alias("good"),
        REJECTED,
        F.expr(f"CASE WHEN size({REJECTED}) > 0 THEN to_json(struct({record})) END AS record"),
    )
    write_batch(staged, lake.staged, batch)
    return read_batch(rows.sparkSession, lake.staged, batch, staged.schema)


def _distribute(
    lake: Lake,
    staged: DataFrame,
    batch: str,
    append: Callable[[DataFrame], None],
    key: str | None = None,
    is_row: str = "true",
    names: DataFrame | None = None,
) -> dict[str, int]:
    """Good rows to the target, rejects to their control table; the counts.

    ``names`` are ``(ingestion_id, source_key)`` where the rows' key is the former.
    """
    counts = staged.where(is_row).agg(
        F.expr("count(*) AS rows"), F.expr(f"count_if(size({REJECTED}) > 0) AS rejected")
    ).first()
    append(staged.where(f"{is_row} AND size({REJECTED}) = 0").select("good.*"))
    source = "CAST(NULL AS string)" if key is None else quoted(key)
    rejects = staged.where(f"size({REJECTED}) > 0").selectExpr(f"{source} AS source_key", REJECTED, "record")
    if names is not None:
        rejects = rejects.withColumnRenamed("source_key", "ingestion_id").join(names, "ingestion_id")
        rejects = rejects.select("source_key", REJECTED, "record")
    write_batch(rejects, lake.rejects, batch)
    return {
        "rows_in": counts["rows"],
        "rows_written": counts["rows"] - counts["rejected"],
        "rows_rejected": counts["rejected"],
    }


def _schema(schema: T.StructType | str | None) -> T.StructType | None:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def run_ingestion(
    spark: SparkSession,
    lake: Lake,
    source_path: str,
    target_table: str,
    run_id: str,
    *,
    loader: str | None = None,
    source_key: str | None = None,
    schema: T.StructType | str | None = None,
    skip_if_done: bool = False,
    **options: str,
) -> DataFrame:
    """Load one source (a file, folder or glob), write it to the target table, log the run.

    Running again appends again, unless ``skip_if_done`` asks the run log first. Where a saved state
    record exists for ``source_key``, a ``success`` record follows it. The log row is written last.
    """
    batch = batch_name("run", run_id, target_table)
    if skip_if_done and already_done(spark, lake, run_id, target_table):
        return read_batch(spark, lake.runs, batch, schemas.RUN_LOG)
    started, fields = _now(), _schema(schema)

    def append(good: DataFrame) -> None:
        create_or_append(good, target_table, **options)

    with _logged(spark, lake, batch, run_id, target_table, started, source_key):
        rows = check_dataset(load_source(spark, source_path, loader, fields, keep_corrupt=True))
        staged = _staged(lake, rows, batch, fields, NULL_TOKENS)
        counts = _distribute(lake, staged, batch, append)
        finished = _now()
        if source_key is not None:
            saved = load_state(spark, lake.state, batch).where(F.col("source_key") == source_key)
            write_batch(_succeeded(saved, finished), lake.state, batch)
    log = runlog.run_row(
        spark, run_id, target_table, runlog.SUCCEEDED, started, finished,
        source_key=source_key, **counts,
    )
    write_batch(log, lake.runs, batch)
    drop_batch(spark, lake.staged, batch)
    return read_batch(spark, lake.runs, batch, schemas.RUN_LOG)


@contextmanager
def _logged(spark, lake, batch, run_id, target_table, started, source_key=None):
    """What fails within is logged as a failed run, and raised."""
    try:
        yield
    except Exception as exc:
        failure = runlog.run_row(
            spark, run_id, target_table, runlog.FAILED, started, _now(),
            source_key=source_key, message=str(exc),
        )
        write_batch(failure, lake.runs, batch)
        raise


def _succeeded(state: DataFrame, finished: datetime) -> DataFrame:
    """The given state records as of a finished run."""
    return state.withColumns(
        {
            "status": F.lit(SUCCESS_STATUS),
            "processed_at": F.lit(finished).cast("timestamp"),
            "execution_performed": F.lit(True),
        }
    )


def parse_objects(contents: DataFrame, fields: T.StructType) -> DataFrame:
    """Rows of JSON objects ``(key, content, error)``: ``_source_key, _kind, _is_row`` and the fields as texts.

    An object must hold one JSON document and nothing after it. A JSON object is one row, an array of
    objects a row for each; anything else is ``malformed``, one row with its text in
    ``_corrupt_record``. An unread object and an empty array give a row that is none, to be told of.
    """
    record = T.StructType([*as_texts(fields), T.StructField(CORRUPT_RECORD, T.StringType())])
    one = record.simpleString()
    # As the first of two elements, the second its own hash: anything left over displaces or breaks that.
    pair = "from_json(concat('[', _text, ',\"', md5(_text), '\"]'), 'array<string>')"
    whole = "size(_pair) = 2 AND _pair[1] = md5(_text)"
    kind = f"""CASE
        WHEN error IS NOT NULL OR content IS NULL THEN 'unread'
        WHEN NOT coalesce({whole}, false) THEN 'malformed'
        WHEN _text RLIKE r'\\A[ \\t\\r\\n]*[{{]' THEN 'object'
        WHEN _text RLIKE r'\\A[ \\t\\r\\n]*\\['
            AND forall(from_json(_pair[0], 'array<string>'), e -> coalesce(startswith(e, '{{'), false)) THEN 'array'
        ELSE 'malformed' END"""
    rows = F.expr("_kind = 'object'"), F.expr("_kind = 'array'"), F.expr("_kind = 'malformed'")
    corrupt = F.struct(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in record.fields[:-1]), F.col("_text").alias(CORRUPT_RECORD)
    ).cast(one)
    parsed = (
        F.when(rows[0], F.array(F.from_json("_text", record)))
        .when(rows[1], F.from_json("_text", T.ArrayType(record)))
        .when(rows[2], F.array(corrupt))
    )
    texts = contents.select("key", "error", "content", decode_lossy("content").alias("_text"))
    return (
        texts.withColumn("_pair", F.expr(pair))
        .withColumn("_kind", F.expr(kind))
        .select(F.col("key").alias("_source_key"), "_kind", parsed.alias("_rows"))
        .select("_source_key", "_kind", F.explode_outer("_rows").alias("_record"))
        .select("_source_key", "_kind", F.col("_record").isNotNull().alias("_is_row"), "_record.*")
    )


def object_outcomes(staged: DataFrame) -> DataFrame:
    """Per object ``(source_key, kind, rows_written, rows_rejected, status)``.

    Success is an object whose document was read, even if all its rows were set aside as rejects, where
    they wait for a decision; an unread or malformed one is failed, and discovery offers it again.
    """
    counted = staged.groupBy(F.col("_source_key").alias("source_key")).agg(
        F.first("_kind").alias("kind"),
        F.expr(f"count_if(_is_row AND size({REJECTED}) = 0) AS rows_written"),
        F.expr(f"count_if(_is_row AND size({REJECTED}) > 0) AS rows_rejected"),
    )
    done = "kind IN ('object', 'array', 'rows')"
    return counted.withColumn(
        "status", F.when(F.expr(done), F.lit(SUCCESS_STATUS)).otherwise(F.lit(FAILED_STATUS))
    )


def ingest_objects(
    spark: SparkSession,
    lake: Lake,
    listing: DataFrame,
    contents: DataFrame | Reader,
    target_table: str,
    run_id: str,
    schema: T.StructType | str,
    *,
    null_tokens: Sequence[str] = NULL_TOKENS,
    skip_if_done: bool = False,
    **options: str,
) -> DataFrame:
    """Ingest every new or changed JSON object in one job and return the run's log row.

    ``contents`` reads the found objects (``sources.contents``), or is a table ``(key, content)``. What
    was discovered is written first: the state log that the discovery read grows at the end of the run,
    and the run must not see that. Then come the staged rows, the target, the rejects, the state with
    an outcome per object, and last the log. Each step replaces what the same run left there before, the
    target's rows by their ``load_id``, so a run that was stopped anywhere is finished by repeating it.
    """
    read_contents = table_contents(contents) if isinstance(contents, DataFrame) else contents

    def stage(found: DataFrame, earlier: DataFrame, batch: str, fields: T.StructType) -> Staged:
        rows = parse_objects(read_contents(found), fields)
        staged = _staged(lake, rows, batch, fields, null_tokens, CARRIED)
        return Staged(staged, object_outcomes(staged), [batch])

    return _ingest(
        spark, lake, "ingest", lambda earlier: discover(listing, earlier), stage, target_table, run_id,
        _schema(schema), skip_if_done, options,
    )


def run_saved(
    spark: SparkSession,
    lake: Lake,
    target_table: str,
    run_id: str,
    schema: T.StructType | str,
    *,
    null_tokens: Sequence[str] = NULL_TOKENS,
    skip_if_done: bool = False,
    loader: Column | None = None,
    **options: str,
) -> DataFrame:
    """Ingest all sources saved for a target table from their preserved bytes, and return the run's log row.

    These are the ``artifacts_saved`` records, which discovery passes over. A source's loader goes by the ending
    of its key, JSON without a known one, or is told by ``loader``, a column over ``source_key``. JSON documents
    are one load, and so are all sources of another built-in loader that look alike; those of a loader of
    one's own are loaded one by one, for that takes one path. A source becomes ``success`` or, where its
    copy cannot be loaded or is not the bytes noted, ``failed``; the others go on.
    """

    def saved(earlier: DataFrame) -> DataFrame:
        waiting = (F.col("status") == SAVED_STATUS) & (F.col("target_table") == target_table)
        return earlier.where(waiting).select(
            F.col("source_key").alias("key"),
            F.col("source_bucket").alias("bucket"),
            F.col("source_size").alias("size"),
            "etag",
            F.col("source_modified").alias("last_modified"),
            F.lit(True).alias("previously_seen"),
            F.col("status").alias("previous_status"),
        )

    def stage(found: DataFrame, earlier: DataFrame, batch: str, fields: T.StructType) -> Staged:
        return _stage_saved(lake, found, earlier, batch, fields, null_tokens, loader)

    return _ingest(
        spark, lake, "saved", saved, stage, target_table, run_id, _schema(schema), skip_if_done, options
    )


def _stage_saved(
    lake: Lake,
    found: DataFrame,
    earlier: DataFrame,
    batch: str,
    fields: T.StructType,
    null_tokens: Sequence[str],
    loader: Column | None,
) -> Staged:
    """Stage the preserved copies of the found sources, a batch of rows per load."""
    spark, folder = found.sparkSession, f"{lake.restored}/files/{batch}"
    told = loader if loader is not None else loader_of("source_key")
    ids = earlier.select("source_key", F.col("proposal_id").alias("ingestion_id"))
    waiting = found.select(F.col("key").alias("source_key"), "etag", "size").join(ids, "source_key")
    waiting = waiting.select("ingestion_id", "source_key", told.alias("loader"), "etag", "size")
    batches: list[str] = []
    staged: list[DataFrame] = []
    failed = []

    def stage(rows: DataFrame) -> None:
        name = f"{batch}.{len(batches)}"
        batches.append(name)
        staged.append(_staged(lake, rows, name, fields, null_tokens, CARRIED))

    def load(of_loader: str, layout: str, source: str, rows: Callable[[], DataFrame]) -> None:
        """Stage the rows of one load; what fails is noted, for its sources alone."""
        try:
            stage(check_dataset(rows()))
        except Exception as exc:
            failed.append((of_loader, layout, source, str(exc)[:1000]))

    if batch_folders(spark, lake.raw):
        raw = read_table(spark, lake.raw, schemas.RAW_PARTS)
        documents = preserved_contents(raw, waiting.where("loader = 'json'"))
        stage(parse_objects(documents, fields))
        drop_folders(spark, [folder])
        write_batch(restore(raw, waiting.where("loader <> 'json'"), folder), lake.restored, batch)
        for name in subfolders(spark, folder):
            for layout in subfolders(spark, f"{folder}/{name}"):
                place = f"{folder}/{name}/{layout}"
                rows = F.col("_source_key"), F.lit("rows").alias("_kind"), F.lit(True).alias("_is_row"), F.col("*")

                def alike(place=place, name=name, rows=rows):
                    read = load_files(spark, place, name, fields, "_source_key")
                    return read.select(*rows[:3], *(quoted(c) for c in read.columns if c != "_source_key"))

                def single(source, place=place, name=name, rows=rows):
                    read = load_source(spark, f"{place}/{source}", name, fields, keep_corrupt=True)
                    return read.select(F.lit(source).alias("_source_key"), *rows[1:])

                if name in BUILT_IN:
                    load(name, layout, "", alike)
                else:
                    for source in file_names(spark, place):
                        load(name, layout, source, lambda source=source: single(source))
        restored = read_batch(spark, lake.restored, batch, RESTORED)
    else:
        restored = spark.createDataFrame([], RESTORED)
        stage(parse_objects(spark.createDataFrame([], "key string, content binary, error string"), fields))
    rows = reduce(DataFrame.unionByName, staged)
    broken = spark.createDataFrame(failed, "loader string, layout string, source string, message string")
    alike = broken.where("source = ''").select("loader", "layout", "message")
    single = broken.where("source <> ''").select(F.col("source").alias("ingestion_id"), F.col("message").alias("_own"))
    # A file that was written and loaded, and has no row, is done as well.
    loaded = (
        restored.join(alike, ["loader", "layout"], "left")
        .join(single, "ingestion_id", "left")
        .select("ingestion_id", F.coalesce("error", "message", "_own").isNull().alias("_loaded"))
    )
    outcomes = object_outcomes(rows).withColumnRenamed("source_key", "ingestion_id")
    status = F.coalesce("status", F.when(F.col("_loaded"), F.lit(SUCCESS_STATUS)).otherwise(F.lit(FAILED_STATUS)))
    outcomes = waiting.join(loaded, "ingestion_id", "left").join(outcomes, "ingestion_id", "left")
    return Staged(
        rows, outcomes.select("source_key", status.alias("status")), batches,
        waiting.select("ingestion_id", "source_key"), [folder],
    )


def _ingest(
    spark: SparkSession,
    lake: Lake,
    kind: str,
    find: Callable[[DataFrame], DataFrame],
    stage: Callable[[DataFrame, DataFrame, str, T.StructType], Staged],
    target_table: str,
    run_id: str,
    fields: T.StructType,
    skip_if_done: bool,
    options: dict[str, str],
) -> DataFrame:
    """The steps of ``ingest_objects`` for the objects that ``find`` picks, given the state before the run."""
    batch = batch_name(kind, run_id, target_table)
    if skip_if_done and already_done(spark, lake, run_id, target_table):
        return read_batch(spark, lake.runs, batch, schemas.RUN_LOG)
    started = _now()

    def append(good: DataFrame) -> None:
        replace_load(good, target_table, batch, **options)

    with _logged(spark, lake, batch, run_id, target_table, started):
        earlier = load_state(spark, lake.state, batch)
        found = find(earlier).withColumn("last_modified", F.col("last_modified").cast("timestamp"))
        write_batch(found, lake.discovered, batch)
        found = read_batch(spark, lake.discovered, batch, DISCOVERED)
        staged = stage(found, earlier, batch, fields)
        counts = _distribute(lake, staged.rows, batch, append, "_source_key", "_is_row", staged.names)
        finished = _now()
        records = _object_records(found, staged.outcomes, earlier, target_table, run_id, finished)
        write_batch(records, lake.state, batch)
    log = runlog.run_row(
        spark, run_id, target_table, runlog.SUCCEEDED, started, finished, **counts
    )
    write_batch(log, lake.runs, batch)
    for name in staged.batches:
        drop_batch(spark, lake.staged, name)
    drop_folders(spark, staged.folders)
    return read_batch(spark, lake.runs, batch, schemas.RUN_LOG)


def _object_records(
    found: DataFrame,
    outcomes: DataFrame,
    earlier: DataFrame,
    target_table: str,
    run_id: str,
    finished: datetime,
) -> DataFrame:
    """State records of the found objects. What an earlier save of the same content noted is kept."""
    kept = ("raw_bucket", "raw_location", "artifacts", "dependencies")
    before = earlier.select(
        "source_key",
        F.col("etag").alias("_etag"),
        F.col("proposal_id").alias("_proposal_id"),
        *(F.col(c).alias(f"_{c}") for c in kept),
    )
    # A record that points to a preserved copy keeps the name of the save that made it.
    proposal = F.when((F.col("_etag") == F.col("etag")) & F.col("_raw_location").isNotNull(), F.col("_proposal_id"))
    done = F.col("status") == SUCCESS_STATUS
    return (
        found.withColumnRenamed("key", "source_key")
        .join(outcomes.select("source_key", "status"), "source_key", "left")
        .join(before, "source_key", "left")
        .select(
            "source_key",
            F.coalesce("status", F.lit(FAILED_STATUS)).alias("status"),
            F.coalesce(proposal, F.lit(run_id)).alias("proposal_id"),
            F.col("bucket").alias("source_bucket"),
            "etag",
            F.col("size").alias("source_size"),
            F.col("last_modified").alias("source_modified"),
            F.lit(finished).cast("timestamp").alias("processed_at"),
            F.lit(target_table).alias("target_table"),
            F.coalesce(done, F.lit(False)).alias("execution_performed"),
            *(F.when(F.col("_etag") == F.col("etag"), F.col(f"_{c}")).alias(c) for c in kept),
        )
    )
