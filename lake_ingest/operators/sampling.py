"""Bounded byte ranges and chunks of objects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.constants import (
    DEFAULT_READ_BYTES,
    ERR_BUCKET,
    ERR_KEY,
    ERR_READS,
    ERR_START,
    ERR_UNREADABLE,
    FIRST_READ_BYTES,
    MAX_READ_BYTES,
    MAX_READS,
    READ_NOTE,
)
from lake_ingest.functions.keys import text_literal
from lake_ingest.functions.text import decode_lossy
from lake_ingest.operators.listing import spread
from lake_ingest.sources.store import join, open_store, read_range, store_options

# Files read per Arrow batch handed back: bounds a Python worker's memory to 16 MiB of content.
_SLICE_ROWS = 256


def validate_reads(requests: DataFrame, buckets: Sequence[str], default_bucket: str) -> DataFrame:
    """Requests ``(bucket, key, start_byte, max_bytes, read_count)`` with ``error`` and defaults set.

    The first failing test names the error; ``max_bytes`` is clamped, never an error. A refused bucket
    is answered with the ``allowed_buckets``. A key may not climb out of its bucket.
    """
    allowed = ", ".join(text_literal(b) for b in buckets)
    error = f"""CASE
        WHEN coalesce(key, '') = '' OR startswith(key, '/') OR key RLIKE r'(^|/)[.][.]?(/|$)'
          THEN {text_literal(ERR_KEY)}
        WHEN start_byte < 0 THEN {text_literal(ERR_START)}
        WHEN read_count > {MAX_READS} THEN {text_literal(ERR_READS)}
        WHEN bucket NOT IN ({allowed}) THEN {text_literal(ERR_BUCKET)} END"""
    wanted = f"coalesce(max_bytes, {DEFAULT_READ_BYTES})"
    return requests.withColumns(
        {
            "bucket": F.expr(f"coalesce(nullif(bucket, ''), {text_literal(default_bucket)})"),
            "start_byte": F.expr("coalesce(start_byte, 0)"),
            "max_bytes": F.expr(f"CAST(greatest(1, least({wanted}, {MAX_READ_BYTES})) AS bigint)"),
            "read_count": F.expr("coalesce(read_count, 0)"),
        }
    ).withColumn("error", F.expr(error)).withColumn(
        "allowed_buckets",
        F.expr(f"CASE WHEN error = {text_literal(ERR_BUCKET)} THEN array_sort(array({allowed})) END"),
    )


def with_offsets(reads: DataFrame) -> DataFrame:
    """Reads with ``bytes_read, next_start_byte, eof``, NULL where nothing could be read."""
    return (
        reads.withColumn("bytes_read", F.expr("CAST(octet_length(content) AS bigint)"))
        .withColumn(
            "next_start_byte",
            F.expr("if(start_byte >= file_size_bytes, file_size_bytes, start_byte + bytes_read)"),
        )
        .withColumn("eof", F.expr("next_start_byte >= file_size_bytes"))
    )


def _with_continuation(reads: DataFrame) -> DataFrame:
    """Answers to requests also say how to go on, unless there was nothing left to read."""
    answers = {"note": F.expr(f"CASE WHEN bytes_read > 0 THEN {text_literal(READ_NOTE)} END")}
    if "read_count" in reads.columns:
        answers["next_read_count"] = F.expr("CASE WHEN bytes_read > 0 THEN read_count + 1 END")
    return reads.withColumns(answers)


def read_table_ranges(requests: DataFrame, body: str) -> DataFrame:
    """Serve valid read requests from a ``body`` column that holds each object's content."""
    raw = f"CAST({body} AS binary)"
    size = f"CAST(octet_length({raw}) AS bigint)"
    piece = f"substring({raw}, CAST(least(start_byte, {size}) + 1 AS int), CAST(max_bytes AS int))"
    read = requests.withColumns(
        {
            "file_size_bytes": F.expr(f"CASE WHEN error IS NULL THEN {size} END"),
            "content": F.expr(f"CASE WHEN error IS NULL THEN {piece} END"),
        }
    ).drop(body)
    return _with_continuation(with_offsets(read))


def read_ranges(
    requests: DataFrame, root: str | Mapping[str, str], tasks: int | None = None
) -> DataFrame:
    """Serve requests ``(key, start_byte, max_bytes, …)`` from files, by seek and read in the tasks.

    ``root`` is one root for all, or the root of each bucket; then a request names its ``bucket``, and
    one of a bucket without a root is refused.

    Adds ``file_size_bytes, content, bytes_read, next_start_byte, eof, note`` and, where requests are
    numbered, ``next_read_count``; a file that cannot be read gives a row with ``error``. Requests are
    spread evenly however the files lie in folders: each read is bounded, so equal numbers of requests
    are equal work.
    """
    requests = requests if "error" in requests.columns else requests.withColumn(
        "error", F.lit(None).cast("string")
    )
    names = requests.columns
    mapped = not isinstance(root, str)
    roots = dict(root) if mapped else {None: root}
    options = store_options(requests.sparkSession)

    def serve(batches):
        stores = {bucket: open_store(path, options) for bucket, path in roots.items()}
        for batch in batches:
            for offset in range(0, batch.num_rows, _SLICE_ROWS):
                part = batch.slice(offset, _SLICE_ROWS)
                rows = part.to_pydict()
                sizes, contents, errors = [], [], []
                buckets = rows["bucket"] if mapped else [None] * part.num_rows
                for bucket, key, start, length, error in zip(
                    buckets, rows["key"], rows["start_byte"], rows["max_bytes"], rows["error"]
                ):
                    size = content = None
                    if error is None and bucket not in stores:
                        error = ERR_BUCKET
                    if error is None:
                        store, base = stores[bucket]
                        try:
                            size, content = read_range(store, join(base, key), start, length)
                        except OSError as exc:
                            error = f"{ERR_UNREADABLE}: {exc}"
                    sizes.append(size)
                    contents.append(content)
                    errors.append(error)
                columns = [
                    pa.array(errors, pa.string()) if name == "error" else part.column(i)
                    for i, name in enumerate(names)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(sizes, pa.int64()), pa.array(contents, pa.binary())],
                    names=[*names, "file_size_bytes", "content"],
                )

    schema = T.StructType(
        [
            *requests.schema.fields,
            T.StructField("file_size_bytes", T.LongType()),
            T.StructField("content", T.BinaryType()),
        ]
    )
    served = spread(requests, tasks, "key", "start_byte").mapInArrow(serve, schema)
    return _with_continuation(with_offsets(served))


def _read_counts(size: str, chunk_bytes: int, max_reads: int) -> str:
    """SQL array 0, 1, … of the chunks sampled; at least one, so an empty object gives its eof row."""
    needed = f"({size} + {chunk_bytes - 1}) DIV {chunk_bytes}"
    return f"sequence(0, CAST(greatest(1, least({max_reads}, {needed})) - 1 AS int))"


def sample_requests(
    listing: DataFrame, chunk_bytes: int = FIRST_READ_BYTES, max_reads: int = MAX_READS
) -> DataFrame:
    """Read requests for the first chunks of every listed file."""
    counts = _read_counts("size", chunk_bytes, max_reads)
    return listing.selectExpr("*", f"explode_outer({counts}) AS read_count").selectExpr(
        "*", f"read_count * {chunk_bytes}L AS start_byte", f"{chunk_bytes}L AS max_bytes"
    )


def sample_files(
    listing: DataFrame,
    root: str,
    chunk_bytes: int = FIRST_READ_BYTES,
    max_reads: int = MAX_READS,
    tasks: int | None = None,
) -> DataFrame:
    """First chunks of every listed file, as bytes and as lossily decoded text."""
    chunks = read_ranges(sample_requests(listing, chunk_bytes, max_reads), root, tasks)
    return chunks.withColumn("text", decode_lossy("content"))


def sample_chunks(
    objects: DataFrame, key: str, body: str, chunk_bytes: int, max_reads: int = MAX_READS
) -> DataFrame:
    """First chunks of objects held in a table.

    The chunks are cut before they are exploded, so a row carries its own chunk only and the whole
    body is not copied once per chunk.
    """
    raw = objects.selectExpr(f"{key} AS key", f"CAST({body} AS binary) AS _raw")
    chunks = f"""transform(
        {_read_counts('octet_length(_raw)', chunk_bytes, max_reads)},
        i -> named_struct(
            'read_count', i,
            'start_byte', i * {chunk_bytes}L,
            'content', substring(_raw, i * {chunk_bytes} + 1, {chunk_bytes})))"""
    # inline_outer: the plain form would add a filter that cuts every chunk a second time.
    sampled = raw.selectExpr(
        "key", "CAST(octet_length(_raw) AS bigint) AS file_size_bytes", f"{chunks} AS _chunks"
    ).select("key", "file_size_bytes", F.inline_outer("_chunks"))
    return with_offsets(sampled)
