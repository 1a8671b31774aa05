"""Readers of whole objects for ``plans.run_ingestion.ingest_objects``.

A reader takes the found objects ``(key, size, …)`` and gives ``(key, content, error)``, one row per
object; ``error`` says why there is no content.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lake_ingest.constants import ERR_UNREADABLE
from lake_ingest.operators.listing import spread
from lake_ingest.sources.store import join, open_store, store_options

Reader = Callable[[DataFrame], DataFrame]

CONTENTS = "key string, content binary, error string"
# Bytes read by one task, and handed back in one Arrow batch.
TASK_BYTES = 128 * 1024 * 1024
BATCH_BYTES = 16 * 1024 * 1024
# The most that a row, and an Arrow batch of one, can hold.
MAX_CONTENT = (1 << 31) - (1 << 20)
TOO_LARGE = f"{ERR_UNREADABLE}: too large for one row"


def file_contents(root: str, tasks: int | None = None) -> Reader:
    """Reader of files below a root: only the found ones are opened, by tasks of about equal bytes."""

    schema = pa.schema([("key", pa.string()), ("content", pa.binary()), ("error", pa.string())])

    def contents(found: DataFrame) -> DataFrame:
        options = store_options(found.sparkSession)

        def read(batches):
            store, base = open_store(root, options)
            for batch in batches:
                rows, held = [], 0
                for key in batch["key"].to_pylist():
                    content = error = None
                    try:
                        with store.open_input_file(join(base, key)) as file:
                            if file.size() > MAX_CONTENT:
                                raise OSError(TOO_LARGE)
                            content = file.read()
                    except OSError as exc:
                        error = str(exc) if str(exc) == TOO_LARGE else f"{ERR_UNREADABLE}: {exc}"
                    rows.append({"key": key, "content": content, "error": error})
                    held += len(content or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

        total = found.agg(F.sum("size")).first()[0] or 0
        least = found.sparkSession.sparkContext.defaultParallelism
        work = spread(found.select("key"), tasks or max(least, ceil(total / TASK_BYTES)), "key")
        return work.mapInArrow(read, CONTENTS)

    return contents


def table_contents(contents: DataFrame) -> Reader:
    """Reader of objects whose content is a column of a table ``(key, content)``.

    Here the contents themselves go through the join, and are shuffled where the found keys are too many
    to be broadcast; nothing else tells a table's rows apart.
    """

    def read(found: DataFrame) -> DataFrame:
        held = contents.selectExpr("key", "CAST(content AS binary) AS content")
        missing = F.lit(f"{ERR_UNREADABLE}: not found")
        return (
            found.select("key")
            .join(held, "key", "left")
            .withColumn("error", F.when(F.col("content").isNull(), missing))
        )

    return read
