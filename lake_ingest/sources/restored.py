"""Preserved copies, read by the tasks that need them or laid out as files again, so that any loader can read them.

What was saved is rows of parts in the raw table. For a run the waiting sources' parts are looked up by their
identifiers alone; tasks then open just the raw files and row groups that hold them, and go through a file in the
order of its rows, so that a group is read once, not once for each source in it. JSON documents become rows
there; other sources are written as one file each below the run's folder, a part at a time. No content passes
through a join or an exchange, and what a run reads of the raw table is the row groups of its own sources.

A file lies in a folder of its loader and layout, so that one load reads all sources that look alike. The
layout of CSV is its header, of Parquet and ORC its schema.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs, orc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lake_ingest.constants import BLOCK_PARTS, ERR_UNREADABLE
from lake_ingest.operators.listing import spread
from lake_ingest.sources.contents import BATCH_BYTES, CONTENTS, MAX_CONTENT, TOO_LARGE
from lake_ingest.sources.loaders import EXTENSIONS
from lake_ingest.sources.store import StoreOptions, open_store, open_uri, store_options

RESTORED = "ingestion_id string, source_key string, loader string, layout string, error string"
SPOILT = f"{ERR_UNREADABLE}: the preserved bytes are not those of the source"
# Folder of files that are being written; Spark's readers pass over such a name.
DRAFTS = "_drafts"
# Raw files a task holds open, and bytes of a file's start in which a header is looked for.
_OPEN = 16
_HEADER_BYTES = 1 << 20
# Rows of a raw file that stay together in a task, for a file may hold very many small sources.
_TASK_ROWS = 1 << 16


def loader_of(key: str, default: str = "json") -> Column:
    """Name of the loader for a key, by its ending."""
    lower, found = F.lower(F.col(key)), F.lit(default)
    for ending, name in EXTENSIONS.items():
        found = F.when(F.endswith(lower, F.lit(ending)), name).otherwise(found)
    return found


class Fingerprint:
    """The fingerprint of content that comes in parts, as ``listing.content_etag`` has it."""

    def __init__(self):
        self.digests: list[bytes] = []
        self.blocks: list[bytes] = []
        self.parts = 0

    def add(self, part: bytes) -> None:
        self.digests.append(hashlib.md5(part).digest())
        self.parts += 1
        if len(self.digests) == BLOCK_PARTS:
            self._end_block()

    def _end_block(self) -> None:
        if self.digests:
            self.blocks.append(_one(self.digests))
            self.digests = []

    def etag(self) -> str:
        self._end_block()
        return self.blocks[0].hex() if self.parts == 1 else f"{_one(self.blocks).hex()}-{self.parts}"


def _one(digests: list[bytes]) -> bytes:
    return digests[0] if len(digests) == 1 else hashlib.md5(b"".join(digests)).digest()


class RawFiles:
    """Parts by their row out of raw files; a few files stay open, and the row group read last."""

    def __init__(self, options: StoreOptions):
        self.options = options
        # With a file the numbers of the rows its row groups begin with.
        self.open: OrderedDict[str, tuple[pq.ParquetFile, list[int]]] = OrderedDict()
        self.group: tuple[str, int] | None = None
        self.content: pa.ChunkedArray | None = None

    def part(self, path: str, row: int) -> bytes:
        if path not in self.open:
            store, place = open_uri(path, self.options)
            file = pq.ParquetFile(store.open_input_file(place))
            sizes = (file.metadata.row_group(group).num_rows for group in range(file.num_row_groups))
            self.open[path] = (file, [0, *accumulate(sizes)])
            if len(self.open) > _OPEN:
                self.open.popitem(last=False)
        file, starts = self.open[path]
        group = bisect_right(starts, row) - 1
        if self.group != (path, group):
            self.content = file.read_row_group(group, ["content"])["content"]
            self.group = (path, group)
        return self.content[row - starts[group]].as_py()


def _layout(loader: str, store: fs.FileSystem, path: str) -> str:
    if loader == "parquet":
        with store.open_input_file(path) as file:
            return str(pq.read_schema(file).remove_metadata())
    if loader == "orc":
        with store.open_input_file(path) as file:
            return str(orc.ORCFile(file).schema)
    if loader.startswith("csv"):
        with store.open_input_stream(path) as file:
            found = re.match(rb"[\r\n]*([^\r\n]+)", file.read(_HEADER_BYTES))
        if not found:
            raise ValueError("no header")
        return found[1].decode("utf-8", "replace")
    return ""


def _work(raw: DataFrame, waiting: DataFrame, tasks: int | None) -> DataFrame:
    """The waiting sources with the places of their parts, those in one raw file together and in its order."""
    # Identifiers and places only: the content is not among the columns that are read here.
    place = F.struct("part", F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row"))
    first = F.try_element_at("parts", F.lit(1))
    work = (
        waiting.join(raw.select("ingestion_id", place.alias("_at")), "ingestion_id", "left")
        .groupBy("ingestion_id", "source_key", "loader", "etag", "size")
        .agg(F.array_sort(F.collect_list("_at")).alias("parts"))
        .withColumn("_first", F.coalesce(first["path"], F.col("ingestion_id")))
        .withColumn("_row", first["row"])
        .withColumn("_rows", F.expr(f"_row DIV {_TASK_ROWS}"))
    )
    order = ("_first", "_row", "ingestion_id")
    return spread(work, tasks, "_first", "_rows").sortWithinPartitions(*order).drop("_first", "_row", "_rows")


def _parts(files: RawFiles, row: dict) -> Iterator[bytes]:
    """A source's parts in order; an error at their end if they are not its bytes."""
    parts, found, size = row["parts"], Fingerprint(), 0
    if not parts or [p["part"] for p in parts] != list(range(len(parts))):
        raise ValueError(SPOILT)
    for part in parts:
        content = files.part(part["path"], part["row"])
        found.add(content)
        size += len(content)
        yield content
    if (size, found.etag()) != (row["size"], row["etag"]):
        raise ValueError(SPOILT)


def preserved_contents(raw: DataFrame, waiting: DataFrame, tasks: int | None = None) -> DataFrame:
    """``(key, content, error)`` of waiting sources ``(ingestion_id, source_key, loader, etag, size)``.

    The key is the ingestion's identifier. A source too large for a row is an error.
    """

    options = store_options(raw.sparkSession)

    def read(batches):
        files = RawFiles(options)
        for batch in batches:
            rows, held = [], 0
            for row in batch.to_pylist():
                content = error = None
                try:
                    if (row["size"] or 0) > MAX_CONTENT:
                        raise ValueError(TOO_LARGE)
                    content = b"".join(_parts(files, row))
                except (OSError, KeyError) as exc:
                    error = f"{ERR_UNREADABLE}: {exc}"
                except ValueError as exc:
                    error = str(exc)
                rows.append({"key": row["ingestion_id"], "content": content, "error": error})
                held += len(content or b"")
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("key", pa.string()), ("content", pa.binary()), ("error", pa.string())])
    return _work(raw, waiting, tasks).mapInArrow(read, CONTENTS)


def restore(raw: DataFrame, waiting: DataFrame, folder: str, tasks: int | None = None) -> DataFrame:
    """``RESTORED``, a row per waiting source ``(ingestion_id, source_key, loader, etag, size)``, and its file written.

    The file is ``folder/<loader>/<md5 of the layout>/<ingestion_id>``. ``error`` says why there is none: a part
    is missing, the bytes do not have the source's fingerprint, or the file has no layout its loader could read.
    """

    options = store_options(raw.sparkSession)

    def write(batches):
        store, base = open_store(folder, options)
        files = RawFiles(options)
        for batch in batches:
            for row in batch.to_pylist():
                layout = error = None
                try:
                    layout = _write(store, base, files, row)
                except (OSError, KeyError) as exc:
                    error = f"{ERR_UNREADABLE}: {exc}"
                except ValueError as exc:
                    error = str(exc)
                out = {n: row[n] for n in ("ingestion_id", "source_key", "loader")}
                yield pa.RecordBatch.from_pylist([out | {"layout": layout, "error": error}], schema)

    schema = pa.schema([(n, pa.string()) for n in ("ingestion_id", "source_key", "loader", "layout", "error")])
    return _work(raw, waiting, tasks).mapInArrow(write, RESTORED)


def _write(store: fs.FileSystem, base: str, files: RawFiles, row: dict) -> str:
    """Write a source's file and return its layout's folder."""
    draft = f"{base}/{DRAFTS}/{row['ingestion_id']}"
    store.create_dir(f"{base}/{DRAFTS}", recursive=True)
    with store.open_output_stream(draft) as file:
        for content in _parts(files, row):
            file.write(content)
    layout = hashlib.md5(_layout(row["loader"], store, draft).encode()).hexdigest()
    place = f"{base}/{row['loader']}/{layout}"
    store.create_dir(place, recursive=True)
    store.move(draft, f"{place}/{row['ingestion_id']}")
    return layout
