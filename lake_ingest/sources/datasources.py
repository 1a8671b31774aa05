"""Two Spark data sources over plain files: their listing, and byte ranges of one of them."""

from __future__ import annotations

from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lake_ingest import schemas
from lake_ingest.constants import (
    FIRST_READ_BYTES,
    MAX_READ_BYTES,
    MAX_READS,
)
from lake_ingest.sources.store import StoreOptions, join, open_store, read_range, subfolders, walk

_BATCH_ROWS = 10_000


class FolderPartition(InputPartition):
    """Folders for one task: ``whole`` ones with all below them, ``flat`` ones without subfolders."""

    def __init__(self, number: int, flat: list[str], whole: list[str]):
        super().__init__(number)
        self.flat = flat
        self.whole = whole


class ObjectListing(DataSource):
    """``spark.read.format("object_listing").option("path", root).load()``

    Every file below the root, with zero-byte and hidden ones, which ``binaryFile`` leaves out.
    Options: ``prefix`` restricts the listing to one folder, ``bucket`` labels the rows, ``depth``
    (default 1) says how many levels of folders are dealt out to tasks, ``tasks`` how many tasks share
    them at most.
    """

    @classmethod
    def name(cls):
        return "object_listing"

    def schema(self):
        return schemas.LISTING

    def reader(self, schema):
        return ObjectListingReader(self.options)


class ObjectListingReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.prefix = options.get("prefix", "").strip("/")
        self.bucket = options.get("bucket", "incoming")
        self.depth = int(options.get("depth", "1"))
        self.tasks = int(options.get("tasks", "32"))
        self.store = StoreOptions.of_option(options)

    def partitions(self):
        store, base = open_store(self.root, self.store)
        if store.get_file_info(base).type != fs.FileType.Directory:
            raise FileNotFoundError(f"no such folder: {self.root}")
        level, flat = [join(base, self.prefix) if self.prefix else base], []
        for _ in range(self.depth):
            flat += level
            level = [path for folder in level for path in subfolders(store, folder)]
        tasks = max(1, min(self.tasks, len(flat) + len(level)))
        return [FolderPartition(i, flat[i::tasks], level[i::tasks]) for i in range(tasks)]

    def read(self, partition):
        store, base = open_store(self.root, self.store)
        strip = len(base.rstrip("/")) + 1
        rows = []
        files = chain(
            *(walk(store, folder, recursive=False) for folder in partition.flat),
            *(walk(store, folder) for folder in partition.whole),
        )
        for info in files:
            rows.append((info.path[strip:], self.bucket, info.size, info.mtime_ns // 1000))
            if len(rows) == _BATCH_ROWS:
                yield self._batch(rows)
                rows = []
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows):
        keys, buckets, sizes, micros = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.string()),
                pa.array(buckets, pa.string()),
                pa.array(sizes, pa.int64()),
                pa.array(micros, pa.timestamp("us", tz="UTC")),
            ],
            names=["key", "bucket", "size", "last_modified"],
        )


class RangePartition(InputPartition):
    def __init__(self, read_count: int, start: int):
        super().__init__(start)
        self.read_count = read_count
        self.start = start


class ByteRange(DataSource):
    """``spark.read.format("byte_range").option("path", file).load()``

    Successive byte ranges of one file, one partition each, empty past the end of the file.
    Options: ``start_byte``, ``max_bytes`` (clamped to 1 .. 65,536) and ``reads`` (at most five).
    Ranges of many files are read by ``operators.sampling.read_ranges``.
    """

    @classmethod
    def name(cls):
        return "byte_range"

    def schema(self):
        return (
            "path string, read_count int, file_size_bytes bigint, start_byte bigint, "
            "content binary, bytes_read bigint, next_start_byte bigint, eof boolean"
        )

    def reader(self, schema):
        return ByteRangeReader(self.options)


class ByteRangeReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.store = StoreOptions.of_option(options)
        self.start = int(options.get("start_byte", "0"))
        self.max_bytes = max(
            1, min(int(options.get("max_bytes", str(FIRST_READ_BYTES))), MAX_READ_BYTES)
        )
        self.reads = max(1, min(int(options.get("reads", "1")), MAX_READS))
        if self.start < 0:
            raise ValueError("start_byte must be non-negative")

    def partitions(self):
        return [RangePartition(i, self.start + i * self.max_bytes) for i in range(self.reads)]

    def read(self, partition):
        store, path = open_store(self.path, self.store)
        size, content = read_range(store, path, partition.start, self.max_bytes)
        if not content and partition.read_count:
            return
        end = partition.start + len(content) if content else size
        yield (
            self.path,
            partition.read_count,
            size,
            partition.start,
            content,
            len(content),
            end,
            end >= size,
        )


def register_sources(spark: SparkSession) -> None:
    spark.dataSource.register(ObjectListing)
    spark.dataSource.register(ByteRange)
