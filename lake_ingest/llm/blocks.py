"""Blocks: packed rows of about equal bytes, kept in a table bucketed by block.

Operators that need whole texts more than once, together with something that other tasks found out
about them, read the blocks again where they lie; only what was found out is shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lake_ingest.llm.shared import frugal, scratch_path

BLOCK_BYTES = 4 << 20
BLOCKS = "block long, payload binary"
# Of zstandard: an eighth smaller than at its default, and still some 50 MB a second.
LEVEL = 7


def pack(table: pa.Table | pa.RecordBatch, level: int = LEVEL) -> bytes:
    """Compressed bytes of an Arrow table."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=level))
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write(table)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> pa.Table:
    with pa.ipc.open_stream(payload) as reader:
        return reader.read_all()


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _packed(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    partition, block, held, size = TaskContext.get().partitionId(), 0, [], 0

    def flush() -> pa.RecordBatch:
        payload = pack(pa.Table.from_batches(held).combine_chunks())
        return batch(
            block=pa.array([(partition << 32) + block], pa.int64()), payload=pa.array([payload], pa.binary())
        )

    for rows in batches:
        lengths = np.asarray(pa.compute.binary_length(rows["text"]).cast(pa.int64()).fill_null(0)) + 64
        ends, start = np.cumsum(lengths), 0
        while start < len(lengths):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + block_bytes - size, "right")))
            held.append(rows.slice(start, stop - start))
            size += int(ends[stop - 1] - before)
            start = stop
            if size >= block_bytes or start < len(lengths):
                yield flush()
                block, held, size = block + 1, [], 0
    if held:
        yield flush()


def as_blocks(rows: DataFrame, name: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(block, payload)`` of rows with a string column ``text``, in a table bucketed by block."""
    packed = rows.mapInArrow(lambda batches: _packed(batches, block_bytes), BLOCKS)
    return bucketed(packed, "block", name)


def bucketed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """The rows written once to shared storage in a table bucketed by ``key``.

    The number of buckets is the session's number of shuffle partitions, so that what is shuffled by
    the key meets the rows without moving them.
    """
    spark = rows.sparkSession
    table = f"llm_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with frugal(spark):
        rows.write.bucketBy(buckets, key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts on end, and the offsets of the texts; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[places[0] : places[-1]], places - places[0]


def pieces(data: np.ndarray, starts: np.ndarray) -> pa.LargeBinaryArray:
    """Array of the slices of ``data`` that start at ``starts`` and end where the next one starts."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


class Rolling:
    """Fingerprints of slices of a byte array in a few vector steps.

    A slice's fingerprint is a polynomial in an odd base modulo 2 ** 64 with a random word per byte
    value, finally mixed; fingerprints of different seeds are independent.
    """

    SPAN = 1 << 20

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.words = random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(random.integers(1, 2**62)) * 4 + 1
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers = _geometric(self.base, n)
            self.inverse = _geometric(pow(self.base, -1, 2**64), n)

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprints of the slices, both bounds ascending; a span of the bytes in work at a time."""
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            low = starts[at]
            stop = max(at + 1, int(np.searchsorted(ends, low + self.SPAN, "right")))
            part = data[low : ends[stop - 1]]
            self._grow(len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.words[part] * self.powers[: len(part)], out=sums[1:])
            first, last = starts[at:stop] - low, ends[at:stop] - low
            out[at:stop] = (sums[last] - sums[first]) * self.inverse[first]
            at = stop
        return mixed(out)


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices_of(rows: pa.RecordBatch, text_column: str, size: int = 4 << 20):
    """Slices of a batch with about ``size`` bytes of text each, one row at least."""
    lengths = np.asarray(pa.compute.binary_length(rows[text_column]).cast(pa.int64()).fill_null(0))
    ends, start = np.cumsum(lengths), 0
    while start < len(lengths):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield rows.slice(start, stop - start)
        start = stop
