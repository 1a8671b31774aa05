"""WARC archives: a deterministic sharded writer and a reader.

Records are sorted by page and payload digest into shards whose bounds come from the rows with the
smallest hashes, so the same rows give the same files, byte for byte, on any cluster. Each task writes
its shard as gzip members of one record, starts a new file when the compressed size reaches a limit,
and regenerates headers and digests from the payload. Files get temporary names until the shard is
complete; then they are renamed, and their manifest rows are committed by Spark. Only files in a
committed manifest are ever read: what a lost or speculative task leaves behind does not count, and a
task that runs again replaces its files with equal ones.

Of records with equal payloads the one of the largest page is the response; the others revisit it and
carry no payload through the sort. Payloads below ``least_bytes`` are always responses.

Defined results: a null payload is empty; a null page sorts first and is the response only among null
pages; of rows equal in page and payload the first by address is the response; a null address is
written as a ``urn:page:`` name; an empty table gives no files and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.llm.shared import frugal, sampled, saved
from lake_ingest.sources.store import join, open_store

DATE = "2024-01-01T00:00:00Z"
ROLL_BYTES = 256 << 20
# Payload bytes of a shard.
SHARD_BYTES = 32 << 20
# About so many rows give the shards' bounds, whatever the size of the table.
BOUND_ROWS = 20_000
LEVEL = 6
# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "shard int, part int, file string, records long, bytes long, sha256 string"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary, file string"
)


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five bytes, ten hexadecimal digits, are eight characters."""
    digits = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digits, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)
    ]
    return F.translate(
        F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0
) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, digest, response_of)`` per page.

    ``response_of`` is the page of the response where the payload occurs more than once; then only
    that page's rows keep the payload.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload")
    ).select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        payload_digest(F.col("payload")).alias("digest"),
    )
    repeated = (
        rows.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_of"), F.count("*").alias("_n"))
        .where("_n > 1")
        .withColumn("repeated", F.lit(True))
        .drop("_n")
    )
    marked = rows.join(saved(repeated, "repeated"), "digest", "left").withColumn(
        "repeated", F.coalesce("repeated", F.lit(False)) & (F.col("payload_bytes") >= least_bytes)
    )
    needed = ~F.col("repeated") | F.col("page_id").eqNullSafe(F.col("response_of"))
    return marked.select(
        "page_id", "url", F.when(needed, F.col("payload")).alias("payload"), "payload_bytes", "digest",
        "response_of", "repeated",
    )


def _order(page: int | None, digest: str) -> tuple:
    return (page is not None, page or 0, digest)


def shard_bounds(rows: DataFrame, shards: int) -> list[tuple]:
    """Where the shards end: quantiles of the about ``BOUND_ROWS`` rows with the smallest hashes."""
    light = rows.select("page_id", "digest")
    sample = sampled(light, ["page_id", "digest"], light.count(), BOUND_ROWS)
    keys = sorted(_order(r.page_id, r.digest) for r in sample.collect())
    return [keys[len(keys) * i // shards] for i in range(1, shards)] if keys else []


def _named(name: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _sha1(content: bytes) -> str:
    return base64.b32encode(hashlib.sha1(content).digest()).decode()


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    content = VERSION + lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return packer.compress(content) + packer.flush()


def _info(name: str) -> bytes:
    return _record(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", _named(f"info|{name}")),
            ("WARC-Date", DATE),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ],
        b"format: WARC File Format 1.1\r\n",
    )


def page_record(row: dict, nth: int) -> bytes:
    """The record of a row, the ``nth`` of its page and digest; headers are made anew from the payload."""
    page, first = row["page_id"], row["response_of"]
    response = not row["repeated"] or (page == first and nth == 0)
    payload = row["payload"] or b""
    digest = _sha1(payload) if response else row["digest"]
    if digest != row["digest"]:
        raise ValueError(f"page {page}: the payload changed between two reads")
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    block = http + payload if response else http
    name = f"response|{page}|{digest}"
    target = quote(row["url"], safe="%/:=&?~#+!$,;'@()*[]-._") if row["url"] else f"urn:page:{page}"
    headers = [
        ("WARC-Type", "response" if response else "revisit"),
        ("WARC-Record-ID", _named(name if nth == 0 else f"{name}|{nth}")),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{_sha1(block)}"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if page is not None:
        headers.append(("X-Page-Id", str(page)))
    if not response:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _named(f"response|{first}|{digest}"))]
        if first is not None:
            headers.append(("X-Refers-To-Page-Id", str(first)))
    return _record(headers, block)


class ShardFiles:
    """The files of one shard: temporary names first, the final ones when the shard is complete."""

    def __init__(self, root: str, shard: int, roll_bytes: int):
        self.store, self.base = open_store(root)
        self.shard, self.roll_bytes = shard, roll_bytes
        self.attempt = uuid.uuid4().hex
        self.done, self.file = [], None

    def _open(self) -> None:
        self.name = f"pages-{self.shard:06d}-{len(self.done):05d}.warc.gz"
        self.file = self.store.open_output_stream(self._temporary(self.name))
        self.records, self.bytes, self.hash = 0, 0, hashlib.sha256()
        self._put(_info(self.name))

    def _temporary(self, name: str) -> str:
        return join(self.base, f".{name}.{self.attempt}.tmp")

    def _put(self, content: bytes) -> None:
        self.file.write(content)
        self.hash.update(content)
        self.bytes += len(content)

    def write(self, record: bytes) -> None:
        if self.file is None:
            self._open()
        self._put(record)
        self.records += 1
        if self.bytes >= self.roll_bytes:
            self._close()

    def _close(self) -> None:
        self.file.close()
        self.file = None
        self.done.append(
            (self.shard, len(self.done), self.name, self.records, self.bytes, self.hash.hexdigest())
        )

    def _sha256(self, path: str) -> str:
        with self.store.open_input_stream(path, compression=None) as file:
            return hashlib.file_digest(file, "sha256").hexdigest()

    def commit(self) -> list[tuple]:
        if self.file is not None:
            self._close()
        for _, _, name, _, size, sha256 in self.done:
            final = join(self.base, name)
            there = self.store.get_file_info(final)
            if there.type == fs.FileType.File and there.size == size and self._sha256(final) == sha256:
                self.store.delete_file(self._temporary(name))
            else:
                self.store.move(self._temporary(name), final)
        return self.done


def write_archives(
    rows: DataFrame, root: str, shards: int | None = None, roll_bytes: int = ROLL_BYTES
) -> DataFrame:
    """Write the rows of ``records`` below ``root``; the committed manifest.

    ``shards`` defaults to one for every ``SHARD_BYTES`` of payloads, so that the archives are the same on any
    cluster.
    """
    spark = rows.sparkSession
    if not shards:
        total = rows.agg(F.sum("payload_bytes")).first()[0] or 0
        shards = max(1, -(-total // SHARD_BYTES))
    bounds = shard_bounds(rows, shards)
    store, base = open_store(root)
    store.create_dir(base, recursive=True)

    def deal(batches):
        for batch in batches:
            keys = zip(batch["page_id"].to_pylist(), batch["digest"].to_pylist())
            shard = pa.array([bisect.bisect_right(bounds, _order(*key)) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shard], names=[*batch.schema.names, "shard"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, last, nth = None, None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if files is None:
                    files = ShardFiles(root, row["shard"], roll_bytes)
                key = (row["page_id"], row["digest"])
                nth = nth + 1 if key == last else 0
                last = key
                files.write(page_record(row, nth))
        if files is not None:
            columns = zip(*files.commit())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, _MANIFEST_TYPES)], names=_MANIFEST_NAMES
            )

    dealt = (
        rows.mapInArrow(deal, T.StructType([*rows.schema.fields, T.StructField("shard", T.IntegerType())]))
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("page_id", "digest", "url")
    )
    with frugal(spark):
        dealt.mapInArrow(write, MANIFEST).write.json(join(root, "manifest"))
    return read_manifest(spark, root)


_MANIFEST_NAMES = [f.split()[0] for f in MANIFEST.split(", ")]
_MANIFEST_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(join(root, "manifest"))


def _headers(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def parse(stream) -> Iterator[dict]:
    """Records of an uncompressed archive, one in memory at a time; digests are verified."""
    while stream.readline():
        headers = _headers(stream)
        block = stream.read(int(headers["content-length"]))
        stream.read(4)
        kind = headers["warc-type"]
        if kind == "warcinfo":
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
        size = int(http.rpartition(b"Content-Length: ")[2])
        if kind == "response" and (_sha1(payload) != digest or len(payload) != size):
            raise ValueError(f"record {headers['warc-record-id']}: the payload does not match its headers")
        number = lambda name: int(headers[name]) if name in headers else None
        yield {
            "page_id": number("x-page-id"),
            "url": headers.get("warc-target-uri"),
            "payload_bytes": size,
            "payload_digest": digest,
            "record_type": kind,
            "refers_to": number("x-refers-to-page-id"),
            "payload": payload if kind == "response" else None,
        }


class Told:
    """A stream that notes the number and the hash of the bytes read from it."""

    def __init__(self, raw):
        self.raw, self.bytes, self.hash = raw, 0, hashlib.sha256()

    def read(self, n: int = -1) -> bytes:
        content = self.raw.read(None if n < 0 else n)
        self.bytes += len(content)
        self.hash.update(content)
        return content


def read_archives(spark: SparkSession, root: str, batch_bytes: int = 8 << 20) -> DataFrame:
    """One row per page record of the archives in the committed manifest; see ``RECORDS``."""
    names = [f.split()[0] for f in RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names
        )

    def read(batches):
        store, base = open_store(root)
        for batch in batches:
            for name, n_bytes, sha256 in zip(*(batch[c].to_pylist() for c in ("file", "bytes", "sha256"))):
                rows, size = [], 0
                with store.open_input_stream(join(base, name), compression=None) as raw:
                    told = Told(raw)
                    for record in parse(gzip.open(told)):
                        rows.append(record | {"file": name})
                        size += len(record["payload"] or b"") + 200
                        if size >= batch_bytes:
                            yield batch_of(rows)
                            rows, size = [], 0
                if (told.bytes, told.hash.hexdigest()) != (n_bytes, sha256):
                    raise ValueError(f"{name}: not the file that the manifest names")
                if rows:
                    yield batch_of(rows)

    manifest = read_manifest(spark, root)
    tasks = max(1, manifest.count())
    return manifest.select("file", "bytes", "sha256").repartitionByRange(tasks, "file").mapInArrow(read, RECORDS)
