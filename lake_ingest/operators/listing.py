"""Operators over object listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.constants import BLOCK_PARTS, PART_BYTES
from lake_ingest.sources.datasources import register_sources
from lake_ingest.sources.store import hash_range, join, open_store, store_options


def list_objects(
    spark: SparkSession, root: str, bucket: str = "incoming", prefix: str = "", depth: int = 1
) -> DataFrame:
    """Files below a folder, listed by the executors."""
    register_sources(spark)
    tasks = str(spark.sparkContext.defaultParallelism)
    return (
        spark.read.format("object_listing")
        .options(path=root, bucket=bucket, prefix=prefix, depth=str(depth), tasks=tasks)
        .options(**store_options(spark).as_option())
        .load()
    )


def table_listing(
    objects: DataFrame, key: str, body: str, bucket: str = "incoming", last_modified: Column | None = None
) -> DataFrame:
    """Listing of objects kept as rows of a table: size and content hash of ``body``."""
    content = f"CAST({body} AS binary)"
    return objects.select(
        F.col(key).alias("key"),
        F.lit(bucket).alias("bucket"),
        F.expr(f"CAST(octet_length({content}) AS bigint) AS size"),
        content_etag(content).alias("etag"),
        (F.lit(None).cast("timestamp_ntz") if last_modified is None else last_modified).alias(
            "last_modified"
        ),
    )


def under_prefix(listing: DataFrame, prefix: str) -> DataFrame:
    """Objects below one folder; an empty prefix keeps all."""
    folder = prefix.strip("/")
    return listing.where(F.startswith("key", F.lit(folder + "/"))) if folder else listing


def drop_markers(listing: DataFrame) -> DataFrame:
    """Without directory markers, keys that end in ``/``."""
    return listing.where(~F.endswith("key", F.lit("/")))


def split_into_parts(objects: DataFrame, smallest: int = PART_BYTES) -> DataFrame:
    """One row ``(…, part, start_byte, length)`` per part of a fixed length; an empty object has one empty part."""
    parts = f"explode_outer(sequence(0L, greatest(0L, (size - 1) DIV {smallest}))) AS part"
    return (
        objects.select("*", F.expr(parts))
        .withColumn("start_byte", F.expr(f"part * {smallest}L"))
        .withColumn("length", F.expr(f"least({smallest}L, size - start_byte)"))
    )


def spread(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """Hash rows that stand for file reads over a fixed number of tasks.

    The number is given outright because adaptive execution would merge partitions by the size of
    these small rows, and so put all the reading they cause into one task.
    """
    tasks = tasks or max(
        int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        rows.sparkSession.sparkContext.defaultParallelism,
    )
    return rows.repartition(tasks, *keys)


def _tree_etag(digests: str, parts: str) -> str:
    """SQL that joins an array of digests into one; ``parts`` is the number of parts of the object."""
    return f"""if({parts} = 1, {digests}[0],
        concat(if(size({digests}) = 1, {digests}[0], md5(unhex(array_join({digests}, '')))), '-', {parts}))"""


def _block_digest(digests: str) -> str:
    """SQL of the digest of a block of parts; that of a single part is the part's own."""
    return f"if(size({digests}) = 1, {digests}[0], md5(unhex(array_join({digests}, ''))))"


def content_etag(content: str, smallest: int = PART_BYTES, block_parts: int = BLOCK_PARTS) -> Column:
    """Fingerprint of a binary column, the same as that of a file with this content.

    One part: its MD5. Several: the MD5 of the binary MD5s of the parts on end, ``-``, their number. The
    digests are joined by blocks of parts, and the blocks' digests in the same way where there are
    several, so that no group grows with the object.
    """
    parts = f"((octet_length({content}) - 1) DIV {smallest} + 1)"
    # The names of the lambdas' variables must not be those of columns.
    block = f"""transform(
        sequence(_block * {block_parts}, least({parts}, (_block + 1) * {block_parts}) - 1),
        _part -> md5(substring({content}, CAST(_part * {smallest} + 1 AS int), {smallest})))"""
    blocks = f"""transform(sequence(0, ({parts} - 1) DIV {block_parts}), _block -> {_block_digest(block)})"""
    return F.expr(
        f"if(octet_length({content}) <= {smallest}, md5({content}), {_tree_etag(blocks, parts)})"
    )


def combine_part_hashes(
    parts: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, str] | None = None,
    block_parts: int = BLOCK_PARTS,
) -> DataFrame:
    """Fingerprint per object from ``(part, part_md5)`` rows; a block of parts bounds each group.

    ``sums`` names columns to add up over the parts and take along. An object with a part that
    could not be read has no fingerprint.
    """

    def ordered(position: str, digest: str) -> str:
        return f"""transform(array_sort(collect_list(named_struct('at', {position}, 'md5', {digest}))), p -> p.md5)"""

    sums = sums or {}
    blocks = (
        parts.groupBy(*keys, F.expr(f"part DIV {block_parts} AS _block"))
        .agg(
            F.expr(f"{ordered('part', 'part_md5')} AS _digests"),
            F.expr("count(*) AS _n"),
            F.expr("count(part_md5) = count(*) AS _whole"),
            *[F.sum(column).alias(name) for name, column in sums.items()],
        )
        .withColumn("_digest", F.expr(_block_digest("_digests")))
    )
    return (
        blocks.groupBy(*keys)
        .agg(
            F.expr(f"{ordered('_block', '_digest')} AS _digests"),
            F.expr("sum(_n) AS _parts"),
            F.expr("bool_and(_whole) AS _whole"),
            *[F.sum(name).alias(name) for name in sums],
        )
        .withColumn("etag", F.expr(f"CASE WHEN _whole THEN {_tree_etag('_digests', '_parts')} END"))
        .drop("_digests", "_parts", "_whole")
    )


def _digest(store, base: str, key: str, start: int, length: int) -> str | None:
    """MD5 of a part, None where it cannot be read."""
    try:
        return hash_range(store, join(base, key), start, length)
    except OSError:
        return None


def _fingerprint(
    listing: DataFrame, root: str, smallest: int, tasks: int | None, block_parts: int = BLOCK_PARTS
) -> DataFrame:
    """Listing, with ``_known`` fingerprints where there is nothing to read, to listing with ``etag``.

    The listing is used once, so that it is one and the same for all files.
    """
    carried = [*(c for c in listing.columns if c != "_known"), "part"]

    options = store_options(listing.sparkSession)

    def hash_parts(batches):
        store, base = open_store(root, options)
        for batch in batches:
            digests = [
                known if known is not None else _digest(store, base, key, start, length)
                for known, key, start, length in zip(
                    batch["_known"].to_pylist(),
                    batch["key"].to_pylist(),
                    batch["start_byte"].to_pylist(),
                    batch["length"].to_pylist(),
                )
            ]
            kept = [batch[name] for name in carried]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(digests, pa.string())], names=[*carried, "part_md5"]
            )

    # A known file counts as empty: it gets a single part, and the hash of that is what is known.
    work = listing.withColumns(
        {"_size": F.col("size"), "size": F.expr("if(_known IS NULL, size, 0L)")}
    )
    parts = split_into_parts(work, smallest).withColumn("size", F.col("_size")).drop("_size")
    hashed_schema = T.StructType(
        [*parts.select(*carried).schema.fields, T.StructField("part_md5", T.StringType())]
    )
    hashes = spread(parts, tasks, "key", "part").mapInArrow(hash_parts, hashed_schema)
    return combine_part_hashes(hashes, carried[:-1], block_parts=block_parts)


def fingerprint(
    listing: DataFrame,
    root: str,
    smallest: int = PART_BYTES,
    tasks: int | None = None,
    block_parts: int = BLOCK_PARTS,
) -> DataFrame:
    """Listing with the ``etag`` of each file's content, hashed in parts by many tasks.

    A file that cannot be read any more has a NULL ``etag``.
    """
    unknown = F.lit(None).cast("string")
    return _fingerprint(listing.withColumn("_known", unknown), root, smallest, tasks, block_parts)


def fingerprint_changed(
    listing: DataFrame,
    state: DataFrame,
    root: str,
    smallest: int = PART_BYTES,
    tasks: int | None = None,
) -> DataFrame:
    """As ``fingerprint``, but a file whose size and time equal its state record keeps the old etag.

    Only the other files are read. An edit that keeps the size within one tick of the file system's
    clock goes unnoticed, so ``fingerprint`` is the default elsewhere.
    """
    known = state.where(F.nullif(F.col("etag"), F.lit("")).isNotNull()).select(
        F.col("source_key").alias("key"),
        F.col("source_size").alias("size"),
        F.col("source_modified").alias("last_modified"),
        F.col("etag").alias("_known"),
    )
    marked = listing.join(known, ["key", "size", "last_modified"], "left")
    return _fingerprint(marked, root, smallest, tasks).select(*listing.columns, "etag")
