"""Control tables: Parquet folders written one batch at a time."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

BATCH = "batch_id"


def _folder(table: str, batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError(f"not usable as a folder name: {batch_id!r}")
    return f"{table}/{BATCH}={batch_id}"


def write_batch(rows: DataFrame, table: str, batch_id: str, **options: object) -> None:
    """Write one batch's rows to ``table/batch_id=…``.

    A batch that is repeated after a failure replaces its own rows and nobody else's, so a retry adds
    no duplicates and an interrupted batch is repaired by running it again.
    """
    rows.write.mode("overwrite").options(**options).parquet(_folder(table, batch_id))


def drop_batch(spark: SparkSession, table: str, batch_id: str) -> None:
    """Remove one batch's rows, if there are any."""
    drop_folders(spark, [_folder(table, batch_id)])


def read_batch(spark: SparkSession, table: str, batch_id: str, schema: str | T.StructType) -> DataFrame:
    """One batch's rows; the other batches' folders are not even listed."""
    return spark.read.schema(schema).parquet(_folder(table, batch_id))


def read_table(spark: SparkSession, table: str, schema: str) -> DataFrame:
    """All rows with their ``batch_id``; an empty table when nothing was written yet.

    Only a missing folder counts as empty, every other failure is raised.
    """
    full = T.StructType.fromDDL(f"{schema}, {BATCH} string")
    if not batch_folders(spark, table):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(table)


def _files(spark: SparkSession, path: str):
    """Hadoop file system of a path, and the path as it names it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, there = _files(spark, path)
    return files.exists(there)


def batch_folders(spark: SparkSession, table: str) -> list[str]:
    """Folders of the batches written so far, none when there is no table."""
    files, path = _files(spark, table)
    if not files.exists(path):
        return []
    found = [status.getPath() for status in files.listStatus(path)]
    return [str(p.toString()) for p in found if p.getName().startswith(f"{BATCH}=")]


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder but hidden ones, none where it is missing."""
    files, there = _files(spark, path)
    if not files.exists(there):
        return []
    found = [s.getPath().getName() for s in files.listStatus(there) if s.isDirectory()]
    return sorted(name for name in found if name[0] not in "_.")


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder."""
    files, there = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(there) if s.isFile())


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        files, path = _files(spark, folder)
        files.delete(path, True)
