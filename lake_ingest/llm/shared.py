"""Helpers that several operators of this subpackage use."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lake_ingest.session import shared_dir

# Words and the white space between them, as regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

FRUGAL = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder on the storage that all executors share."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


@contextmanager
def frugal(spark: SparkSession):
    """Actions within leave no shuffle files behind, and hand small batches to Python."""
    before = {name: spark.conf.get(name) for name in FRUGAL}
    try:
        for name, value in FRUGAL.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def saved(rows: DataFrame, name: str) -> DataFrame:
    """The rows written once to shared storage and read back: a lost executor loses none of them."""
    path = scratch_path(rows.sparkSession, name)
    with frugal(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def words(text: str | Column) -> Column:
    """Array of the words of a text; empty for a null text."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def sampled(rows: DataFrame, keys: list[str], total: int, size: int) -> DataFrame:
    """About ``size`` of ``total`` rows, always the same ones: those with the least hashes.

    Where so many rows are equal that they come together, any twice ``size`` of them are taken.
    """
    if total <= size:
        return rows
    least = -(1 << 63) + int((1 << 64) * (size / total))
    return rows.where(F.xxhash64(*keys) <= F.lit(least)).limit(2 * size)
