"""Latest records per key as a base and deltas.

The base is a table bucketed and sorted by key, with one record a key. Changes are small batches beside it. A
reader takes the latest record of each key from the deltas, and from the base the records of the other keys:
only the deltas are shuffled, into the base's buckets. When the deltas pass a share of the base they are
folded into a new one; the old base stays until the next fold, for readers that began with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.operators.state import latest
from lake_ingest.operators.tables import (
    BATCH,
    batch_folders,
    drop_batch,
    read_table,
    write_batch,
)

# Deltas of more than this share of the base are folded.
FOLD_SHARE = 0.1


class KeyedLog:
    """Records of ``schema`` by ``key``, the newest by ``order`` in force.

    ``table`` names the bases in the session's catalog, ``root`` is the folder of the deltas and of the bases'
    files. Writers are not to fold at the same time.
    """

    def __init__(
        self, spark: SparkSession, table: str, root: str, schema: str, key: str, order: Sequence[str], buckets: int | None = None
    ):
        self.spark, self.table, self.root, self.schema = spark, table, root.rstrip("/"), schema
        self.key, self.order = key, list(order)
        # Fewer buckets than shuffle partitions would have Spark shuffle the base after all.
        self.buckets = max(buckets or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def _generation(self) -> int:
        """Number of the base in force, 0 without one: the highest whose commit is noted."""
        marks = (f.rsplit("=", 1)[-1] for f in batch_folders(self.spark, f"{self.root}/bases"))
        return max((int(m) for m in marks), default=0)

    def _base(self, generation: int) -> DataFrame:
        if generation == 0:
            return self.spark.createDataFrame([], T.StructType.fromDDL(self.schema))
        return self.spark.table(f"{self.table}_{generation}")

    def _deltas(self, generation: int) -> str:
        return f"{self.root}/deltas-{generation}"

    def append(self, rows: DataFrame, batch_id: str) -> None:
        """Write one batch of records, in place of what the same batch wrote since the last fold."""
        write_batch(rows, self._deltas(self._generation()), batch_id)

    def read(self) -> DataFrame:
        """The record in force of each key."""
        generation = self._generation()
        changes = read_table(self.spark, self._deltas(generation), self.schema).drop(BATCH)
        newest = latest(changes, self.key, *self.order)
        base = self._base(generation)
        if generation == 0:
            return newest
        # A change may be older than the base's record, so both are compared where both are there.
        ours, theirs = ([F.col(f"{side}.{c}") for c in self.order] for side in ("b", "d"))
        keeps = F.struct(*ours) >= F.struct(*theirs)
        joined = base.alias("b").join(newest.alias("d"), F.col(f"b.{self.key}") == F.col(f"d.{self.key}"), "full_outer")
        old = F.col(f"d.{self.key}").isNull() | (F.col(f"b.{self.key}").isNotNull() & keeps)
        return joined.select(*(F.when(old, F.col(f"b.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in base.columns))

    def wants_fold(self, share: float = FOLD_SHARE) -> bool:
        generation = self._generation()
        changes = read_table(self.spark, self._deltas(generation), self.schema).count()
        return changes > share * (self._base(generation).count() if generation else 0)

    def fold(self) -> None:
        """Make a new base of the records in force. It counts once its commit is noted, after all is written."""
        generation = self._generation() + 1
        name = f"{self.table}_{generation}"
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        writer = self.read().write.bucketBy(self.buckets, self.key).sortBy(self.key).mode("overwrite")
        writer.option("path", f"{self.root}/base-{generation}").saveAsTable(name)
        mark = self.spark.createDataFrame([(generation,)], "generation int")
        write_batch(mark, f"{self.root}/bases", str(generation))
        if generation > 2:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}_{generation - 2}")
            drop_batch(self.spark, f"{self.root}/bases", str(generation - 2))
