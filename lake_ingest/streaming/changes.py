"""A stream of what changes among the objects below a root: added, edited and removed ones.

Spark's file source knows a file by its path and passes over one that was edited. Here an offset is the number
of a snapshot, the keys, sizes and times of all objects at one moment, kept as a file beside the checkpoint; a
batch is the difference of two snapshots. A restarted stream goes on from the snapshot that its checkpoint
names, and a snapshot that no batch was made of yet is found again, not taken twice. The tasks read what
was added or edited and tell its fingerprint, the one that the state records hold, so that an object that was
only touched can be told from an edited one.

The listing and the snapshots are the driver's, one entry an object. Where they grow too large for it, batch
runs over ``operators.listing.list_objects`` do the same in tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming.query import StreamingQuery

from lake_ingest.constants import PART_BYTES
from lake_ingest.sources.restored import Fingerprint
from lake_ingest.sources.store import StoreOptions, join, open_store, store_options, walk

ADDED, CHANGED, REMOVED = "added", "changed", "removed"
CHANGES = "key string, change string, size bigint, last_modified timestamp, etag string"
_SNAPSHOT = pa.schema([("key", pa.string()), ("size", pa.int64()), ("modified", pa.int64())])


class ChangedObjects(InputPartition):
    def __init__(self, number: int, rows: list[tuple[str, str, int, int]]):
        super().__init__(number)
        self.rows = rows


class ObjectChanges(DataSource):
    """``spark.readStream.format("object_changes").options(path=root, snapshots=folder).load()``

    Options: ``snapshots``, a folder of the stream's own; ``tasks``, among how many tasks a batch is dealt.
    """

    @classmethod
    def name(cls):
        return "object_changes"

    def schema(self):
        return CHANGES

    def streamReader(self, schema):
        return ObjectChangesReader(self.options)


class ObjectChangesReader(DataSourceStreamReader):
    def __init__(self, options):
        self.root, self.snapshots = options["path"], options["snapshots"]
        self.tasks = int(options.get("tasks", "32"))
        self.store = StoreOptions.of_option(options)

    def initialOffset(self) -> dict:
        return {"snapshot": 0}

    def latestOffset(self) -> dict:
        """The last snapshot, a new one if anything differs from it."""
        store, folder = open_store(self.snapshots, self.store)
        last = max(self._numbers(store, folder), default=0)
        now = self._list()
        if not self._read(last).equals(now):
            last += 1
            store.create_dir(folder, recursive=True)
            draft = f"{folder}/_draft-{last}"
            with store.open_output_stream(draft) as file:
                pq.write_table(now, file)
            store.move(draft, f"{folder}/{last}.parquet")
        return {"snapshot": last}

    def partitions(self, start: dict, end: dict) -> list[ChangedObjects]:
        before, after = self._read(start["snapshot"]), self._read(end["snapshot"])
        changes = sorted(difference(before, after))
        tasks = max(1, min(self.tasks, len(changes)))
        return [ChangedObjects(i, changes[i::tasks]) for i in range(tasks)]

    def read(self, partition: ChangedObjects) -> Iterator[pa.RecordBatch]:
        store, base = open_store(self.root, self.store)
        etags = [None if change == REMOVED else _etag(store, join(base, key)) for key, change, _, _ in partition.rows]
        keys, changes, sizes, modified = zip(*partition.rows) if partition.rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.string()),
                pa.array(changes, pa.string()),
                pa.array(sizes, pa.int64()),
                pa.array([m // 1000 for m in modified], pa.timestamp("us", tz="UTC")),
                pa.array(etags, pa.string()),
            ],
            names=["key", "change", "size", "last_modified", "etag"],
        )

    def commit(self, end: dict) -> None:
        """Batches up to this snapshot are done: the ones before it are needed no more."""
        store, folder = open_store(self.snapshots, self.store)
        for number in self._numbers(store, folder):
            if number < end["snapshot"]:
                store.delete_file(f"{folder}/{number}.parquet")

    @staticmethod
    def _numbers(store: fs.FileSystem, folder: str) -> list[int]:
        names = (i.base_name for i in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)))
        return [int(n.removesuffix(".parquet")) for n in names if n.endswith(".parquet") and not n.startswith("_")]

    def _read(self, number: int) -> pa.Table:
        if number == 0:
            return _SNAPSHOT.empty_table()
        store, folder = open_store(self.snapshots, self.store)
        with store.open_input_file(f"{folder}/{number}.parquet") as file:
            return pq.read_table(file, schema=_SNAPSHOT)

    def _list(self) -> pa.Table:
        store, base = open_store(self.root, self.store)
        strip = len(base.rstrip("/")) + 1
        rows = [(i.path[strip:], i.size, i.mtime_ns) for i in walk(store, base)]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _SNAPSHOT)], schema=_SNAPSHOT).sort_by("key")


def difference(before: pa.Table, after: pa.Table) -> Iterator[tuple[str, str, int, int]]:
    """``(key, change, size, modified)`` of the objects that two snapshots tell differently."""
    both = before.rename_columns(["key", "old_size", "old_modified"]).join(after, "key", join_type="full outer")
    same = pc.and_(pc.equal(both["size"], both["old_size"]), pc.equal(both["modified"], both["old_modified"]))
    for row in both.filter(pc.invert(pc.fill_null(same, False))).to_pylist():
        if row["size"] is None:
            yield row["key"], REMOVED, row["old_size"], row["old_modified"]
        else:
            yield row["key"], ADDED if row["old_size"] is None else CHANGED, row["size"], row["modified"]


def _etag(store: fs.FileSystem, path: str) -> str | None:
    """Fingerprint of an object's content, none if it is gone since the listing."""
    found = Fingerprint()
    try:
        with store.open_input_stream(path) as file:
            while (part := file.read(PART_BYTES)) or not found.parts:
                found.add(part)
    except OSError:
        return None
    return found.etag()


def stream_changes(
    spark: SparkSession, root: str, checkpoint: str, sink: Callable[[DataFrame, int], None], tasks: int | None = None
) -> StreamingQuery:
    """Hand what changed since the last run to ``sink(changes, batch_id)`` in one batch, then stop.

    A run after one that failed repeats that one's batch, and what changed since is for the next run.
    """
    spark.dataSource.register(ObjectChanges)
    options = {"path": root, "snapshots": f"{checkpoint.rstrip('/')}-snapshots"} | store_options(spark).as_option()
    return (
        spark.readStream.format("object_changes")
        .options(**options, tasks=str(tasks or spark.sparkContext.defaultParallelism))
        .load()
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
