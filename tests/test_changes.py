import pytest

from lake_ingest.operators.listing import fingerprint, list_objects
from lake_ingest.streaming.changes import ObjectChangesReader, stream_changes
from tests.conftest import rows


def test_added_edited_and_removed_objects(spark, put, tmp_path):
    root, seen = put("a/1.txt", "one"), []
    put("2.txt", "")

    def run():
        stream = stream_changes(
            spark, root, str(tmp_path / "progress"), lambda df, i: seen.append((i, sorted(map(tuple, df.select("key", "change", "etag").collect()))))
        )
        stream.awaitTermination()
        return seen.pop()[1] if seen else []

    etags = dict(rows(fingerprint(list_objects(spark, root), root), "key", "etag"))
    assert run() == [("2.txt", "added", etags["2.txt"]), ("a/1.txt", "added", etags["a/1.txt"])]
    assert run() == []
    put("a/1.txt", "another")
    put("3.txt", "x")
    (tmp_path / "incoming" / "2.txt").unlink()
    etags = dict(rows(fingerprint(list_objects(spark, root), root), "key", "etag"))
    assert run() == [("2.txt", "removed", None), ("3.txt", "added", etags["3.txt"]), ("a/1.txt", "changed", etags["a/1.txt"])]
    assert run() == []


def test_a_failed_batch_is_seen_again(spark, put, tmp_path):
    root, seen = put("1.txt", "one"), []

    def fail(changes, batch_id):
        raise RuntimeError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        stream_changes(spark, root, str(tmp_path / "progress"), fail).awaitTermination()
    put("2.txt", "two")
    keep = lambda df, i: seen.append((i, rows(df, "key", "change")))
    for _ in range(2):
        stream_changes(spark, root, str(tmp_path / "progress"), keep).awaitTermination()
    assert [r for _, found in seen for r in found] == [("1.txt", "added"), ("2.txt", "added")]


def test_a_snapshot_is_taken_once(put, tmp_path):
    reader = ObjectChangesReader({"path": put("k", "x"), "snapshots": str(tmp_path / "s"), "tasks": "3"})
    assert reader.initialOffset() == {"snapshot": 0}
    assert reader.latestOffset() == reader.latestOffset() == {"snapshot": 1}
    put("l", "y")
    assert reader.latestOffset() == {"snapshot": 2}
    (part,) = reader.partitions({"snapshot": 1}, {"snapshot": 2})
    assert [r[:2] for r in part.rows] == [("l", "added")]
    assert len(reader.partitions({"snapshot": 0}, {"snapshot": 2})) == 2
    reader.commit({"snapshot": 2})
    assert [f.name for f in (tmp_path / "s").iterdir()] == ["2.parquet"]
