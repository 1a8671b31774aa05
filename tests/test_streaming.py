import json
from pathlib import Path

from lake_ingest.operators.artifacts import file_parts
from lake_ingest.operators.listing import fingerprint, list_objects
from lake_ingest.operators.state import load_state
from lake_ingest.plans.lake import Lake
from lake_ingest.streaming.incremental import ingest_new_files, save_new_proposals
from tests.conftest import rows


def _ingest(spark, root, tmp_path):
    ingest_new_files(
        spark, root, "json", "a int", str(tmp_path / "target"), str(tmp_path / "progress")
    ).awaitTermination()
    return rows(spark.read.parquet(str(tmp_path / "target")), "a")


def test_new_files_once_and_changed_files_not(spark, put, tmp_path):
    root = put("1.json", '{"a": 1}')
    assert _ingest(spark, root, tmp_path) == [(1,)]
    put("1.json", '{"a": 9}')
    assert _ingest(spark, root, tmp_path) == [(1,)]
    put("2.json", '{"a": 2}')
    assert _ingest(spark, root, tmp_path) == [(1,), (2,)]


def test_repeated_batch_leaves_its_rows_once(spark, put, tmp_path):
    root = put("1.json", '{"a": 1}')
    put("2.json", '{"a": 2}')
    first = _ingest(spark, root, tmp_path)
    # As after a driver lost between the write and the commit: the batch is run again.
    for commit in Path(tmp_path / "progress" / "commits").glob("*0*"):
        commit.unlink()
    assert _ingest(spark, root, tmp_path) == first == [(1,), (2,)]


def test_proposals_are_saved_as_they_arrive(spark, put, tmp_path):
    root = put("a.json", "{}")
    put("b.json", "{}")
    lake, inbox = Lake(str(tmp_path / "lake")), tmp_path / "inbox"
    inbox.mkdir()
    for key in ("a.json", "b.json"):
        profile = json.dumps({"source_key": key})
        texts = dict.fromkeys(("prompt", "source_loader", "semantic_metadata", "proposal", "target_table"), "x")
        texts["source_loader"] = "def load_data(spark, source_path): pass"
        (inbox / f"{key}l").write_text(json.dumps({"source_key": key, "profile": profile, **texts}))
        save_new_proposals(
            spark,
            lake,
            str(inbox),
            lambda: fingerprint(list_objects(spark, root), root),
            file_parts(root),
            str(tmp_path / "progress"),
        ).awaitTermination()
    assert rows(load_state(spark, lake.state), "source_key", "status") == [
        ("a.json", "artifacts_saved"), ("b.json", "artifacts_saved"),
    ]
