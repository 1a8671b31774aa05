"""The life of one source: discovered, saved, skipped, changed, discovered again, executed."""

import json
from datetime import datetime, timezone

import pytest

from lake_ingest import schemas
from lake_ingest.operators.artifacts import file_parts
from lake_ingest.operators.discovery import discover
from lake_ingest.operators.listing import fingerprint, list_objects
from lake_ingest.operators.state import load_state
from lake_ingest.operators.tables import read_table
from lake_ingest.plans.lake import Lake
from lake_ingest.plans.run_ingestion import run_ingestion
from lake_ingest.plans.save_batch import PROPOSAL_COLUMNS, orphaned_artifacts, save_batch
from tests.conftest import rows

SOURCE = json.dumps({"source_id": 123, "ra": 187.5, "decl": -2.3, "test_run": "r"}, indent=2)
LOADER = "def load_data(spark, source_path):\n    return spark.read.json(source_path, multiLine=True)\n"


def _proposal(key, profile=None, prompt="Inspect ü"):
    profile = profile or json.dumps({"source_key": key, "b": 1.5, "a": "ü"})
    return (key, prompt, LOADER, profile, "# Columns", "# Plan", "astronomy.test.sample")


def _proposals(spark, *proposals):
    return spark.createDataFrame(list(proposals), ", ".join(f"{c} string" for c in PROPOSAL_COLUMNS))


def _at(day):
    return datetime(2024, 1, day, tzinfo=timezone.utc)


def test_lifecycle(spark, put, tmp_path, table_name):
    root = put("in/sample.json", SOURCE)
    lake = Lake(str(tmp_path / "lake"))
    listed = lambda: fingerprint(list_objects(spark, root), root)
    pending = lambda: discover(listed(), load_state(spark, lake.state))

    assert rows(pending(), "key", "previously_seen", "previous_status") == [("in/sample.json", False, None)]

    saved = save_batch(
        spark, lake, _proposals(spark, _proposal("in/sample.json")), listed(), file_parts(root, 16), "r1", _at(1)
    )
    (record,) = saved.accepted.collect()
    assert saved.rejected.count() == 0
    assert record.status == "artifacts_saved" and record.execution_performed is False
    assert record.raw_location == f"raw/{record.proposal_id}-sample.json/sample.json"
    assert record.dependencies == [] and record.target_table == "astronomy.test.sample"

    raw = read_table(spark, lake.raw, schemas.RAW_PARTS).orderBy("part").collect()
    assert b"".join(bytes(r.content) for r in raw).decode() == SOURCE and len(raw) > 1
    bodies = {r.kind: (r.key, r.content_type, r.body) for r in read_table(spark, lake.artifacts, schemas.ARTIFACTS).collect()}
    assert {k: v[0] for k, v in bodies.items()} == record.artifacts
    assert bodies["prompt"][1:] == ("text/markdown", "Inspect ü")
    assert bodies["source_loader"][1:] == ("text/x-python", LOADER)
    profile = {"source_key": "in/sample.json", "b": 1.5, "a": "ü", "dependencies": []}
    assert bodies["profile"][1:] == ("application/json", json.dumps(profile, indent=2, ensure_ascii=False))
    assert bodies["execution_log"][2].startswith("Status: NOT EXECUTED\n")
    assert orphaned_artifacts(
        read_table(spark, lake.artifacts, schemas.ARTIFACTS), read_table(spark, lake.state, schemas.STATE)
    ).count() == 0

    # The content hash covers the whole file here, the stored one its parts: compare like with like.
    whole = save_batch(
        spark, lake, _proposals(spark, _proposal("in/sample.json")), listed(), file_parts(root), "r2", _at(2)
    )
    assert whole.accepted.count() == 1 and pending().count() == 0

    put("in/sample.json", SOURCE + "\n")
    assert rows(pending(), "key", "previously_seen", "previous_status") == [
        ("in/sample.json", True, "artifacts_saved")
    ]

    save_batch(
        spark, lake, _proposals(spark, _proposal("in/sample.json")), listed(), file_parts(root), "r3", _at(3)
    )
    log = run_ingestion(
        spark, lake, f"{root}/in/sample.json", table_name, "r4", source_key="in/sample.json"
    )
    assert rows(log, "status", "rows_in", "rows_written", "rows_rejected") == [("SUCCESS", 1, 1, 0)]
    assert rows(spark.table(table_name), "source_id", "ra", "decl", "test_run") == [(123, 187.5, -2.3, "r")]
    (state,) = load_state(spark, lake.state).collect()
    assert state.status == "success" and state.execution_performed is True
    assert pending().count() == 0


def test_rejects_name_the_first_failing_check(spark, put, tmp_path):
    for key in ("a.json", "b.json", "c.json"):
        root = put(key, "{}")
    lake = Lake(str(tmp_path / "lake"))
    listing = fingerprint(list_objects(spark, root), root)
    result = save_batch(
        spark,
        lake,
        _proposals(
            spark,
            _proposal("a.json"),
            _proposal("a.json"),
            _proposal("b.json", prompt="  \n"),
            _proposal("c.json", profile="[1]", prompt=""),
            _proposal("gone.json"),
            ("d.json", "p", "def load(): pass", json.dumps({"source_key": "d.json"}), "m", " ", "t"),
        ),
        listing,
        file_parts(root),
        "r1",
        _at(1),
    )
    assert rows(result.accepted, "source_key") == [("a.json",)]
    assert rows(result.rejected) == [
        ("b.json", "MISSING_TEXT"), ("c.json", "NOT_OBJECT"), ("d.json", "INVALID_LOADER"),
        ("gone.json", "SOURCE_MISSING"),
    ]
    assert rows(read_table(spark, lake.runs, schemas.RUN_LOG), "source_key", "status") == [
        ("a.json", "NOT EXECUTED")
    ]


def test_two_proposals_for_one_source_are_two_saves(spark, put, tmp_path):
    root = put("profile.json", "{}")
    lake = Lake(str(tmp_path / "lake"))
    listing = fingerprint(list_objects(spark, root), root)
    both = _proposals(spark, _proposal("profile.json"), _proposal("profile.json", prompt="other"))
    for _ in range(2):
        result = save_batch(spark, lake, both, listing, file_parts(root), "r1", _at(1))
    assert result.accepted.select("proposal_id").distinct().count() == 2
    assert read_table(spark, lake.artifacts, schemas.ARTIFACTS).count() == 12
    assert read_table(spark, lake.raw, schemas.RAW_PARTS).count() == 2
    assert load_state(spark, lake.state).count() == 1


def test_empty_source_and_empty_batch(spark, put, tmp_path):
    root = put("empty.json", "")
    lake = Lake(str(tmp_path / "lake"))
    listing = fingerprint(list_objects(spark, root), root)
    result = save_batch(
        spark, lake, _proposals(spark, _proposal("empty.json")), listing, file_parts(root), "r1", _at(1)
    )
    assert result.accepted.count() == 1
    none = _proposals(spark, _proposal("x")).limit(0)
    result = save_batch(spark, lake, none, listing, file_parts(root), "r2", _at(2))
    assert result.accepted.count() == 0 and result.rejected.count() == 0


def test_lost_bytes_are_not_committed(spark, put, tmp_path):
    for key in ("a", "b"):
        root = put(key, key)
    lake = Lake(str(tmp_path / "lake"))
    listing = fingerprint(list_objects(spark, root), root)
    reader = file_parts(root)
    result = save_batch(
        spark,
        lake,
        _proposals(spark, _proposal("a"), _proposal("b")),
        listing,
        lambda saves: reader(saves).where("source_key <> 'b'"),
        "r1",
        _at(1),
    )
    assert rows(result.accepted, "source_key") == [("a",)]
    assert rows(result.rejected) == [("b", "NOT_VERIFIED")]


def test_a_lost_part_is_not_committed(spark, put, tmp_path):
    for key in ("a", "b"):
        root = put(key, key * 40)
    lake = Lake(str(tmp_path / "lake"))
    listing = fingerprint(list_objects(spark, root), root, smallest=16)
    reader = file_parts(root, 16)
    result = save_batch(
        spark,
        lake,
        _proposals(spark, _proposal("a"), _proposal("b")),
        listing,
        lambda saves: reader(saves).where("source_key <> 'b' OR part <> 1"),
        "r1",
        _at(1),
    )
    assert rows(result.accepted, "source_key", "etag") == rows(listing.where("key = 'a'"), "key", "etag")
    assert rows(result.rejected) == [("b", "NOT_VERIFIED")]


def test_failed_run_is_logged_and_raised(spark, put, tmp_path, table_name):
    root = put("bad.json", '{"a": 1}')
    lake = Lake(str(tmp_path / "lake"))
    with pytest.raises(Exception):
        run_ingestion(spark, lake, f"{root}/none.json", table_name, "r1")
    assert rows(read_table(spark, lake.runs, schemas.RUN_LOG), "run_id", "status") == [("r1", "FAILED")]


def test_repeating_a_run_appends_unless_told_not_to(spark, put, tmp_path, table_name):
    root = put("a.json", '{"a": 1}')
    lake = Lake(str(tmp_path / "lake"))
    for skip in (False, False, True):
        run_ingestion(spark, lake, f"{root}/a.json", table_name, "r1", skip_if_done=skip)
    assert spark.table(table_name).count() == 2
