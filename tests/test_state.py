from datetime import datetime

import pytest

from lake_ingest import schemas
from lake_ingest.operators import state
from lake_ingest.operators.discovery import discover, discovery_summary, pick_pending
from lake_ingest.operators.tables import read_batch, read_table, write_batch
from tests.conftest import rows


def _records(spark, *records):
    """Records given as (source_key, status, etag, processed_at second)."""
    df = spark.createDataFrame(
        [(k, s, e, datetime(2024, 1, 1, 0, 0, t), f"id{t}") for k, s, e, t in records],
        "source_key string, status string, etag string, processed_at timestamp, proposal_id string",
    )
    missing = [
        f"CAST(NULL AS {kind}) AS {name}"
        for name, kind in (f.strip().split(" ", 1) for f in schemas.STATE.replace("map<string,string>", "map<string;string>").split(","))
        for kind in [kind.replace(";", ",")]
        if name not in df.columns
    ]
    return df.selectExpr("*", *missing)


def test_missing_state_is_empty(spark, tmp_path):
    found = state.load_state(spark, str(tmp_path / "none"))
    assert found.count() == 0 and found.columns[0] == "source_key"


def test_latest_record_wins_across_batches(spark, tmp_path):
    table = str(tmp_path / "state")
    write_batch(_records(spark, ("a", "artifacts_saved", "1", 1), ("b", "failed", "1", 1)), table, "one")
    write_batch(_records(spark, ("a", "success", "2", 2)), table, "two")
    assert rows(state.load_state(spark, table), "source_key", "status") == [("a", "success"), ("b", "failed")]
    assert rows(state.load_state(spark, table, "two"), "source_key", "status") == [
        ("a", "artifacts_saved"), ("b", "failed"),
    ]


def test_record_lines(spark):
    (line,) = state.record_lines(_records(spark, ("a", "success", "1", 1))).collect()
    assert '"source_key":"a"' in line.value and '"status":"success"' in line.value


def test_compacted_log_says_the_same(spark, tmp_path):
    table = str(tmp_path / "state")
    write_batch(_records(spark, ("a", "failed", "1", 1), ("b", "failed", "1", 1)), table, "one")
    write_batch(_records(spark, ("a", "success", "2", 2)), table, "two")
    before = rows(state.load_state(spark, table), "source_key", "status", "etag")
    state.compact_state(spark, table, "compact")
    assert rows(state.load_state(spark, table), "source_key", "status", "etag") == before
    assert [p.name for p in (tmp_path / "state").iterdir()] == ["batch_id=compact"]
    with pytest.raises(ValueError):
        state.compact_state(spark, table, "compact")
    write_batch(_records(spark, ("b", "success", "2", 3)), table, "three")
    assert rows(state.load_state(spark, table), "source_key", "status") == [("a", "success"), ("b", "success")]


def test_repeated_batch_replaces_itself_only(spark, tmp_path):
    table = str(tmp_path / "state")
    for _ in range(2):
        write_batch(_records(spark, ("a", "success", "1", 1)), table, "one")
        write_batch(_records(spark, ("b", "success", "1", 1)), table, "two")
    assert read_table(spark, table, schemas.STATE).count() == 2
    assert rows(read_batch(spark, table, "one", schemas.STATE), "source_key") == [("a",)]
    with pytest.raises(ValueError):
        write_batch(_records(spark), table, "../x")


DOCUMENTS = [
    ("{}", None, 1),
    ('{"version": 3, "processed": {}}', None, 3),
    ("[]", "Ingestion state must be a JSON object", None),
    ('{"processed": []}', "Ingestion state 'processed' must be a JSON object", None),
    ('{"processed": null}', "Ingestion state 'processed' must be a JSON object", None),
    ("{", "Ingestion state is not valid JSON", None),
]


def test_state_documents(spark):
    df = spark.createDataFrame([(d,) for d, _, _ in DOCUMENTS], "body string").coalesce(1)
    found = state.check_documents(df, "body").collect()
    assert [(r.body, r.error, r.version) for r in found] == DOCUMENTS
    good = df.where("body LIKE '{%}' AND body NOT LIKE '%[]%' AND body NOT LIKE '%null%'")
    assert state.import_documents(good, "body").count() == 0
    with pytest.raises(Exception, match="must be a JSON object"):
        state.import_documents(df.where("body = '[]'"), "body").collect()


def test_imported_records_and_discovery(spark, tmp_path):
    path = tmp_path / "state.json"
    path.write_text(
        """{
  "version": 1,
  "processed": {
    "saved": {"status": "artifacts_saved", "etag": "1", "processed_at": "2024-05-01T10:00:00.5+00:00",
              "artifacts": {"prompt": "raw/x/prompt.md"}, "dependencies": ["numpy"], "execution_performed": false},
    "done": {"status": "success", "etag": "1"},
    "changed": {"status": "success", "etag": "0"},
    "failed": {"status": "failed", "etag": "1"},
    "empty": {},
    "none": null,
    "no etag": {"status": "success"},
    "not listed": {"status": "success", "etag": "1"}
  }
}"""
    )
    imported = state.import_state_file(spark, str(path))
    saved = imported.where("source_key = 'saved'").first()
    assert saved.artifacts == {"prompt": "raw/x/prompt.md"} and saved.dependencies == ["numpy"]
    assert saved.execution_performed is False and saved.processed_at == datetime(2024, 5, 1, 10, 0, 0, 500000)
    keys = ["saved", "done", "changed", "failed", "empty", "none", "no etag", "new"]
    listing = spark.createDataFrame(
        [(k, "in", 10, '"1"', datetime(2024, 1, 1, 0, 0, i)) for i, k in enumerate(keys)],
        "key string, bucket string, size bigint, etag string, last_modified timestamp",
    )
    found = discover(listing, imported)
    assert rows(found, "key", "etag", "previously_seen", "previous_status") == [
        ("changed", "1", True, "success"),
        ("empty", "1", True, None),
        ("failed", "1", True, "failed"),
        ("new", "1", False, None),
        ("no etag", "1", True, "success"),
        ("none", "1", False, None),
    ]
    assert [r.key for r in pick_pending(found, 2).collect()] == ["changed", "failed"]
    assert pick_pending(found).count() == 6
    assert rows(discovery_summary(found), "previously_seen", "previous_status", "count", "bytes") == [
        (False, None, 2, 20), (True, "failed", 1, 10), (True, "success", 2, 20), (True, None, 1, 10),
    ]
