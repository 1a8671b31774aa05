"""Objects of every kind, stops between the writes of a run, and what earlier records keep."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lake_ingest import schemas
from lake_ingest.operators.artifacts import file_parts
from lake_ingest.operators.discovery import discover
from lake_ingest.operators.listing import fingerprint, list_objects
from lake_ingest.operators.state import load_state
from lake_ingest.operators.tables import read_table, write_batch
from lake_ingest.plans import run_ingestion as plan
from lake_ingest.plans.lake import Lake
from lake_ingest.plans.save_batch import PROPOSAL_COLUMNS, save_batch
from lake_ingest.sources.contents import file_contents
from tests.conftest import rows

KINDS = {
    "one.json": '{"a": 1, "b": "x"}',
    "array.json": '[{"a": 2}, {"a": 3, "b": "1.50"}]',
    "empty-array.json": " [] ",
    "two.json": '{"a": 1}\n{"a": 2}',
    "garbage.json": '{"a": 3} garbage',
    "text.json": "no document",
    "number.json": "7",
    "string.json": '"{1}"',
    "mixed.json": '[{"a": 4}, 5]',
    "nothing.json": "",
    "unfit.json": '{"a": "many"}',
}
DONE = {"one.json", "array.json", "empty-array.json", "unfit.json"}
SCHEMA = "a int, b string"


def _root(put):
    for key, content in KINDS.items():
        root = put(key, content)
    return root


def _ingest(spark, lake, root, table, run="r1", **options):
    listing = fingerprint(list_objects(spark, root), root)
    return plan.ingest_objects(
        spark, lake, listing, file_contents(root), table, run, SCHEMA, path=f"{lake.root}/{table}", **options
    )


def test_every_kind_has_its_outcome(spark, put, tmp_path, table_name):
    root, lake = _root(put), Lake(str(tmp_path / "lake"))
    log = _ingest(spark, lake, root, table_name).first()
    assert (log.rows_in, log.rows_written, log.rows_rejected) == (11, 3, 8)
    assert rows(spark.table(table_name), "a", "b") == [(1, "x"), (2, None), (3, "1.50")]
    state = dict(rows(load_state(spark, lake.state), "source_key", "status"))
    assert state == {key: "success" if key in DONE else "failed" for key in KINDS}
    pending = discover(fingerprint(list_objects(spark, root), root), load_state(spark, lake.state))
    assert {r.key for r in pending.collect()} == set(KINDS) - DONE
    rejects = read_table(spark, lake.rejects, plan.REJECTS)
    assert {r.source_key for r in rejects.collect()} == set(KINDS) - DONE | {"unfit.json"}


def test_objects_that_cannot_be_read_are_offered_again(spark, put, tmp_path, table_name):
    root, lake = _root(put), Lake(str(tmp_path / "lake"))
    listing = fingerprint(list_objects(spark, root), root)
    listed = spark.createDataFrame(listing.collect(), listing.schema)
    (tmp_path / "incoming" / "one.json").unlink()
    plan.ingest_objects(
        spark, lake, listed, file_contents(root), table_name, "r1", SCHEMA, path=f"{lake.root}/t"
    )
    state = dict(rows(load_state(spark, lake.state), "source_key", "status"))
    assert state["one.json"] == "failed" and state["array.json"] == "success"
    put("one.json", KINDS["one.json"])
    _ingest(spark, lake, root, table_name, "r2")
    assert dict(rows(load_state(spark, lake.state), "source_key", "status"))["one.json"] == "success"
    assert spark.table(table_name).count() == 3


@pytest.mark.parametrize("skip", [False, True])
@pytest.mark.parametrize("stop", ["discovered", "staged", "target", "rejects", "state", "log"])
def test_a_stopped_run_is_finished_by_repeating_it(spark, put, tmp_path, table_name, monkeypatch, stop, skip):
    root, lake = _root(put), Lake(str(tmp_path / "lake"))
    tables = {"discovered": lake.discovered, "staged": lake.staged, "rejects": lake.rejects, "state": lake.state}

    class Stopped(BaseException):
        pass

    def write(rows_, table, batch):
        if stop == "log" and table == lake.runs:
            raise Stopped
        write_batch(rows_, table, batch)
        if tables.get(stop) == table:
            raise Stopped

    def replace(df, table, load, **options):
        original(df, table, load, **options)
        if stop == "target":
            raise Stopped

    original = plan.replace_load
    with monkeypatch.context() as patched:
        patched.setattr(plan, "write_batch", write)
        patched.setattr(plan, "replace_load", replace)
        with pytest.raises(Stopped):
            _ingest(spark, lake, root, table_name)
    log = _ingest(spark, lake, root, table_name, skip_if_done=skip).first()
    assert (log.status, log.rows_written) == ("SUCCESS", 3)
    assert rows(spark.table(table_name), "a") == [(1,), (2,), (3,)]
    assert read_table(spark, lake.state, schemas.STATE).count() == len(KINDS)
    assert read_table(spark, lake.rejects, plan.REJECTS).count() == 8
    if skip:
        _ingest(spark, lake, root, table_name, skip_if_done=True)
        assert spark.table(table_name).count() == 3


def test_a_failing_run_is_logged(spark, put, tmp_path, table_name):
    root, lake = _root(put), Lake(str(tmp_path / "lake"))
    with pytest.raises(Exception):
        plan.ingest_objects(
            spark, lake, fingerprint(list_objects(spark, root), root), lambda found: 1 / 0, table_name, "r", SCHEMA
        )
    assert rows(read_table(spark, lake.runs, schemas.RUN_LOG), "status") == [("FAILED",)]


def test_fields_of_an_earlier_save_are_kept(spark, put, tmp_path, table_name):
    root, lake = _root(put), Lake(str(tmp_path / "lake"))
    listing = fingerprint(list_objects(spark, root), root)
    saved = listing.where("key IN ('one.json', 'array.json')").select(
        F.col("key").alias("source_key"),
        F.lit("retry").alias("status"),
        F.when(F.col("key") == "one.json", F.col("etag")).otherwise("old").alias("etag"),
        F.lit(datetime(2024, 1, 1, tzinfo=timezone.utc)).alias("processed_at"),
        F.lit("raw/x").alias("raw_location"),
        F.array(F.lit("numpy")).alias("dependencies"),
    )
    empty = spark.createDataFrame([], schemas.STATE)
    write_batch(empty.unionByName(saved, allowMissingColumns=True), lake.state, "earlier")
    _ingest(spark, lake, root, table_name)
    state = {r.source_key: r for r in load_state(spark, lake.state).collect()}
    assert (state["one.json"].raw_location, state["one.json"].dependencies) == ("raw/x", ["numpy"])
    assert state["array.json"].raw_location is None and state["array.json"].status == "success"


def test_two_tables_of_one_run(spark, put, tmp_path, table_name):
    lake = Lake(str(tmp_path / "lake"))
    root = put("a.json", '{"a": 1}')
    for run, table in (("t4", f"{table_name}_a"), ("t4", f"{table_name}_b"), ("t4", f"{table_name}_a")):
        plan.run_ingestion(spark, lake, f"{root}/a.json", table, run, skip_if_done=True)
    assert read_table(spark, lake.runs, schemas.RUN_LOG).count() == 2
    assert spark.table(f"{table_name}_a").count() == spark.table(f"{table_name}_b").count() == 1


def test_repaired_source_leaves_no_old_rejects(spark, put, tmp_path, table_name):
    lake = Lake(str(tmp_path / "lake"))
    for content in ('{"a": "x"}', '{"a": 1}'):
        root = put("a.json", content)
        plan.run_ingestion(spark, lake, f"{root}/a.json", table_name, "r", schema="a int")
    assert read_table(spark, lake.rejects, plan.REJECTS).count() == 0


def test_contents_of_a_small_share_are_not_shuffled(spark, put, tmp_path):
    root = _root(put)
    found = spark.createDataFrame([(k, 10) for k in KINDS], "key string, size bigint").where("key = 'one.json'")
    text = file_contents(root)(found)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in text and "content" not in text.split("Exchange", 1)[1]


def _save(spark, lake, put, bodies, table_name, part=16):
    for key, body in bodies.items():
        root = put(key, body)
    listing = fingerprint(list_objects(spark, root), root, smallest=part)
    proposals = [
        (k, "p", "def load_data(spark, source_path): pass", json.dumps({"source_key": k}), "m", "q", table_name)
        for k in bodies
    ]
    given = spark.createDataFrame(proposals, ", ".join(f"{c} string" for c in PROPOSAL_COLUMNS))
    save_batch(spark, lake, given, listing, file_parts(root, part), "s", datetime(2024, 1, 1, tzinfo=timezone.utc))


def test_saved_sources_of_every_format(spark, put, tmp_path, table_name):
    """One outcome per source; what one loader cannot read costs its own sources only."""
    import io

    import pyarrow as pa
    import pyarrow.orc as orc
    import pyarrow.parquet as pq

    from lake_ingest.sources.loaders import register_loader

    def columnar(write, **columns):
        held = io.BytesIO()
        write(pa.table(columns), held)
        return held.getvalue()

    def load_data(spark, source_path):
        if spark.read.text(source_path).where("value = 'break'").count():
            raise RuntimeError("own loader failed")
        return spark.read.text(source_path).selectExpr("split(value, ';')[0] AS a", "split(value, ';')[1] AS b")

    register_loader("pairs", load_data)
    lake = Lake(str(tmp_path / "lake"))
    bodies = {
        "a.json": '{"a": 1, "b": "json"}',
        "b.jsonl": '{"a": 2, "b": "lines"}\n{"a": "x"}\n{oops\n',
        "c.csv": "a,b\n3,csv\n4,more\nspoilt,x\n",
        "d.csv": "b,a\nturned,5\n",
        "e.csv": "a,b\n",
        "f.csv": "",
        "g.parquet": columnar(pq.write_table, a=[6], b=["parquet"]),
        "h.parquet": columnar(pq.write_table, A=[7.0]),
        "i.parquet": "no parquet",
        "j.orc": columnar(orc.write_table, a=[8], b=["orc"]),
        "k.pairs": "9;own\n",
        "l.pairs": "break\n",
        "m.txt": "text\n",
        "n.csv.unknown": "10,x",
    }
    _save(spark, lake, put, bodies, table_name)
    loader = F.when(F.col("source_key").endswith(".pairs"), "pairs").otherwise(plan.loader_of("source_key"))
    log = plan.run_saved(spark, lake, table_name, "r", SCHEMA, loader=loader, path=f"{lake.root}/t").first()
    assert log.status == "SUCCESS"
    state = dict(rows(load_state(spark, lake.state), "source_key", "status"))
    assert {k for k, s in state.items() if s != "success"} == {"f.csv", "i.parquet", "l.pairs", "n.csv.unknown"}
    assert set(state) == set(bodies)
    got = rows(spark.table(table_name), "a", "b")
    assert got == sorted(
        [(1, "json"), (2, "lines"), (3, "csv"), (4, "more"), (5, "turned"), (6, "parquet"), (7, None), (8, "orc"), (9, "own"), (None, None)],
        key=repr,
    )
    rejects = read_table(spark, lake.rejects, plan.REJECTS)
    assert sorted(r.source_key for r in rejects.collect()) == ["b.jsonl", "b.jsonl", "c.csv", "n.csv.unknown"]
    assert not (tmp_path / "lake" / "restored" / "files").exists() or not any((tmp_path / "lake" / "restored" / "files").iterdir())


def test_a_run_opens_the_row_groups_of_its_sources(spark, put, tmp_path, table_name):
    """No content in an exchange, and of the raw table's contents only what the waiting sources have."""
    from lake_ingest.sources import restored

    lake = Lake(str(tmp_path / "lake"))
    _save(spark, lake, put, {f"{i}.json": json.dumps({"a": i}) for i in range(30)}, table_name)
    raw = read_table(spark, lake.raw, schemas.RAW_PARTS)
    state = load_state(spark, lake.state).where("source_key = '7.json'")
    waiting = state.selectExpr("proposal_id AS ingestion_id", "source_key", "'json' AS loader", "etag", "source_size AS size")
    found = restored.preserved_contents(raw, waiting)
    assert [bytes(r.content) for r in found.collect()] == [b'{"a": 7}']
    text = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "part" in line.split("ReadSchema")[-1]]
    assert scans and not any("content" in line.split("ReadSchema")[-1] for line in scans)


def test_a_large_document_is_an_outcome_of_its_own(spark, put, tmp_path, monkeypatch):
    from lake_ingest.sources import contents

    root = put("big.json", "[" + "1," * 50 + "1]")
    put("small.json", "{}")
    monkeypatch.setattr(contents, "MAX_CONTENT", 20)
    found = spark.createDataFrame([("big.json", 102), ("small.json", 2)], "key string, size bigint")
    assert rows(file_contents(root)(found), "key", "error") == [("big.json", contents.TOO_LARGE), ("small.json", None)]


def test_saved_sources_run_from_their_copies(spark, put, tmp_path, table_name):
    lake = Lake(str(tmp_path / "lake"))
    bodies = {"a.json": json.dumps({"a": 1, "b": "x" * 50}), "b.json": '{"a": 2}', "c.json": '{"a": 3}', "d.json": "no"}
    for key, body in bodies.items():
        root = put(key, body)
    listing = fingerprint(list_objects(spark, root), root, smallest=16)
    proposals = [
        (k, "p", "def load_data(spark, source_path): pass", json.dumps({"source_key": k}), "m", "q", table_name)
        for k in bodies
    ]
    given = spark.createDataFrame(proposals, ", ".join(f"{c} string" for c in PROPOSAL_COLUMNS))
    save_batch(spark, lake, given, listing, file_parts(root, 16), "s", datetime(2024, 1, 1, tzinfo=timezone.utc))
    # The sources may go: the copies are what is run. One copy loses its bytes.
    for key in bodies:
        (tmp_path / "incoming" / key).unlink()
    raw = read_table(spark, lake.raw, schemas.RAW_PARTS)
    spoilt = F.when(F.col("source_key") == "c.json", F.lit(b'{"a": 4}')).otherwise(F.col("content"))
    kept = spark.createDataFrame(raw.withColumn("content", spoilt).withColumn("part_md5", F.md5(spoilt)).drop("batch_id").collect(), schemas.RAW_PARTS)
    write_batch(kept, lake.raw, "save-s")
    log = plan.run_saved(spark, lake, table_name, "r", SCHEMA, path=f"{lake.root}/t").first()
    assert log.status == "SUCCESS"
    assert rows(spark.table(table_name), "a", "b") == [(1, "x" * 50), (2, None)]
    state = dict(rows(load_state(spark, lake.state), "source_key", "status"))
    assert state == {"a.json": "success", "b.json": "success", "c.json": "failed", "d.json": "failed"}
    again = plan.run_saved(spark, lake, table_name, "r2", SCHEMA, path=f"{lake.root}/t").first()
    assert again.rows_in == 0 and spark.table(table_name).count() == 2


def test_a_row_group_is_read_once_for_all_its_sources(spark, tmp_path, monkeypatch):
    """Small sources lie in a raw file in any order of their identifiers; a task goes through it by its rows."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from lake_ingest.sources import restored
    from lake_ingest.sources.store import store_options

    bodies = {f"{i * 7919 % 1000:04}": f'{{"a": {i}}}'.encode() for i in range(200)}
    ids, contents = list(bodies), list(bodies.values())
    # The last source has two parts, in the first row group and in the last one.
    ids, contents, part = [ids[-1], *ids], [b"[", *contents], [0] * 200 + [1]
    (tmp_path / "raw").mkdir()
    pq.write_table(
        pa.table({"ingestion_id": ids, "part": pa.array(part, pa.int64()), "content": pa.array([b"[", *bodies.values()], pa.binary())}),
        tmp_path / "raw" / "a.parquet", row_group_size=20,
    )
    raw = spark.read.schema(schemas.RAW_PARTS).parquet(str(tmp_path / "raw"))
    given = [(i, i, "json", None, 0) for i in bodies]
    waiting = spark.createDataFrame(given, "ingestion_id string, source_key string, loader string, etag string, size bigint")
    work = restored._work(raw, waiting, 1).collect()
    reads = []
    read = pq.ParquetFile.read_row_group
    monkeypatch.setattr(
        pq.ParquetFile, "read_row_group", lambda self, group, columns: reads.append((group, columns)) or read(self, group, columns)
    )
    files = restored.RawFiles(store_options(spark))
    got = {r.ingestion_id: [files.part(p.path, p.row) for p in r.parts] for r in work}
    last = ids[-1]
    assert got == {i: [b"[", b] if i == last else [b] for i, b in bodies.items()}
    # Eleven groups; two more reads go to the last one and back to the first.
    assert len(reads) <= 13 and {columns[0] for _, columns in reads} == {"content"}
