"""Inputs that are seldom and must neither be lost nor end a whole batch."""

import hashlib
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from lake_ingest.operators import conform, listing, sampling
from lake_ingest.operators.artifacts import file_parts
from lake_ingest.operators.validate import is_loader_script, validate_profiles
from lake_ingest.plans.lake import Lake
from lake_ingest.plans.run_ingestion import REJECTS, run_ingestion
from lake_ingest.operators.tables import read_table
from lake_ingest.plans.save_batch import PROPOSAL_COLUMNS, save_batch
from lake_ingest.sources import loaders
from lake_ingest.sources.datasources import ObjectListingReader
from lake_ingest.sources.store import join
from lake_ingest.streaming.incremental import ingest_new_files
from tests.conftest import rows


def test_malformed_csv_lines_are_set_aside(spark, put, tmp_path, table_name):
    root = put("x.csv", 'a,b,c\n1,2,3\n4,5,6,7\n10\n8,9,"open\nrest"\n11,12,"x, y"\n\n')
    records = loaders.csv_records(spark, f"{root}/x.csv")
    assert rows(records.where("_corrupt_record IS NULL"), "a", "b", "c") == [("1", "2", "3"), ("11", "12", "x, y")]
    assert rows(records.where("_corrupt_record IS NOT NULL"), "_corrupt_record") == [
        ("10",), ("4,5,6,7",), ('8,9,"open',), ('rest"',),
    ]
    with pytest.raises(Exception, match="malformed CSV record"):
        loaders.load_source(spark, f"{root}/x.csv").collect()
    lake = Lake(str(tmp_path / "lake"))
    log = run_ingestion(spark, lake, f"{root}/x.csv", table_name, "r", schema="a int, b int, c string").first()
    assert (log.rows_in, log.rows_written, log.rows_rejected) == (6, 1, 5) or (
        log.rows_in, log.rows_written, log.rows_rejected
    ) == (6, 2, 4)
    assert read_table(spark, lake.rejects, REJECTS).count() == log.rows_rejected


def test_names_are_found_as_spark_finds_them(spark):
    df = spark.createDataFrame([("1", "2.5", " x")], "`pm.ra` string, RA string, other string")
    found = conform.convert_types(df, "`pm.ra` int, ra double, absent date")
    assert found.columns == ["pm.ra", "ra", "absent"] and [tuple(r) for r in found.collect()] == [(1, 2.5, None)]
    good, bad = conform.quarantine(df, "`pm.ra` int, ra int, absent date")
    assert good.count() == 0 and rows(bad, "rejected_columns") == [(["ra"],)]
    assert [tuple(r) for r in conform.missing_values(df, tokens=("1", "x")).collect()] == [(None, "2.5", None)]
    from pyspark.sql import types as T

    with pytest.raises(ValueError, match="required column is missing: must"):
        conform.convert_types(df, T.StructType([T.StructField("must", T.IntegerType(), False)]))


def test_white_space_around_missing_tokens(spark):
    df = spark.createDataFrame([("\tNA\n",), ("\t",), (" n/a ",), ("\x1c",), (" na x",)], "t string")
    assert rows(conform.missing_values(df)) == [(" na x",), (None,), (None,), (None,), (None,)]


def test_keys_stay_below_their_root(spark, put, tmp_path):
    root = put("in.txt", "inside")
    (tmp_path / "secret").write_text("outside")
    for key in ("../secret", "a/../../secret", "./in.txt", ".."):
        with pytest.raises(PermissionError):
            join(root, key)
    keys = spark.createDataFrame([("../secret",), ("in.txt",)], "key string")
    requests = keys.selectExpr("key", "0L AS start_byte", "9L AS max_bytes")
    read = {r.key: r for r in sampling.read_ranges(requests, root).collect()}
    assert read["../secret"].content is None and read["../secret"].error
    assert bytes(read["in.txt"].content) == b"inside"
    listed = keys.selectExpr("key", "'b' AS bucket", "7L AS size", "CAST(NULL AS timestamp) AS last_modified")
    assert dict(rows(listing.fingerprint(listed, root), "key", "etag"))["../secret"] is None
    saves = keys.selectExpr("key AS ingestion_id", "key AS source_key", "'raw' AS raw_location", "6L AS size")
    assert rows(file_parts(root)(saves), "source_key") == [("in.txt",)]


def test_a_request_is_served_from_its_bucket(spark, put, tmp_path):
    root = put("k", "incoming")
    (tmp_path / "lake").mkdir()
    (tmp_path / "lake" / "k").write_text("preserved")
    requests = spark.createDataFrame([("k", b) for b in ("incoming", "lake", "other")], "key string, bucket string")
    requests = requests.selectExpr("*", "0L AS start_byte", "20L AS max_bytes")
    read = sampling.read_ranges(requests, {"incoming": root, "lake": str(tmp_path / "lake")}).collect()
    found = {r.bucket: (r.content and bytes(r.content), r.error) for r in read}
    assert found == {
        "incoming": (b"incoming", None), "lake": (b"preserved", None), "other": (None, "Bucket is not permitted"),
    }


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 40, 41, 95, 400, 1234])
def test_fingerprints_do_not_depend_on_the_place(spark, put, n):
    content = bytes(i * 7 % 251 for i in range(n))
    root = put("f", content)
    parts = [hashlib.md5(content[i : i + 10]).digest() for i in range(0, max(n, 1), 10)]
    blocks = [parts[i : i + 4] for i in range(0, len(parts), 4)]
    digests = [b[0] if len(b) == 1 else hashlib.md5(b"".join(b)).digest() for b in blocks]
    top = digests[0] if len(digests) == 1 else hashlib.md5(b"".join(digests)).digest()
    expected = top.hex() + (f"-{len(parts)}" if len(parts) > 1 else "")
    of_file = listing.fingerprint(listing.list_objects(spark, root), root, smallest=10, block_parts=4).first().etag
    df = spark.createDataFrame([(bytearray(content),)], "c binary")
    assert of_file == expected == df.select(listing.content_etag("c", 10, 4)).first()[0]


def test_an_empty_etag_is_unknown(spark, put):
    root = put("f", "12345")
    listed = listing.list_objects(spark, root)
    state = listed.selectExpr("key AS source_key", "'' AS etag", "size AS source_size", "last_modified AS source_modified")
    assert listing.fingerprint_changed(listed, state, root).first().etag == hashlib.md5(b"12345").hexdigest()


def test_a_deleted_file_does_not_end_the_batch(spark, put, tmp_path):
    put("a", "a")
    root = put("b", "b")
    listed = listing.fingerprint(listing.list_objects(spark, root), root)
    listed = spark.createDataFrame(listed.collect(), listed.schema)
    (tmp_path / "incoming" / "a").unlink()
    again = dict(rows(listing.fingerprint(listed.drop("etag"), root), "key", "etag"))
    assert again == {"a": None, "b": hashlib.md5(b"b").hexdigest()}
    loader = "def load_data(spark, source_path): pass"
    half = r'{"source_key": "b", "note": "\ud800"}'
    whole = r'{"source_key": "b", "note": "😀 \\ud800"}'
    minus = "x = " + "-" * 200_000 + "1"
    proposals = [
        ("a", "p", loader, '{"source_key": "a"}', "m", "q", "t"),
        ("b", "half", loader, half, "m", "q", "t"),
        ("b", "deep", minus, '{"source_key": "b"}', "m", "q", "t"),
        ("b", "good", loader, whole, "m", "q", "t"),
    ]
    given = spark.createDataFrame(proposals, ", ".join(f"{c} string" for c in PROPOSAL_COLUMNS))
    lake = Lake(str(tmp_path / "lake"))
    result = save_batch(spark, lake, given, listed, file_parts(root), "r", datetime(2024, 1, 1, tzinfo=timezone.utc))
    assert rows(result.accepted, "source_key") == [("b",)]
    assert rows(result.rejected) == [("a", "NOT_VERIFIED"), ("b", "INVALID_LOADER"), ("b", "INVALID_TEXT")]


def test_a_listed_source_without_fingerprint_is_not_missing(spark, put, tmp_path):
    root = put("a", "a")
    listed = listing.list_objects(spark, root).withColumn("etag", F.lit(None).cast("string"))
    proposal = ("a", "p", "def load_data(spark, source_path): pass", '{"source_key": "a"}', "m", "q", "t")
    given = spark.createDataFrame([proposal], ", ".join(f"{c} string" for c in PROPOSAL_COLUMNS))
    lake = Lake(str(tmp_path / "lake"))
    result = save_batch(spark, lake, given, listed, file_parts(root), "r", datetime(2024, 1, 1, tzinfo=timezone.utc))
    assert rows(result.accepted, "source_key", "etag") == [("a", hashlib.md5(b"a").hexdigest())]


def test_verdicts_of_escaped_halves(spark):
    texts = [r'{"source_key": "k", "n": "\ud800"}', r'{"source_key": "k", "n": "😀"}', r'{"source_key": "k", "n": "\\ud800"}']
    df = spark.createDataFrame([(t, "k") for t in texts], "p string, source_key string")
    verdicts = {r.p: r.verdict for r in validate_profiles(df, "p", "source_key").collect()}
    assert [verdicts[t] for t in texts] == ["INVALID_TEXT", "OK", "OK"] and json.loads(texts[2])
    deep = spark.createDataFrame([("x = " + "-" * 200_000 + "1",)], "s string")
    assert rows(deep.select(is_loader_script("s"))) == [(False,)]


def test_streams_do_not_overwrite_each_other(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "target")
    spark.range(5).write.json(f"{source}/a")
    options = {"recursiveFileLookup": "true"}
    for stream in ("one", "two"):
        ingest_new_files(
            spark, source, "json", "id bigint", target, str(tmp_path / stream), None, options, stream
        ).awaitTermination()
    assert spark.read.parquet(target).count() == 10
    with pytest.raises(ValueError, match="does not exist"):
        ingest_new_files(spark, source, "json", "id bigint", target, str(tmp_path / "new"), None, options, "one")


def test_partitions_hold_no_files(tmp_path):
    for i in range(300):
        (tmp_path / f"f{i}").write_text("x")
    (tmp_path / "sub").mkdir()
    partitions = ObjectListingReader({"path": str(tmp_path), "tasks": "4"}).partitions()
    assert sorted(path for p in partitions for path in (*p.flat, *p.whole)) == [str(tmp_path), str(tmp_path / "sub")]


def test_records_equal_to_the_csv_header_stay(spark, put, tmp_path, table_name):
    root = put("one.csv", "name\nx\nname\nname\n \n")
    assert rows(loaders.csv_records(spark, f"{root}/one.csv"), "name") == [(" ",), ("name",), ("name",), ("x",)]
    log = run_ingestion(spark, Lake(str(tmp_path / "lake")), f"{root}/one.csv", table_name, "r", schema="name string")
    assert log.first().rows_in == 4


def test_each_csv_file_has_a_header(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    for name, text in (
        ("1.csv", "a,b\n1,2\na,b\n"),
        ("2.csv", "\ufeffa,b\n3,4\n"),
        ("3.csv", '"a","b"\n5,6\n'),
        ("4.csv", "A,b\n" + "7,8\n" * 40),
        ("5.csv", "\n"),
    ):
        (folder / name).write_text(text)
    records = loaders.csv_records(spark, str(folder))
    assert rows(records.where("_corrupt_record IS NULL"), "a", "b") == [("1", "2"), ("3", "4"), ("5", "6"), ("a", "b")]
    assert rows(records.where("_corrupt_record IS NOT NULL"), "_corrupt_record") == [("7,8",)] * 40 + [("A,b",)]
