import hashlib
import os

import pytest

from lake_ingest.operators import listing, sampling
from lake_ingest.sources.datasources import register_sources
from tests.conftest import rows


def test_lists_hidden_empty_and_nested_files(spark, put):
    for key, content in {"a.json": "{}", "empty": "", "_x": "1", ".y": "22", "d/e/f.txt": "333", "d/g": "4"}.items():
        root = put(key, content)
    found = listing.list_objects(spark, root)
    assert rows(found, "key", "size") == [
        (".y", 2), ("_x", 1), ("a.json", 2), ("d/e/f.txt", 3), ("d/g", 1), ("empty", 0),
    ]
    assert rows(listing.list_objects(spark, root, prefix="/d/"), "key") == [("d/e/f.txt",), ("d/g",)]
    assert rows(listing.list_objects(spark, root, depth=3), "key") == rows(found, "key")
    assert rows(listing.list_objects(spark, root, prefix="none"), "key") == []
    stamp = found.where("key = 'd/g'").selectExpr("unix_micros(last_modified)").first()[0]
    assert stamp == os.stat(f"{root}/d/g").st_mtime_ns // 1000


def test_missing_root_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="no such folder"):
        listing.list_objects(spark, str(tmp_path / "none")).count()


def test_drop_markers_and_prefix(spark):
    df = spark.createDataFrame([("a/",), ("a/b",), ("ab",), ("/",)], "key string")
    assert rows(listing.drop_markers(df)) == [("a/b",), ("ab",)]
    assert rows(listing.under_prefix(df, "a")) == [("a/",), ("a/b",)]
    assert listing.under_prefix(df, "/") is df


def _etag(content, part):
    parts = [hashlib.md5(content[i : i + part]) for i in range(0, max(len(content), 1), part)]
    if len(parts) == 1:
        return parts[0].hexdigest()
    return hashlib.md5(b"".join(p.digest() for p in parts)).hexdigest() + f"-{len(parts)}"


def test_fingerprints_of_files_and_of_columns_agree(spark, put):
    contents = {f"f{n}": os.urandom(n) for n in (0, 1, 9, 10, 11, 20, 101)}
    for key, content in contents.items():
        root = put(key, content)
    found = listing.fingerprint(listing.list_objects(spark, root), root, smallest=10)
    expected = sorted((k, _etag(c, 10)) for k, c in contents.items())
    assert rows(found, "key", "etag") == expected
    df = spark.createDataFrame([(k, bytearray(c)) for k, c in contents.items()], "key string, b binary")
    assert rows(df.select("key", listing.content_etag("b", 10))) == expected


def test_parts_have_one_length_at_every_size(spark):
    df = spark.createDataFrame([("k", 0), ("l", 10_000), ("m", 25_001)], "key string, size bigint")
    parts = listing.split_into_parts(df, smallest=1).groupBy("key").agg(
        {"part": "count", "length": "sum", "start_byte": "max"}
    )
    found = {r.key: (r["count(part)"], r["sum(length)"]) for r in parts.collect()}
    assert found == {"k": (1, 0), "l": (10_000, 10_000), "m": (25_001, 25_001)}


def test_only_touched_files_are_hashed_again(spark, put):
    root = put("same", "1")
    put("edited", "2")
    first = listing.fingerprint(listing.list_objects(spark, root), root).selectExpr(
        "key AS source_key", "concat('kept-', etag) AS etag", "size AS source_size",
        "last_modified AS source_modified",
    )
    state = spark.createDataFrame(first.collect(), first.schema)
    put("edited", "33")
    put("new", "4")
    found = dict(rows(listing.fingerprint_changed(listing.list_objects(spark, root), state, root), "key", "etag"))
    assert found["same"].startswith("kept-")
    assert found["edited"] == _etag(b"33", 99) and found["new"] == _etag(b"4", 99)


REQUESTS = [
    (("in", "", 0, 10, 0), "source_key must be"),
    (("in", None, 0, 10, 0), "source_key must be"),
    (("in", "/x", -1, 10, 0), "source_key must be"),
    (("in", "k", -1, 10, 9), "start_byte must be"),
    (("other", "k", 0, 10, 6), "a single file can be read"),
    (("other", "k", 0, 10, 5), "Bucket is not permitted"),
    (("in", "k", 0, 10, 5), None),
    ((None, "k", 0, 0, 0), None),
    (("", "k", 0, -5, 0), None),
    (("data", "k", 0, 1_000_000, 0), None),
    (("data", "k", None, None, None), None),
]


def test_read_requests(spark):
    schema = "bucket string, key string, start_byte bigint, max_bytes bigint, read_count int"
    df = spark.createDataFrame([r for r, _ in REQUESTS], schema).coalesce(1)
    found = sampling.validate_reads(df, ["in", "data"], "in").collect()
    for row, (_, error) in zip(found, REQUESTS):
        assert (row.error is None) if error is None else row.error.startswith(error)
    assert [r.max_bytes for r in found[-4:]] == [1, 1, 65536, 65536]
    assert [r.bucket for r in found[-4:]] == ["in", "in", "data", "data"]
    assert (found[-1].start_byte, found[-1].read_count) == (0, 0)


def test_reads_from_files(spark, put):
    root = put("k", "0123456789")
    put("empty", "")
    requests = [("k", 0, 4), ("k", 9, 4), ("k", 10, 4), ("k", 99, 4), ("empty", 0, 4), ("gone", 0, 4)]
    df = spark.createDataFrame(requests, "key string, start_byte bigint, max_bytes bigint")
    found = sampling.read_ranges(df, root)
    assert rows(found.where("error IS NULL"), "key", "start_byte", "content", "bytes_read", "next_start_byte", "eof") == [
        ("empty", 0, bytearray(b""), 0, 0, True),
        ("k", 0, bytearray(b"0123"), 4, 4, False),
        ("k", 10, bytearray(b""), 0, 10, True),
        ("k", 9, bytearray(b"9"), 1, 10, True),
        ("k", 99, bytearray(b""), 0, 10, True),
    ]
    (lost,) = found.where("error IS NOT NULL").collect()
    assert lost.key == "gone" and lost.error.startswith("Unable to read") and lost.content is None


def test_byte_range_source(spark, put):
    root = put("k", "0123456789")
    register_sources(spark)
    reader = spark.read.format("byte_range").option("max_bytes", "4")
    found = reader.option("reads", "5").load(f"{root}/k").orderBy("read_count").collect()
    assert [bytes(r.content) for r in found] == [b"0123", b"4567", b"89"]
    assert [r.eof for r in found] == [False, False, True]
    past = reader.option("start_byte", "50").load(f"{root}/k").collect()
    assert [(r.bytes_read, r.next_start_byte, r.eof) for r in past] == [(0, 10, True)]


def test_chunks_join_to_the_object_and_decode_like_python(spark):
    contents = {f"k{n}": os.urandom(n) for n in (0, 1, 7, 8, 9, 40)}
    contents["text"] = "äöü€😀 wide".encode()
    df = spark.createDataFrame([(k, bytearray(c)) for k, c in contents.items()], "key string, b binary")
    chunks = sampling.sample_chunks(df, "key", "b", 8).withColumn("text", sampling.decode_lossy("content"))
    joined = {}
    for row in chunks.orderBy("key", "read_count").collect():
        joined.setdefault(row.key, []).append(row)
    assert {k: b"".join(bytes(r.content) for r in v) for k, v in joined.items()} == contents
    for found in joined.values():
        assert [r.eof for r in found] == [False] * (len(found) - 1) + [True]
        assert all(r.text == bytes(r.content).decode("utf-8", errors="replace") for r in found)


def test_at_most_five_chunks(spark):
    df = spark.createDataFrame([("k", bytearray(100))], "key string, b binary")
    found = sampling.sample_chunks(df, "key", "b", 8).collect()
    assert len(found) == 5 and found[-1].next_start_byte == 40 and not found[-1].eof
