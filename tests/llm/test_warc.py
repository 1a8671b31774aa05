import base64
import glob
import gzip
import hashlib
import os

import pytest

from lake_ingest.llm import warc

PAGES = [
    (1, "http://a.example/\nx", "<p>é</p>"),
    (2, None, "<p>é</p>"),
    (2, "http://b.example", "<p>é</p>"),
    (None, "u", None),
    (3, "u", ""),
    (None, "v", ""),
    (4, "w", "x" * 100),
    (5, "", "x" * 100),
    (6, "z", "y" * 5000),
    (7, None, None),
]


def _files(root):
    return {os.path.basename(f): open(f, "rb").read() for f in glob.glob(f"{root}/*.warc.gz")}


def _pages(spark, rows=PAGES):
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0))


def test_records_are_read_back(spark, tmp_path):
    root = str(tmp_path / "warc")
    manifest = warc.write_archives(warc.records(_pages(spark)), root, shards=3, roll_bytes=700).collect()
    assert sum(m.records for m in manifest) == len(PAGES) and len(manifest) > 3
    rows = warc.read_archives(spark, root).collect()
    expected = []
    for page, _, html in PAGES:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        top = max(p for p, _, h in PAGES if p is not None and (h or "") == (html or ""))
        expected.append((page, len(payload), digest, None if page == top else top))
    # Of the two rows of page 2 one is the response and the other revisits it.
    expected[2] = (*expected[2][:3], 2)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all((r.record_type == "response") == (r.refers_to is None) for r in rows)


def test_files_are_equal_whatever_the_partitions(spark, tmp_path):
    roots = [str(tmp_path / n) for n in "ab"]
    for root, parts in zip(roots, (1, 5)):
        warc.write_archives(warc.records(_pages(spark).repartition(parts)), root, shards=4)
    assert _files(roots[0]) == _files(roots[1]) != {}


def test_each_record_is_a_gzip_member(spark, tmp_path):
    root = str(tmp_path / "warc")
    warc.write_archives(warc.records(_pages(spark)), root, shards=1)
    content = b"".join(_files(root).values())
    assert gzip.decompress(content).count(b"WARC/1.1\r\n") == len(PAGES) + 1
    assert not glob.glob(f"{root}/.*.tmp")


def test_small_payloads_are_responses(spark, tmp_path):
    root = str(tmp_path / "warc")
    warc.write_archives(warc.records(_pages(spark), least_bytes=50), root, shards=2)
    kinds = {(r.page_id, r.record_type) for r in warc.read_archives(spark, root).collect()}
    assert {(1, "response"), (3, "response"), (4, "revisit"), (5, "response")} <= kinds


def test_uncommitted_files_are_not_read(spark, tmp_path):
    root = str(tmp_path / "warc")
    warc.write_archives(warc.records(_pages(spark)), root, shards=2)
    before = warc.read_archives(spark, root).count()
    (tmp_path / "warc" / "pages-000009-00000.warc.gz").write_bytes(b"left behind")
    assert warc.read_archives(spark, root).count() == before


def test_spoilt_payload_is_noticed(spark, tmp_path):
    root = str(tmp_path / "warc")
    warc.write_archives(warc.records(_pages(spark, PAGES[-2:-1])), root, shards=1)
    (path,) = glob.glob(f"{root}/*.warc.gz")
    spoilt = gzip.decompress(open(path, "rb").read()).replace(b"yyyy", b"yyyz", 1)
    open(path, "wb").write(gzip.compress(spoilt))
    with pytest.raises(Exception, match="does not match"):
        warc.read_archives(spark, root).collect()


def test_empty_table(spark, tmp_path):
    root = str(tmp_path / "warc")
    assert warc.write_archives(warc.records(_pages(spark, [])), root, shards=2).count() == 0
    assert warc.read_archives(spark, root).count() == 0
