import random

import pytest

from lake_ingest.plans.lake import Lake
from lake_ingest.plans.run_ingestion import run_ingestion
from lake_ingest.sources import csv_lines, loaders
from tests.conftest import rows


def _cells(rng, n):
    parts = ["x", "é", ",", '"', '""', "\n", "\n\n", " ", "a b", "\\", "0", '\n"']
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 6))) for _ in range(n)]


def _quoted(cell):
    return '"' + cell.replace('"', '""') + '"'


def _text(records):
    return "".join(",".join(map(_quoted, r)) + "\n" for r in records)


def _splits(lines, cuts):
    """Lines with a file and a split's start, cut at the given places."""
    bounds = [0, *cuts, len(lines)]
    for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
        for line in lines[a:b]:
            yield line, 7, 100 * i


@pytest.mark.parametrize("seed", range(6))
def test_splits_anywhere_give_the_same_records(seed):
    """Of every split the pieces of the true case, put together, are the records of the whole."""
    rng = random.Random(seed)
    records = [_cells(rng, 3) for _ in range(60)]
    lines = _text(records)[:-1].split("\n")
    want = [",".join(map(_quoted, r)) for r in records]
    for _ in range(20):
        cuts = sorted(rng.sample(range(1, len(lines)), min(len(lines) - 1, rng.randint(0, 25))))
        pieces = list(csv_lines.split_pieces(_splits(lines, cuts), csv_lines.Lines('"')))
        states = sorted((p["start"], p["closed_to"], p["open_to"]) for p in pieces if p["kind"] == csv_lines.STATE)
        before, opened = {}, False
        for start, closed_to, open_to in states:
            before[start] = opened
            opened = open_to if opened else closed_to
        got, held = [], []
        true = [p for p in pieces if p["kind"] != csv_lines.STATE and p["opened"] in (None, before[p["start"]])]
        for p in sorted(true, key=lambda p: (p["start"], p["at"])):
            if p["kind"] == csv_lines.RECORD:
                got.append(p["value"])
                continue
            held = [*held, p["value"]]
            if p["kind"] == csv_lines.HEAD:
                got.append("\n".join(held))
                held = []
        assert got == want and not held and not opened
        (first,) = [p["value"] for p in pieces if p["first"]]
        assert want[0].startswith(first)


@pytest.mark.parametrize(
    "line, before, after",
    [
        ("a,b", False, False), ("a,b", True, True), ('a,"b', False, True), ('b",c', True, False), ('"a""b"', False, False),
        ('"a""', False, True), ('5" pipe,x', False, False), ('"a","b', False, True), ('x","y', True, True), ("", True, True),
    ],
)
def test_what_a_line_does(line, before, after):
    assert csv_lines.Lines('"').open_after(line, before) is after


def test_escaped_quotes():
    rules = csv_lines.Lines("\\")
    assert not rules.open_after(r'"a \" b",c', False) and rules.open_after(r'"a \"', False)
    assert not rules.open_after('"a \\\\",c', False) and rules.open_after('"a\\', False)


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256b")
    yield
    spark.conf.set(name, before)


def test_values_with_line_breaks_over_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(9)
    folder = tmp_path / "in.csv"
    folder.mkdir()
    want = []
    for i in range(3):
        records = [_cells(rng, 3) for _ in range(20)]
        # A record longer than several splits, and one with nothing but breaks.
        records += [["long " * 100, "\n" * 300, str(i)], ["\n", "", "\r"]]
        (folder / f"{i}.csv").write_bytes(("a,b,c\n" + _text(records)).encode())
        want += [tuple(c.replace("\r", "\n") or None for c in r) for r in records]
    got = loaders.load_source(spark, str(folder), "csv_multiline")
    assert got.columns == ["a", "b", "c"]
    assert sorted((tuple(c or None for c in r) for r in rows(got)), key=repr) == sorted(want, key=repr)


def test_a_quote_that_never_ends_is_set_aside(spark, put, tmp_path, table_name, small_splits):
    text = 'a,b\n1,"x\ny"\n2\n3,z\n4,"open\n' + "5,rest\n" * 40
    path = put("m.csv", text) + "/m.csv"
    found = loaders.csv_records(spark, path, multiline=True, escape='"')
    assert rows(found.where("_corrupt_record IS NULL"), "a", "b") == [("1", "x\ny"), ("3", "z")]
    assert rows(found.where("_corrupt_record IS NOT NULL"), "_corrupt_record") == [
        ("2",), ('4,"open\n' + "\n".join(["5,rest"] * 40),),
    ]
    with pytest.raises(Exception, match="malformed CSV record"):
        loaders.load_source(spark, path, "csv_multiline").collect()
    lake = Lake(str(tmp_path / "lake"))
    log = run_ingestion(spark, lake, path, table_name, "r", loader="csv_multiline", schema="a int, b string").first()
    assert (log.rows_in, log.rows_written, log.rows_rejected) == (4, 2, 2)


def test_a_record_too_long_for_a_row_comes_in_pieces(spark, put, monkeypatch, small_splits):
    monkeypatch.setattr(csv_lines, "MAX_RECORD", 100)
    path = put("m.csv", 'a,b\n1,"' + "x\n" * 200 + '"\n2,y\n') + "/m.csv"
    found = loaders.csv_records(spark, path, multiline=True, escape='"')
    assert rows(found.where("_corrupt_record IS NULL"), "a", "b") == [("2", "y")]
    pieces = rows(found.where("_corrupt_record IS NOT NULL"), "_corrupt_record")
    assert len(pieces) > 1 and sum(p.count("x") for (p,) in pieces) == 200


def test_headers_of_other_files_and_compressed_files(spark, tmp_path):
    import gzip

    folder = tmp_path / "many.csv"
    folder.mkdir()
    (folder / "1.csv").write_text('a,b\n1,"x\ny"\n')
    (folder / "2.csv").write_text('﻿"a","b"\n3,4\n')
    (folder / "3.csv").write_text('A,b\n5,"6\n7"\n')
    (folder / "4 %.csv.gz").write_bytes(gzip.compress(b'a,b\n8,"9\n10"\n'))
    found = loaders.csv_records(spark, str(folder), multiline=True, escape='"')
    assert rows(found.where("_corrupt_record IS NULL"), "a", "b") == [("1", "x\ny"), ("3", "4"), ("8", "9\n10")]
    assert rows(found.where("_corrupt_record IS NOT NULL"), "_corrupt_record") == [('5,"6\n7"',), ("A,b",)]


def _scans(spark, df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan text")


def test_lines_are_read_once_or_twice(spark, put):
    path = put("p.csv", "a,b\n1,2\n") + "/p.csv"
    assert _scans(spark, loaders.csv_records(spark, path)) == 1
    # The first reading, for what is not sure, is done by then.
    assert _scans(spark, loaders.csv_records(spark, path, multiline=True)) == 1


@pytest.mark.parametrize("loader", ["csv", "csv_multiline"])
def test_small_splits_share_tasks(spark, put, small_splits, loader):
    """The number of tasks goes by the bytes and the cluster, not by the size of splits; the rows are the same."""
    root = put("a.csv", "a,b\n" + "".join(f"{i},{i} text\n" for i in range(3000)))
    path = f"{root}/a.csv"
    splits = spark.read.text(path).rdd.getNumPartitions()
    size = spark.read.format("binaryFile").load(path).first().length
    lines = csv_lines._split_lines(spark, path, size)
    assert lines.rdd.getNumPartitions() <= 4 < splits
    starts = {r.start for r in lines.select("start").distinct().collect()}
    assert len(starts) > 4
    found = loaders.load_source(spark, path, loader)
    assert rows(found) == sorted([(str(i), f"{i} text") for i in range(3000)], key=repr)
