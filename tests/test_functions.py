import random
from datetime import datetime, timedelta, timezone
from pathlib import PurePosixPath

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lake_ingest.functions import documents, keys, text
from lake_ingest.operators.artifacts import ingestion_id


def _apply(spark, values, type_name, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
    return [r[0] for r in df.select("i", expression.alias("out")).orderBy("i").select("out").collect()]


def test_object_name_is_posix_name(spark):
    pieces = ["a", "b.json", ".", "..", "/", "//", "x y", "ü", "\n", ".hidden", "a."]
    rnd = random.Random(1)
    paths = ["", "/", ".", "./", "a/.", "a/..", "/.", "a//.//", "././."]
    paths += ["".join(rnd.choices(pieces, k=rnd.randint(1, 6))) for _ in range(2000)]
    expected = [PurePosixPath(p).name for p in paths]
    assert _apply(spark, paths, "string", keys.object_name("v")) == expected


def test_destination_keys(spark):
    df = spark.createDataFrame([("in/gaia.json", "id-1")], "k string, i string")
    found = df.select(F.inline(keys.destination_keys("k", "i", "raw/"))).collect()
    assert [(r.kind, r.key) for r in found] == [
        ("source", "raw/id-1-gaia.json/gaia.json"),
        ("source_loader", "raw/id-1-gaia.json/source_loader.py"),
        ("profile", "raw/id-1-gaia.json/profile.json"),
        ("prompt", "raw/id-1-gaia.json/prompt.md"),
        ("proposal", "raw/id-1-gaia.json/proposal.md"),
        ("semantic_metadata", "raw/id-1-gaia.json/semantic-metadata.md"),
        ("execution_log", "raw/id-1-gaia.json/execution.log"),
    ]


def test_ingestion_id_is_a_uuid_text_of_its_parts(spark):
    import uuid

    df = spark.createDataFrame([("a", "b"), ("ab", "")], "x string, y string")
    first, second = [r[0] for r in df.select(ingestion_id("x", "y")).collect()]
    assert str(uuid.UUID(first)) == first and first != second


def test_normalize_etag(spark):
    assert _apply(spark, ['"abc"', "abc", None, '""'], "string", keys.normalize_etag("v")) == [
        "abc", "abc", "", "",
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_utc_is_isoformat_in_any_session_zone(spark, zone):
    # Across both clock changes of 2024 in New York, with and without microseconds.
    start = datetime(2024, 3, 10, tzinfo=timezone.utc)
    moments = [start + timedelta(minutes=17 * i, microseconds=i % 3 * 120) for i in range(120)]
    start = datetime(2024, 11, 3, tzinfo=timezone.utc)
    moments += [start + timedelta(minutes=17 * i) for i in range(120)]
    micros = [int((m - datetime(1970, 1, 1, tzinfo=timezone.utc)) / timedelta(microseconds=1)) for m in moments]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(list(enumerate(micros)), "i int, us bigint")
        walls = df.select("i", F.timestamp_micros("us").alias("t")).withColumn("w", keys.utc_wall_clock("t"))
        found = [r[0] for r in walls.orderBy("i").select(keys.iso_utc("w")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == [m.isoformat() for m in moments]


def test_has_text_agrees_with_strip_for_every_character(spark):
    points = [p for p in range(0x11000) if not 0xD800 <= p <= 0xDFFF]
    chars = [chr(p) for p in points]
    assert _apply(spark, chars, "string", text.has_text("v")) == [bool(c.strip()) for c in chars]
    assert _apply(spark, [None, "", " x "], "string", text.has_text("v")) == [False, False, True]


MALFORMED = [
    "41E28242", "FFFE5A", "F09F98", "EDA08078", "6F6BC3", "C080", "F4908080", "F0808041", "8080",
]


def test_decode_lossy_is_python_replace(spark):
    rnd = random.Random(2)
    raw = [bytes.fromhex(h) for h in MALFORMED]
    raw += [rnd.randbytes(rnd.randint(0, 12)) for _ in range(1500)]
    raw += [bytes(rnd.choices([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0], k=8)) for _ in range(1500)]
    found = _apply(spark, [bytearray(r) for r in raw], "binary", text.decode_lossy("v"))
    assert found == [r.decode("utf-8", errors="replace") for r in raw]


STATUSES = {
    '{"ok": false}': "FAILED",
    '{"success": false, "ok": true}': "FAILED",
    '{"ok": 0}': "SUCCESS",
    '{"ok": "false"}': "SUCCESS",
    '{"ok": null}': "SUCCESS",
    '{"error": "x"}': "SUCCESS",
    '{"nested": {"ok": false}}': "SUCCESS",
    "[1]": "SUCCESS",
    "null": "SUCCESS",
    '"error: x"': "SUCCESS",
    " Error: boom": "FAILED",
    "\x1cEXCEPTION: boom": "FAILED",
    "failed:": "FAILED",
    "faıled: x": "SUCCESS",
    "an error: x": "SUCCESS",
    "": "SUCCESS",
    '{"ok": false} trailing': "SUCCESS",
    '{"ok": false': "SUCCESS",
    '{"ok": true, "ok": false}': "FAILED",
    '{"ok": false, "ok": true}': "SUCCESS",
    '{"ok": false, "x": NaN}': "FAILED",
    ' \n{"ok": false}\n': "FAILED",
    "{'ok': false}": "SUCCESS",
}


def test_tool_status(spark):
    df = spark.createDataFrame([(k,) for k in STATUSES], "output string")
    found = {r.output: r.status for r in documents.with_tool_status(df, "output").collect()}
    assert found == STATUSES
    missing = spark.createDataFrame([(None,)], "output string")
    assert documents.with_tool_status(missing, "output").first().status == "SUCCESS"


def test_short_arguments(spark):
    cases = {
        '{"a": 1, "b": "x", "c": null}': {"a": "1", "b": '"x"', "c": "null"},
        '{"t": "%s"}' % ("y" * 118): {"t": '"' + "y" * 118 + '"'},
        '{"t": "%s"}' % ("y" * 119): {"t": '"-content-"'},
        # 120 and 123 characters once written with a space after each comma.
        '{"l": [%s]}' % ",".join(["1"] * 40): {"l": "[" + ",".join(["1"] * 40) + "]"},
        '{"l": [%s]}' % ",".join(["1"] * 41): {"l": '"-content-"'},
        '{"o": {"k": "%s"}}' % ("z" * 112): {"o": '"-content-"'},
        '{"n": %s}' % ("1" * 30): {"n": "1" * 30},
        "[1, 2]": None,
        "not json": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "body string")
    found = {r.body: r.short_arguments for r in documents.with_short_arguments(df, "body").collect()}
    assert found == cases


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.recursive(
    st.none() | st.booleans() | st.integers(-(2**53), 2**53) | st.text(max_size=6),
    lambda c: st.lists(c, max_size=3) | st.dictionaries(st.text(max_size=3), c, max_size=3),
    max_leaves=6,
), min_size=1, max_size=20))
def test_with_document_accepts_what_json_loads_accepts(spark, values):
    import json

    texts = [json.dumps(v, ensure_ascii=False) for v in values]
    texts += [t + " x" for t in texts] + [t + t for t in texts] + [t[:-1] for t in texts]
    texts += ["[" + t for t in texts[:5]] + [t + "," for t in texts[:5]]

    def valid(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False

    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = documents.with_document(df, "t", "d").select("i", F.col("d").isNotNull()).orderBy("i").collect()
    assert [r[1] for r in found] == [valid(t) for t in texts]
