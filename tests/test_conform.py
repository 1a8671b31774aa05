import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lake_ingest.operators import conform, profiling, sink
from lake_ingest.plans.lake import Lake
from lake_ingest.plans.run_ingestion import run_ingestion
from lake_ingest.operators.tables import read_table
from lake_ingest.plans.run_ingestion import REJECTS
from lake_ingest.sources import loaders
from tests.conftest import rows


def test_convert_types(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01"), (" 7 ", "2.5", "no")], "a string, b string, c string")
    found = conform.convert_types(df, "c date, a int, b double")
    assert found.columns == ["c", "a", "b"]
    assert rows(found) == [(None, 7, 2.5), (date(2024, 1, 1), 1, None)] or rows(found) == [
        (date(2024, 1, 1), 1, None), (None, 7, 2.5),
    ]


def test_missing_values(spark):
    df = spark.createDataFrame(
        [(" N/A ", math.nan, 1), ("x ", 2.0, None), ("", None, 3)], "t string, d double, i int"
    )
    found = conform.missing_values(df, defaults={"t": "?", "i": 0}).collect()
    assert [tuple(r) for r in found] == [("?", None, 1), ("x ", 2.0, 0), ("?", None, 3)]


def test_quarantine_keeps_every_row_once(spark):
    df = spark.createDataFrame([("1", "2"), ("x", "2"), ("x", "y"), (None, None)], "a string, b string")
    good, bad = conform.quarantine(df, "a int, b int")
    assert rows(good) == [(1, 2), (None, None)]
    assert rows(bad) == [("x", "2", ["a"]), ("x", "y", ["a", "b"])]


def test_corrupt_records_are_rejected(spark, put, tmp_path, table_name):
    root = put("a.jsonl", '{"a": 1}\n{"a": "x"}\n{broken\n{"a": 3}\n')
    loaders.register_loader("typed", loaders.format_loader("json", "a int"))
    lake = Lake(str(tmp_path / "lake"))
    log = run_ingestion(spark, lake, f"{root}/a.jsonl", table_name, "r", loader="typed", schema="a int")
    assert rows(log, "rows_in", "rows_written", "rows_rejected") == [(4, 2, 2)]
    assert rows(spark.table(table_name)) == [(1,), (3,)]
    kept = rows(read_table(spark, lake.rejects, REJECTS), "rejected_columns", "record")
    assert [r[0] for r in kept] == [["_corrupt_record"]] * 2 and "broken" in kept[0][1] + kept[1][1]


def test_source_without_rows_creates_the_table(spark, put, tmp_path, table_name):
    root = put("empty.csv", "a,b\n")
    lake = Lake(str(tmp_path / "lake"))
    for schema, table in (("a int, b string", table_name), (None, f"{table_name}_plain")):
        log = run_ingestion(spark, lake, f"{root}/empty.csv", table, f"r-{table}", schema=schema)
        assert rows(log, "status", "rows_in", "rows_written") == [("SUCCESS", 0, 0)]
        assert spark.table(table).columns == ["a", "b"] and spark.table(table).count() == 0


CONVERSIONS = [
    " 1 ", "+1", "-0", "1.5", "1e3", "", " ", "x", "n/a", "NaN", "-Infinity", "inf", "0x1p3", "1d", "1f", ".5",
    "5.", "+.5e-3", "9" * 25, "true", " T ", "yes", "no", "0", "1", "off", "N", "\t7\n", "1_000", "1 2", "--1",
    "１", "\x007", "7\x7f", "2024-01-01", "2024-1-1", "2024", "2024-01-01 10:00:00", "epoch", "1\u00a0",
]


@pytest.mark.parametrize(
    "type_name", ["int", "bigint", "smallint", "double", "float", "decimal(10,2)", "boolean", "date", "timestamp_ntz"]
)
def test_conversion_is_exactly_the_cast(spark, type_name):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CONVERSIONS)], "i int, v string")
    cast = f"CAST(try_cast(v AS {type_name}) AS string)"
    expected = [r[0] for r in df.orderBy("i").selectExpr(cast).collect()]
    converted = conform.convert_types(df, f"i int, v {type_name}").orderBy("i").selectExpr("CAST(v AS string)")
    assert [r[0] for r in converted.collect()] == expected


def test_profile_of_odd_columns(spark):
    df = spark.createDataFrame(
        [
            ("1", None, -0.0, datetime(2024, 1, 1), [1], "true", "9" * 30),
            ("2", None, 0.0, datetime(2024, 1, 2), [2], "FALSE", "1e5"),
            ("x'", None, math.inf, None, None, None, ".5"),
        ],
        "a string, `n 1` string, z double, t timestamp_ntz, l array<int>, b string, f string",
    )
    for exact in (True, False):
        found = {r.column_name: r for r in profiling.column_profile(df, exact_distinct=exact).collect()}
        assert len(found) == 7 and {r.rows for r in found.values()} == {3}
        assert (found["a"].inferred_type, found["a"].numeric_count, found["a"].max_value) == ("string", 2, "x'")
        assert (found["n 1"].non_null, found["n 1"].distinct_count, found["n 1"].inferred_type) == (0, 0, "string")
        assert (found["z"].distinct_count, found["z"].min_value) == (2, "0.0")
        assert (found["t"].min_value, found["t"].distinct_count) == ("2024-01-01 00:00:00", 2)
        assert (found["l"].non_null, found["l"].distinct_count, found["l"].min_value) == (2, None, None)
        assert found["b"].inferred_type == "boolean" and found["f"].inferred_type == "double"
    empty = {r.column_name: r for r in profiling.column_profile(df.limit(0), exact_distinct=True).collect()}
    assert empty["a"].rows == 0 and empty["a"].null_ratio is None and len(empty) == 7


def test_findings(spark):
    df = spark.createDataFrame([("1", None, "c"), ("x", None, "c")], "a string, n string, c string")
    found = rows(profiling.profile_findings(profiling.column_profile(df)), "column_name", "finding")
    assert found == [("a", "mixed_types"), ("c", "constant"), ("n", "all_null")]


def test_dictionary_lists_undescribed_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    known = spark.createDataFrame([("a", "An id."), ("zzz", "No column.")], "column_name string, description string")
    found = profiling.column_dictionary(df, profiling.column_profile(df), known)
    assert rows(found, "position", "column_name", "description", "described") == [
        (0, "a", "An id.", True), (1, "b", None, False),
    ]


def test_unknown_is_no_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "a int")
    found = profiling.check_expectations(df, [profiling.Expectation("positive", "a > 0")])
    assert rows(found) == [("positive", 3, 1, False)]


def test_sink_contract(spark, table_name):
    df = spark.createDataFrame([(1, "x")], "a bigint, b string")
    sink.create_or_append(df.limit(0), table_name)
    assert spark.table(table_name).count() == 0
    sink.create_or_append(df, table_name)
    sink.create_or_append(df.select("b", "a"), table_name)
    sink.create_or_append(df.withColumnRenamed("a", "A"), table_name)
    assert rows(spark.table(table_name)) == [(1, "x")] * 3
    for wrong in (df.drop("b"), df.withColumn("c", F.lit(1)), df.withColumn("a", F.lit("text"))):
        with pytest.raises(Exception):
            sink.create_or_append(wrong, table_name)
    assert spark.table(table_name).count() == 3
    with pytest.raises(ValueError):
        sink.create_or_append(df.select(), table_name)


def test_catalog_of_a_name(spark):
    assert not sink.in_v2_catalog(spark, "t")
    assert not sink.in_v2_catalog(spark, "default.t")
    assert not sink.in_v2_catalog(spark, "spark_catalog.default.t")
    spark.conf.set("spark.sql.catalog.lakehouse", "some.Catalog")
    try:
        assert sink.in_v2_catalog(spark, "lakehouse.db.t") and not sink.in_v2_catalog(spark, "db.t")
    finally:
        spark.conf.unset("spark.sql.catalog.lakehouse")


def test_comments_reach_the_table(spark, table_name):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    sink.create_or_append(profiling.with_comments(df, {"a": "An id."}), table_name)
    comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {table_name}").collect()}
    assert comments == {"a": "An id.", "b": None}


def test_loader_interface():
    with pytest.raises(ValueError):
        loaders.register_loader("x", lambda spark, path: None)
    with pytest.raises(ValueError):
        loaders.register_loader("x", lambda spark, *source_path: None)
    with pytest.raises(TypeError):
        loaders.register_loader("x", 1)
    with pytest.raises(KeyError):
        loaders.get_loader("nobody")


def test_load_by_ending(spark, put):
    root = put("a.json", '{\n "a": 1\n}')
    put("b.csv", "a,b\n1,x\n")
    put("c.txt", "l1\nl2\n")
    assert rows(loaders.load_source(spark, f"{root}/a.json")) == [(1,)]
    assert rows(loaders.load_source(spark, f"{root}/b.csv")) == [("1", "x")]
    assert rows(loaders.load_source(spark, f"{root}/c.txt")) == [("l1",), ("l2",)]
    with pytest.raises(ValueError):
        loaders.load_source(spark, f"{root}/d.fits")
