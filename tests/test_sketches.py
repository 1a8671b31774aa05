import pytest
from pyspark.sql import functions as F

from lake_ingest.operators import sketches


def _found(df):
    return {r.column_name: r for r in df.collect()}


def test_batches_merge_to_the_profile_of_the_whole(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.col("id"),
        (F.col("id") % 7 * 1.5).alias("x"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("w"), F.col("id") % 5)).alias("w"),
        F.timestamp_seconds("id").alias("at"),
        F.array("id").alias("nested"),
        F.lit(None).cast("double").alias("none"),
    )
    table = str(tmp_path / "sketches")
    for i in range(4):
        sketches.store_sketches(rows.where(f"id % 4 = {i}"), table, f"b{i}")
    got = _found(sketches.table_profile(spark, table))
    assert set(got) == {"id", "x", "w", "at", "none"}
    assert all(r.rows == 20_000 for r in got.values())
    assert got["w"].non_null == rows.where("w IS NOT NULL").count() and got["none"].non_null == 0
    assert (got["id"].min_value, got["id"].max_value) == ("0.0", "19999.0")
    assert (got["w"].min_value, got["w"].max_value) == ("w0", "w4")
    assert abs(got["id"].distinct_count - 20_000) < 0.06 * 20_000
    assert (got["x"].distinct_count, got["w"].distinct_count, got["none"].distinct_count) == (7, 5, 0)
    assert got["id"].quantiles == pytest.approx([5000, 10_000, 15_000], abs=400)
    assert got["none"].quantiles is None and got["w"].quantiles is None
    exact = {r.w: r["count"] for r in rows.where("w IS NOT NULL").groupBy("w").count().collect()}
    assert {r["item"]: r["count"] for r in got["w"].frequent} == exact


def test_a_batch_that_is_repeated_counts_once(spark, tmp_path):
    table = str(tmp_path / "sketches")
    for _ in range(2):
        sketches.store_sketches(spark.range(10), table, "b")
    assert _found(sketches.table_profile(spark, table))["id"].rows == 10
    with pytest.raises(ValueError, match="no sketches"):
        sketches.table_profile(spark, str(tmp_path / "other"))
