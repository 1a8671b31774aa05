"""Profiles that can be merged: sketches per batch and column, from which a table's profile follows.

A batch is read once, when it is written; the profile of the table is a merge of some rows per batch. Counts
and bounds are exact. Distinct values come from a HyperLogLog sketch (about 2% off), quantiles from a KLL sketch
(about 1.5% of the ranks off), the most frequent values from a frequent-items sketch, exact while a
column has fewer values than it tracks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.functions.keys import quoted, text_literal
from lake_ingest.operators.tables import batch_folders, write_batch

QUANTILES = (0.25, 0.5, 0.75)
# Registers of the distinct sketch (a power of two), ranks of the quantile sketch, values tracked.
_LG_REGISTERS, _RANKS, _TRACKED = 12, 200, 2000


def batch_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column, from one aggregation: exact counts and bounds, and three sketches.

    Numbers have their bounds and quantiles as doubles, other values as texts; columns of nested types are
    left out.
    """
    plain = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    fields = [f for f in df.schema if (columns is None or f.name in columns) and isinstance(f.dataType, plain)]
    inputs, figures, rows = [], ["count(*) AS rows"], []
    for i, field in enumerate(fields):
        number = isinstance(field.dataType, T.NumericType)
        value = quoted(field.name) + (" + 0" if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else "")
        inputs += [f"CAST({value} AS string) AS t{i}", f"CAST({value if number else 'NULL'} AS double) AS x{i}"]
        figures += [
            f"count(t{i}) AS n{i}",
            f"min(x{i}) AS lx{i}", f"max(x{i}) AS hx{i}", f"min(t{i}) AS lt{i}", f"max(t{i}) AS ht{i}",
            f"hll_sketch_agg(t{i}, {_LG_REGISTERS}) AS d{i}",
            f"approx_top_k_accumulate(t{i}, {_TRACKED}) AS f{i}",
        ]
        if number:
            figures.append(f"kll_sketch_agg_double(x{i}, {_RANKS}) AS q{i}")
        text = "NULL" if number else "{0}{1}"
        rows.append(
            f"named_struct('column_name', {text_literal(field.name)}, 'rows', rows, 'non_null', n{i}, 'low', lx{i}, "
            f"'high', hx{i}, 'first', CAST({text.format('lt', i)} AS string), 'last', CAST({text.format('ht', i)} AS string), "
            f"'distinct_values', d{i}, 'quantiles', {f'q{i}' if number else 'CAST(NULL AS binary)'}, 'frequent', f{i})"
        )
    return df.selectExpr(*inputs).agg(*map(F.expr, figures)).select(F.expr(f"inline(array({', '.join(rows)}))"))


def store_sketches(df: DataFrame, table: str, batch_id: str, columns: Sequence[str] | None = None) -> None:
    """Write a batch's sketches; the batch is read for them, and no other one."""
    write_batch(batch_sketches(df, columns), table, batch_id)


def merged(sketches: DataFrame) -> DataFrame:
    """One row per column with the sketches of all batches together, of the form that a batch has."""
    return sketches.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("non_null").alias("non_null"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.hll_union_agg("distinct_values").alias("distinct_values"),
        F.expr("CASE WHEN count(quantiles) > 0 THEN kll_merge_agg_double(quantiles) END AS quantiles"),
        F.expr(f"approx_top_k_combine(frequent, {_TRACKED}) AS frequent"),
    )


def estimated(sketches: DataFrame, top: int = 5) -> DataFrame:
    """Profiles of columns from their sketches: ``distinct_count``, ``quantiles`` and ``frequent`` ``(item, count)``."""
    ranks = ", ".join(f"{q}D" for q in QUANTILES)
    return sketches.select(
        "column_name",
        "rows",
        "non_null",
        F.coalesce(F.col("low").cast("string"), "first").alias("min_value"),
        F.coalesce(F.col("high").cast("string"), "last").alias("max_value"),
        F.hll_sketch_estimate("distinct_values").alias("distinct_count"),
        F.expr(
            f"CASE WHEN quantiles IS NOT NULL AND non_null > 0 THEN kll_sketch_get_quantile_double(quantiles, array({ranks})) END"
        ).alias("quantiles"),
        # Missing values are tracked like others; a value that may not be among the first ones is not told.
        F.expr(f"slice(filter(approx_top_k_estimate(frequent, {top + 1}), f -> f.item IS NOT NULL), 1, {top})").alias("frequent"),
    )


def table_profile(spark: SparkSession, table: str, top: int = 5) -> DataFrame:
    """Profile of a table from its batches' sketches; none of the table's own rows is read."""
    if not batch_folders(spark, table):
        raise ValueError(f"no sketches in {table}")
    return estimated(merged(spark.read.parquet(table)), top)
