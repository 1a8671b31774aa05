"""Column profiles, findings, dictionaries and expectations, each in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.functions.keys import quoted, text_literal

# Types a text is tested for, in this order, with the form the text must show besides converting, so
# that '1.5' is no integer and '20240101' no date. A wall-clock text must not fail in a DST gap of the
# session zone, hence the zone-less timestamp.
_KINDS = (
    ("bigint", "bigint", r"\A\s*[+-]?[0-9]+\s*\z"),
    ("double", "double", r"\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"),
    ("boolean", "boolean", r"(?i)\A\s*(true|false)\s*\z"),
    ("date", "date", r"\A\s*[0-9]{4}-[0-9]{2}-[0-9]{2}\s*\z"),
    (
        "timestamp",
        "timestamp_ntz",
        r"\A\s*[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?\s*\z",
    ),
)

_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)

# The expressions below are generated per column. They are SQL texts because a wide table needs
# thousands of them, and each Column object costs calls to the JVM.


def _kind(text: str) -> str:
    """Position in ``_KINDS`` of the first type the text reads as, else NULL."""
    tests = [
        f"WHEN {text} RLIKE r'{form}' AND try_cast({text} AS {target}) IS NOT NULL THEN {i}"
        for i, (_, target, form) in enumerate(_KINDS)
    ]
    # Most plain texts are settled by their first character.
    plain = f"WHEN NOT {text} RLIKE r'\\A\\s*[-+.0-9tTfF]' THEN NULL"
    return f"CASE {plain} {' '.join(tests)} END"


def _is_ordered(field: T.StructField) -> bool:
    return isinstance(field.dataType, _ORDERED)


def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def _value(field: T.StructField) -> str:
    # Adding zero makes -0.0 the value it equals.
    plus = " + 0" if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else ""
    return quoted(field.name) + plus


def _struct(**members: str) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in members.items()) + ")"


def _inline(structs: Sequence[str]) -> Column:
    return F.expr(f"inline(array({', '.join(structs)}))")


def _sketched(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Figures per column from one aggregation, distinct values estimated by a mergeable sketch."""
    inputs, aggregates, rows = [], ["count(*) AS rows"], []
    for i, field in enumerate(fields):
        inputs.append(f"{_value(field)} AS v{i}")
        aggregates.append(f"count(v{i}) AS non_null{i}")
        row = {"position": str(i), "rows": "rows", "non_null": f"non_null{i}"}
        if _is_ordered(field):
            aggregates += [
                f"approx_count_distinct(v{i}, 0.02) AS distinct{i}",
                f"CAST(min(v{i}) AS string) AS min{i}",
                f"CAST(max(v{i}) AS string) AS max{i}",
            ]
            row |= {"distinct_count": f"distinct{i}", "min_value": f"min{i}", "max_value": f"max{i}"}
        else:
            row |= {"distinct_count": "CAST(NULL AS bigint)"}
            row |= {bound: "CAST(NULL AS string)" for bound in ("min_value", "max_value")}
        if _is_text(field):
            inputs.append(f"{_kind(quoted(field.name))} AS kind{i}")
            aggregates += [f"count_if(kind{i} = {k}) AS {n}{i}" for k, (n, _, _) in enumerate(_KINDS)]
        row |= {n: f"{n}{i}" if _is_text(field) else "0L" for n, _, _ in _KINDS}
        rows.append(_struct(**row))
    return df.selectExpr(*inputs).agg(*map(F.expr, aggregates)).select(_inline(rows))


def _exact(df: DataFrame, fields: Sequence[T.StructField]) -> DataFrame:
    """Figures per column from its distinct values.

    Equal values are merged in each task before the shuffle, so a value that fills a third of the rows
    costs one row per task, and texts are tested for their type once per distinct value. Built-in
    ``count_distinct`` of several columns would carry all aggregates through each copy of a row.
    """
    cells = [
        _struct(
            position=str(i),
            value=f"CAST({_value(f)} AS string)" if _is_ordered(f) else "CAST(NULL AS string)",
            present=f"{quoted(f.name)} IS NOT NULL",
        )
        for i, f in enumerate(fields)
    ]
    values = (
        df.select(_inline(cells)).groupBy("position", "value", "present").agg(F.expr("count(*) AS n"))
    )
    texts = [str(i) for i, f in enumerate(fields) if _is_text(f)]
    kind = f"CASE WHEN position IN ({', '.join(texts)}) THEN {_kind('value')} END"
    figures = (
        values.withColumn("kind", F.expr(kind) if texts else F.lit(None).cast("int"))
        .groupBy("position")
        .agg(
            F.expr("sum(n) AS rows"),
            F.expr("sum(if(present, n, 0L)) AS non_null"),
            F.expr("count(value) AS distinct_count"),
            F.expr("min(value) AS min_value"),
            F.expr("max(value) AS max_value"),
            *[F.expr(f"sum(if(kind = {k}, n, 0L)) AS {n}") for k, (n, _, _) in enumerate(_KINDS)],
        )
    )
    # Those are the least and greatest in text order; other types have their own.
    typed = [(i, f) for i, f in enumerate(fields) if _is_ordered(f) and not _is_text(f)]
    if not typed:
        return figures
    bounds = [
        f"CAST({bound}({_value(f)}) AS string) AS {bound}{i}" for i, f in typed for bound in ("min", "max")
    ]
    ranges = df.agg(*map(F.expr, bounds)).select(
        _inline([_struct(position=str(i), low=f"min{i}", high=f"max{i}") for i, _ in typed])
    )
    is_text = F.col("position").isin([int(i) for i in texts])
    return (
        figures.join(ranges, "position", "left")
        .withColumn("min_value", F.when(is_text, F.col("min_value")).otherwise(F.col("low")))
        .withColumn("max_value", F.when(is_text, F.col("max_value")).otherwise(F.col("high")))
        .drop("low", "high")
    )


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False
) -> DataFrame:
    """One row per column: counts, range, distinct values and the type its texts would convert to.

    The default estimates distinct values in a single scan, with one small row per task to shuffle.
    ``exact_distinct`` shuffles the distinct values of every column.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    described = [
        _struct(
            position=str(i),
            column_name=text_literal(f.name),
            data_type=text_literal(f.dataType.simpleString()),
            ordered=str(_is_ordered(f)),
            text=str(_is_text(f)),
            numeric=str(isinstance(f.dataType, T.NumericType)),
        )
        for i, f in enumerate(fields)
    ]
    figures = _exact(df, fields) if exact_distinct else _sketched(df, fields)
    counts = ["rows", "non_null", "distinct_count", *[name for name, _, _ in _KINDS]]
    return (
        df.sparkSession.range(1)
        .select(_inline(described))
        .join(figures, "position", "left")
        .na.fill(0, counts)
        .selectExpr(
            "column_name",
            "data_type",
            "rows",
            "non_null",
            "CASE WHEN rows > 0 THEN 1 - non_null / rows END AS null_ratio",
            "CASE WHEN ordered THEN distinct_count END AS distinct_count",
            "min_value",
            "max_value",
            "CASE WHEN text THEN bigint + double WHEN numeric THEN non_null ELSE 0L END AS numeric_count",
            """CASE WHEN NOT text THEN data_type
                    WHEN non_null = 0 THEN 'string'
                    WHEN bigint = non_null THEN 'bigint'
                    WHEN bigint + double = non_null THEN 'double'
                    WHEN boolean = non_null THEN 'boolean'
                    WHEN date = non_null THEN 'date'
                    WHEN date + timestamp = non_null THEN 'timestamp'
                    ELSE 'string' END AS inferred_type""",
        )
    )


def profile_findings(profile: DataFrame) -> DataFrame:
    """Rows ``(column_name, finding, detail)`` for what a profile leaves open or shows as a limitation."""
    non_null, text = F.col("non_null"), F.col("data_type") == "string"
    missing = F.col("rows") - non_null
    not_numeric = non_null - F.col("numeric_count")
    rules = [
        ("all_null", (non_null == 0) & (F.col("rows") > 0), F.lit("no value present")),
        ("constant", F.col("distinct_count") == 1, F.concat(F.lit("always "), "min_value")),
        (
            "mixed_types",
            text & (F.col("numeric_count") > 0) & (not_numeric > 0),
            F.concat("numeric_count", F.lit(" numeric, "), not_numeric, F.lit(" other")),
        ),
        (
            "missing_values",
            (missing > 0) & (non_null > 0),
            F.concat(missing, F.lit(" of "), "rows", F.lit(" missing")),
        ),
        (
            "stored_as_text",
            text & (F.col("inferred_type") != "string"),
            F.concat(F.lit("every value reads as "), "inferred_type"),
        ),
    ]
    found = F.array_compact(
        F.array(
            *[
                F.when(test, F.struct(F.lit(name).alias("finding"), detail.alias("detail")))
                for name, test, detail in rules
            ]
        )
    )
    return profile.select("column_name", F.inline(found))


def column_dictionary(df: DataFrame, profile: DataFrame, descriptions: DataFrame) -> DataFrame:
    """One row per column: position, type, profile figures and the supplied description.

    ``descriptions`` is ``(column_name, description)``. A column without one is listed as not
    described; no text is made up. The schema is metadata, so its rows are literals.
    """
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.lit(f.nullable).alias("nullable"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    columns = df.sparkSession.range(1).select(F.inline(fields))
    figures = profile.select("column_name", "non_null", "distinct_count", "min_value", "max_value")
    return (
        columns.join(figures, "column_name", "left")
        .join(descriptions.select("column_name", "description"), "column_name", "left")
        .withColumn("described", F.col("description").isNotNull())
    )


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Column comments as metadata, which the table writers store."""
    return df.select(
        *[
            F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, "comment": comments[f.name]})
            if f.name in comments
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


@dataclass(frozen=True)
class Expectation:
    """A named condition every row should meet; NULL (unknown) is no violation, as in SQL CHECK."""

    name: str
    condition: Column | str


def check_expectations(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule with the number of violating rows, all rules in one scan."""
    conditions = [F.expr(r.condition) if isinstance(r.condition, str) else r.condition for r in rules]
    totals = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(~c).alias(f"_failed_{i}") for i, c in enumerate(conditions)],
    )
    result = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.col("rows"),
                F.col(f"_failed_{i}").alias("failed"),
                (F.col(f"_failed_{i}") == 0).alias("passed"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return totals.select(F.inline(result))
