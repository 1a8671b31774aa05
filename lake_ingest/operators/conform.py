"""Type conversion, missing values and quarantine of what does not parse."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.functions.keys import quoted, text_literal
from lake_ingest.sources.loaders import CORRUPT_RECORD

# Own choice: texts that mean "no value" when a loader names no others.
NULL_TOKENS = ("", "na", "n/a", "nan", "null", "none", "-")

REJECTED = "rejected_columns"


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


# What a text must look like for Spark's cast to have a chance. The cast is the judge; the forms only
# keep it from building an exception for each plainly unfit value, which takes some 30 times as long as
# a conversion.
_BLANKS = r"[\x00-\x20\x7f]*"
_INTEGER = rf"\A{_BLANKS}[+-]?[0-9]+{_BLANKS}\z"
_DECIMAL = rf"\A{_BLANKS}[+-]?\.?\p{{Nd}}"
_FLOAT = rf"(?i)\A{_BLANKS}[+-]?(\.?[0-9]|inf|nan)"
_BOOLEAN = rf"(?i)\A{_BLANKS}(t|true|f|false|y|yes|n|no|1|0){_BLANKS}\z"
_FORMS = (
    (T.IntegralType, _INTEGER),
    (T.DecimalType, _DECIMAL),
    ((T.FloatType, T.DoubleType), _FLOAT),
    (T.BooleanType, _BOOLEAN),
)


def _resolved(df: DataFrame, fields: Sequence[T.StructField]) -> dict[str, tuple[str, T.DataType]]:
    """Per declared field the SQL and type of the column that holds it, found as Spark finds names.

    A column that is not there counts as NULL where the field may be; a field that may not is an error.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = str if exact else str.lower
    there = {fold(f.name): f for f in reversed(df.schema.fields)}
    found = {}
    for field in fields:
        column = there.get(fold(field.name))
        if column is None and not field.nullable:
            raise ValueError(f"required column is missing: {field.name}")
        found[field.name] = ("NULL", field.dataType) if column is None else (quoted(column.name), column.dataType)
    return found


def _conversion(column: str, source: T.DataType, target: T.DataType) -> str:
    """SQL that converts a column, giving NULL where that fails."""
    if source == target:
        return column
    cast = f"try_cast({column} AS {target.simpleString()})"
    forms = [form for kinds, form in _FORMS if isinstance(target, kinds)]
    if isinstance(source, T.StringType) and forms:
        return f"CASE WHEN {column} RLIKE r'{forms[0]}' THEN {cast} END"
    return cast


def convert_types(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Exactly the columns of ``schema``; a value that does not convert becomes NULL."""
    fields = _struct(schema).fields
    columns = _resolved(df, fields)
    return df.select(*[_converted(columns[f.name], f).alias(f.name, metadata=f.metadata) for f in fields])


def _converted(column: tuple[str, T.DataType], field: T.StructField) -> Column:
    sql, kind = column
    absent = f"CAST(NULL AS {field.dataType.simpleString()})"
    return F.expr(absent if sql == "NULL" else _conversion(sql, kind, field.dataType))


def _literal(text: str) -> str:
    """Java regular expression of a text."""
    return re.sub(r"([^\w ])", r"\\\1", text)


def missing_values(
    df: DataFrame,
    tokens: Sequence[str] = NULL_TOKENS,
    defaults: Mapping[str, object] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Null tokens in text columns and NaN in floating ones become NULL, then defaults apply.

    Tokens match the text in any case without the white space around it, that of ``has_text``; texts
    that are kept are not altered. ``columns`` and ``defaults`` name columns in any case unless Spark
    tells cases apart.
    """
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    fold = str if exact else str.lower
    tokens = [t.lower() for t in tokens]
    blanks = r"[\s\x1c-\x1f]*"
    absent = rf"(?iuU)\A{blanks}(?:{'|'.join(map(_literal, tokens)) or '(?!)'}){blanks}\z"
    wanted = None if columns is None else {fold(c) for c in columns}
    defaults = {fold(name): value for name, value in (defaults or {}).items()}
    cleaned = {}
    for field in df.schema:
        if wanted is not None and fold(field.name) not in wanted:
            continue
        value = F.col(quoted(field.name))
        if isinstance(field.dataType, T.StringType):
            value = F.when(~F.rlike(value, F.lit(absent)), value)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            value = F.when(~F.isnan(value), value)
        if fold(field.name) in defaults:
            value = F.coalesce(value, F.lit(defaults[fold(field.name)]).cast(field.dataType))
        cleaned[field.name] = value
    return df.select(
        *[cleaned.get(c, F.col(quoted(c))).alias(c, metadata=df.schema[c].metadata) for c in df.columns]
    )


class Conformed:
    """Rows with their converted values beside them, and the names of the columns that failed.

    Each value is converted once, for the test and for the result alike.
    """

    def __init__(self, df: DataFrame, schema: T.StructType | str):
        self.columns, self.fields = df.columns, _struct(schema).fields
        held = _resolved(df, self.fields)
        converted = {self._hidden(f): _converted(held[f.name], f) for f in self.fields}
        failed = [
            f"CASE WHEN {held[f.name][0]} IS NOT NULL AND {quoted(self._hidden(f))} IS NULL "
            f"THEN {text_literal(f.name)} END"
            for f in self.fields
        ]
        if CORRUPT_RECORD in df.columns:
            failed.append(f"CASE WHEN {CORRUPT_RECORD} IS NOT NULL THEN '{CORRUPT_RECORD}' END")
        rejected = F.expr(f"array_compact(array({', '.join(failed)}))")
        self.rows = df.select("*", *[c.alias(n) for n, c in converted.items()]).withColumn(REJECTED, rejected)

    @staticmethod
    def _hidden(field: T.StructField) -> str:
        return f"_converted_{field.name}"

    def converted(self) -> list[Column]:
        """The converted values by the names of the schema."""
        return [F.col(quoted(self._hidden(f))).alias(f.name, metadata=f.metadata) for f in self.fields]

    def observe(self, observation: Observation) -> Conformed:
        """The same rows, counted as they pass: ``rows`` and, among them, ``rejected``."""
        self.rows = self.rows.observe(
            observation,
            F.expr("count(*) AS rows"),
            F.expr(f"count_if(size({REJECTED}) > 0) AS rejected"),
        )
        return self

    def good(self) -> DataFrame:
        """Converted rows without a failure, in the columns of the schema."""
        return self.rows.where(f"size({REJECTED}) = 0").select(
            *self.converted()
        )

    def flagged(self) -> DataFrame:
        """All rows as they came, with ``rejected_columns``."""
        return self.rows.select(*map(quoted, self.columns), REJECTED)

    def rejected(self) -> DataFrame:
        """Rows with a failure, as they came, with ``rejected_columns``."""
        return self.flagged().where(f"size({REJECTED}) > 0")


def flag_rejects(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """All rows with ``rejected_columns``, the names of columns whose value does not convert.

    A record the reader could not parse at all counts by its ``_corrupt_record`` column.
    """
    return Conformed(df, schema).flagged()


def quarantine(df: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """Converted good rows, and the rejected rows unconverted with ``rejected_columns``."""
    conformed = Conformed(df, schema)
    return conformed.good(), conformed.rejected()
