"""Checks of profiles, dependency lists, required texts, sources and saved objects."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.constants import PACKAGE_NAME
from lake_ingest.functions.documents import with_document


def package_verdict(names: str) -> Column:
    """INVALID_PACKAGE, DUPLICATE_DEPENDENCY or OK for an array of package names.

    A NULL name is invalid. Names repeat regardless of case; ``a-b`` and ``a_b`` are two names.
    """
    return F.expr(_package_verdict(names))


def _package_verdict(names: str) -> str:
    return f"""CASE
        WHEN exists({names}, n -> NOT coalesce(n RLIKE r'{PACKAGE_NAME}', false)) THEN 'INVALID_PACKAGE'
        WHEN size(array_distinct(transform({names}, n -> lower(n)))) < size({names})
          THEN 'DUPLICATE_DEPENDENCY'
        ELSE 'OK' END"""


# An escaped half of a character beyond the basic plane that stands alone: no text can hold it.
_HALF_CHARACTER = (
    r"regexp_replace(regexp_replace({0}, r'\\\\', ''), "
    r"r'(?i)\\ud[89ab][0-9a-f]{{2}}\\ud[c-f][0-9a-f]{{2}}', '') RLIKE r'(?i)\\ud[89a-f][0-9a-f]{{2}}'"
)


def validate_profiles(df: DataFrame, profile: str, source_key: str) -> DataFrame:
    """Rows with ``verdict`` and, where it is OK, the ``dependencies`` (empty when none are given).

    Types count: a number is neither a source key nor a package name, and ``dependencies: null`` is
    not a list, while a missing ``dependencies`` is an empty one.
    """
    is_text = "schema_of_variant({0}) = 'STRING'".format
    text = "try_variant_get({0}, '$', 'string')".format
    parsed = with_document(df, profile, "_document")
    fields = parsed.withColumns(
        {
            "_key": F.expr("try_variant_get(_document, '$.source_key', 'variant')"),
            "_value": F.expr("try_variant_get(_document, '$.dependencies', 'variant')"),
        }
    ).withColumn("_list", F.expr("try_variant_get(_value, '$', 'array<variant>')"))
    # A name that is not a JSON string becomes NULL, which counts as invalid.
    names = f"""transform(coalesce(_list, CAST(array() AS array<variant>)),
                          v -> CASE WHEN {is_text('v')} THEN {text('v')} END)"""
    verdict = f"""CASE
        WHEN _document IS NULL THEN 'INVALID_JSON'
        WHEN {_HALF_CHARACTER.format(profile)} THEN 'INVALID_TEXT'
        WHEN try_variant_get(_document, '$', 'map<string,variant>') IS NULL THEN 'NOT_OBJECT'
        WHEN NOT coalesce({is_text('_key')} AND {text('_key')} = {source_key}, false)
          THEN 'SOURCE_KEY_MISMATCH'
        WHEN _value IS NOT NULL AND _list IS NULL THEN 'DEPENDENCIES_NOT_LIST'
        ELSE {_package_verdict('_names')} END"""
    return (
        fields.withColumn("_names", F.expr(names))
        .withColumn("verdict", F.expr(verdict))
        .withColumn("dependencies", F.expr("CASE WHEN verdict = 'OK' THEN _names END"))
        .drop("_document", "_key", "_value", "_list", "_names")
    )


def _has_loader_arguments(given: ast.arguments) -> bool:
    others = given.posonlyargs or given.vararg or given.kwonlyargs or given.kwarg
    return not others and [argument.arg for argument in given.args] == ["spark", "source_path"]


@F.pandas_udf(T.BooleanType())
def _is_loader(scripts: pd.Series) -> pd.Series:
    def accepted(script):
        try:
            body = ast.parse(script or "").body
        except (SyntaxError, ValueError, RecursionError, MemoryError):
            return False
        loaders = [node.args for node in body if isinstance(node, ast.FunctionDef) and node.name == "load_data"]
        # Annotations and defaults are free.
        return len(loaders) == 1 and _has_loader_arguments(loaders[0])

    return scripts.map(accepted)


def is_loader_script(script: str) -> Column:
    """True when a Python text parses and defines one top-level ``load_data(spark, source_path)``.

    The text is looked at, never run.
    """
    return _is_loader(F.col(script))


def check_dataset(df) -> DataFrame:
    """The DataFrame itself, if it is one and has a column. Runs nothing; no rows is fine."""
    if not isinstance(df, DataFrame):
        raise TypeError(f"a loader gives a DataFrame, not {type(df).__name__}")
    if not df.columns:
        raise ValueError("a loader's rows need a column at least")
    return df


def split_by_source(proposals: DataFrame, listing: DataFrame, key: str = "source_key"):
    """Proposals whose source is still listed, and those whose source is gone."""
    sources = listing.select(F.col("key").alias(key))
    return proposals.join(sources, key, "left_semi"), proposals.join(sources, key, "left_anti")


def missing_keys(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Expected keys that were not stored; empty after a complete save."""
    return expected.join(stored.select("key"), "key", "left_anti")
