"""JSON documents in text columns: parsing, tool results, tool arguments.

``try_parse_json`` alone stops after the first value, so it accepts ``{} trailing``, and it refuses
repeated keys and NaN, which are common in generated documents. ``with_document`` settles both.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.constants import FAILURE_PREFIXES, SHORTEN_ABOVE, SHORTENED_VALUE
from lake_ingest.functions.keys import text_literal


@F.pandas_udf(T.StringType())
def _relaxed_json(texts: pd.Series) -> pd.Series:
    """Rewrite documents with repeated keys (the last wins) or NaN (as null); others give NULL."""

    def rewrite(text):
        try:
            return None if text is None else json.dumps(json.loads(text, parse_constant=lambda _: None))
        except (ValueError, RecursionError):
            return None

    return texts.map(rewrite)


def with_document(df: DataFrame, text: str, name: str) -> DataFrame:
    """Rows with the variant value of a JSON text, NULL when the text is not one JSON document.

    The text is parsed as the first element of an array whose second element is the text's own hash:
    anything left over either breaks the array or displaces that element. Only texts that fail this
    test and start like an object or array reach the Arrow helper. The steps are columns of their own,
    so that no text is parsed twice.
    """
    pair, strict = f"{name}__pair", f"{name}__strict"
    alone = f"try_variant_get({pair}, '$[1]', 'string') = md5({text})"
    doubtful = rf"CASE WHEN {strict} IS NULL AND {text} RLIKE r'\A[ \t\r\n]*[\[{{]' THEN {text} END"
    return (
        df.withColumn(
            pair, F.expr(f"""try_parse_json(concat('[', {text}, ',"', md5({text}), '"]'))""")
        )
        .withColumn(
            strict, F.expr(f"CASE WHEN {alone} THEN try_variant_get({pair}, '$[0]', 'variant') END")
        )
        .withColumn(
            name, F.coalesce(strict, F.try_parse_json(_relaxed_json(F.expr(doubtful))))
        )
        .drop(pair, strict)
    )


def with_tool_status(df: DataFrame, output: str, name: str = "status") -> DataFrame:
    """Rows with SUCCESS or FAILED for a tool's result.

    An object fails by ``ok`` or ``success`` being exactly false (0, "false" and null do not count), any
    other text by its first word; an object's text starts with ``{``, so the two tests never overlap.
    """
    candidate = f"{name}__object"
    parsed = with_document(
        df.withColumn(candidate, F.expr(rf"CASE WHEN {output} RLIKE r'\A[ \t\r\n]*\{{' THEN {output} END")),
        candidate,
        f"{name}__document",
    )
    failing = [
        f"to_json(try_variant_get({name}__document, '$.{field}', 'variant')) = 'false'"
        for field in ("ok", "success")
    ]
    # White space as Python strips it; only ASCII letters match in either case.
    words = "|".join(FAILURE_PREFIXES)
    failing.append(rf"{output} RLIKE r'\A(?U:[\s\x1c-\x1f]*)(?i:{words})'")
    failed = " OR ".join(f"coalesce({test}, false)" for test in failing)
    return parsed.withColumn(name, F.expr(f"if({failed}, 'FAILED', 'SUCCESS')")).drop(
        candidate, f"{name}__document"
    )


def spaced_json_length(compact: str) -> str:
    """SQL for the length of a compact JSON text when written with a space after every ``,`` and ``:``."""
    outside = rf"""regexp_replace(regexp_replace({compact}, r'\\.', ''), r'"[^"]*"', '')"""
    return f"(length({compact}) + length({outside}) - length(translate({outside}, ',:', '')))"


def with_short_arguments(
    df: DataFrame, arguments: str, name: str = "short_arguments", above: int = SHORTEN_ABOVE
) -> DataFrame:
    """Rows with a map of argument name to JSON text; long texts, lists and objects are replaced.

    NULL when the arguments are not a JSON object.
    """
    document = f"{name}__document"
    short = text_literal(json.dumps(SHORTENED_VALUE))
    entries = f"try_variant_get({document}, '$', 'map<string,variant>')"
    texts = f"transform_values({entries}, (k, v) -> to_json(v))"
    # Spacing at most doubles a text, so short ones need no closer look.
    long = f"""2 * length(v) > {above} AND substring(v, 1, 1) IN ('"', '[', '{{')
        AND {spaced_json_length('v')} > {above}"""
    shortened = f"transform_values({texts}, (k, v) -> if({long}, {short}, v))"
    return (
        with_document(df, arguments, document).withColumn(name, F.expr(shortened)).drop(document)
    )
