"""Column expressions over raw bytes and text. Arguments are column names or SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_lossy(raw: str) -> Column:
    """UTF-8 text of a binary column, each malformed sequence replaced by U+FFFD."""
    return F.expr(f"make_valid_utf8(CAST({raw} AS string))")


def has_text(*values: str) -> Column:
    """True when every text holds more than white space; NULL counts as no text.

    White space is what Python's ``str.strip`` takes: Unicode space plus U+001C to U+001F.
    """
    tests = [rf"coalesce({v} RLIKE r'(?U)[^\s\x1c-\x1f]', false)" for v in values]
    return F.expr(" AND ".join(tests))
