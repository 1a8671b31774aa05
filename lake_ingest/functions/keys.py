"""Column expressions over object keys, fingerprints and times.

Arguments are column names or SQL expressions; longer expressions are one SQL text each, which costs a
single call to the JVM where composed Column objects would cost dozens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lake_ingest.constants import (
    ARTIFACT_FILES,
    RAW_PREFIX,
    SOURCE_COPY_KIND,
    SOURCE_COPY_TYPE,
)


def quoted(name: str) -> str:
    """SQL identifier of a column."""
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    """SQL literal of a text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name_sql(key: str) -> str:
    segment = rf"regexp_extract(regexp_replace({key}, r'(?:/\.?)+\z', ''), r'([^/]*)\z', 1)"
    return f"if({segment} = '.', '', {segment})"


def _folder_sql(key: str, ingestion_id: str, prefix: str) -> str:
    return f"concat({text_literal(prefix)}, {ingestion_id}, '-', {_name_sql(key)}, '/')"


def object_name(key: str) -> Column:
    """Last path segment of a key; ``''`` when the key names no file.

    Trailing slashes and ``.`` segments do not count, ``..`` is a name like any other.
    """
    return F.expr(_name_sql(key))


def raw_prefix(key: str, ingestion_id: str, prefix: str = RAW_PREFIX) -> Column:
    """Folder that holds one ingestion's source copy and artifacts."""
    return F.expr(_folder_sql(key, ingestion_id, prefix))


def raw_location(key: str, ingestion_id: str, prefix: str = RAW_PREFIX) -> Column:
    """Key of the source copy."""
    return F.expr(f"concat({_folder_sql(key, ingestion_id, prefix)}, {_name_sql(key)})")


def destination_keys(key: str, ingestion_id: str, prefix: str = RAW_PREFIX) -> Column:
    """Array of ``(kind, key, content_type)``: the source copy, then the six artifacts."""
    files = [(SOURCE_COPY_KIND, _name_sql(key), SOURCE_COPY_TYPE)]
    files += [(kind, text_literal(name), mime) for kind, name, mime in ARTIFACT_FILES]
    structs = [
        f"named_struct('kind', {text_literal(kind)}, "
        f"'key', concat({_folder_sql(key, ingestion_id, prefix)}, {name}), "
        f"'content_type', {text_literal(mime)})"
        for kind, name, mime in files
    ]
    return F.expr(f"array({', '.join(structs)})")


def artifact_map(key: str, ingestion_id: str, prefix: str = RAW_PREFIX) -> Column:
    """Map of artifact kind to key."""
    pairs = [
        f"{text_literal(kind)}, concat({_folder_sql(key, ingestion_id, prefix)}, {text_literal(name)})"
        for kind, name, _ in ARTIFACT_FILES
    ]
    return F.expr(f"map({', '.join(pairs)})")


def normalize_etag(etag: str) -> Column:
    """Fingerprint without its surrounding quotes; a missing one is ``''``."""
    return F.expr(f"""trim(BOTH '"' FROM coalesce({etag}, ''))""")


def utc_wall_clock(instant: str) -> Column:
    """UTC date and time (``timestamp_ntz``) of a ``timestamp``, whatever the session zone is."""
    seconds = f"CAST(CAST(unix_micros({instant}) AS decimal(20, 0)) / 1000000 AS decimal(18, 6))"
    return F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, {seconds})")


def iso_utc(wall_clock: str) -> Column:
    """ISO-8601 text with ``+00:00`` of a UTC ``timestamp_ntz``.

    Microseconds appear, all six digits, only when they are not zero. Built from the plain cast:
    ``date_format`` would go through the session zone and shift times inside its DST gaps.
    """
    text = f"translate(CAST({wall_clock} AS string), ' ', 'T')"
    return F.expr(f"concat(if(length({text}) > 19, rpad({text}, 26, '0'), {text}), '+00:00')")
