"""Loading a source file or folder by format, or by a registered loader.

A loader is a callable ``load_data(spark, source_path) -> DataFrame``. It reads and converts; it does
not build a session, write, or touch the catalog.
"""

from __future__ import annotations

import csv
import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.functions.keys import quoted
from lake_ingest.sources.csv_lines import QUOTE, first_lines, plain_lines, quoted_records

Loader = Callable[[SparkSession, str], DataFrame]

CORRUPT_RECORD = "_corrupt_record"

_LOADERS: dict[str, Loader] = {}

# File name ending -> name of the loader that reads it.
EXTENSIONS = {
    ".json": "json",
    ".jsonl": "jsonl",
    ".ndjson": "jsonl",
    ".csv": "csv",
    ".txt": "text",
    ".parquet": "parquet",
    ".orc": "orc",
}


def register_loader(name: str, loader: Loader) -> Loader:
    """Make a loader available by name, after checking its interface."""
    if not callable(loader):
        raise TypeError(f"loader {name!r} is not callable")
    parameters = inspect.signature(loader).parameters.values()
    plain = all(p.kind is inspect.Parameter.POSITIONAL_OR_KEYWORD for p in parameters)
    if not plain or [p.name for p in parameters] != ["spark", "source_path"]:
        raise ValueError("a loader must have exactly this interface: load_data(spark, source_path)")
    _LOADERS[name] = loader
    return loader


def get_loader(name: str) -> Loader:
    if name not in _LOADERS:
        raise KeyError(f"no loader named {name!r}; known: {', '.join(sorted(_LOADERS))}")
    return _LOADERS[name]


def format_loader(fmt: str, schema: T.StructType | str | None = None, **options) -> Loader:
    """Loader for one of Spark's file formats.

    With a schema no inference pass runs, and for JSON and CSV the text of a record that does not
    fit is kept in ``_corrupt_record``.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if schema is not None and fmt in ("json", "csv") and CORRUPT_RECORD not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])

    def load_data(spark, source_path):
        reader = spark.read.format(fmt).options(**options)
        return (reader if schema is None else reader.schema(schema)).load(source_path)

    return load_data


def load_csv(spark: SparkSession, source_path: str) -> DataFrame:
    """CSV with a header, all columns texts; a malformed record is an error (see ``csv_records``)."""
    return _sound(csv_records(spark, source_path))


def load_csv_multiline(spark: SparkSession, source_path: str) -> DataFrame:
    """As ``load_csv``, for files whose values may hold line breaks and doubled quotes."""
    return _sound(csv_records(spark, source_path, multiline=True, escape=QUOTE))


def _sound(records: DataFrame) -> DataFrame:
    """The records, an error if one is malformed.

    The test is no function of the row alone, or it would be moved to where records are not yet told from
    those that a quote opened earlier rules out.
    """
    message = F.concat(F.lit("malformed CSV record: "), F.col(CORRUPT_RECORD))
    sound = F.when(F.col(CORRUPT_RECORD).isNull() | (F.spark_partition_id() < 0), True).otherwise(F.raise_error(message).cast("boolean"))
    return records.where(sound).drop(CORRUPT_RECORD)


def csv_records(
    spark: SparkSession, source_path: str, multiline: bool = False, escape: str = "\\", file_name: str | None = None
) -> DataFrame:
    """CSV with a header, all columns texts, and the text of a malformed record in ``_corrupt_record``.

    Malformed is a record with more or fewer fields than the header, or with a quote that does not end. The
    first line of each file is its header; that of the first path counts, and a file with other names is set
    aside record by record, its header included. Columns get their types by ``conform.convert_types``, without
    a pass to infer them.

    Files are split between tasks. Without ``multiline`` a record is a line, and a value with a line break is
    set aside rather than cut in two; the lines are read once. With it a quoted value may hold line breaks,
    which come back as line feeds; the lines are read twice, once to find out where quotes are open. The
    headers are read from the files' first bytes. ``file_name`` names a column for the name of a record's file.
    """
    headers = first_lines(spark, source_path)
    told = headers.agg(
        F.min(F.struct("name", "line")).alias("first"), F.count_distinct("line").alias("n"), F.sum("size").alias("size")
    ).first()
    if not told["n"]:
        return spark.createDataFrame([], f"{CORRUPT_RECORD} string")
    header = told["first"]["line"]
    names = next(csv.reader([header]))
    fields = [T.StructField(name or f"_c{i}", T.StringType()) for i, name in enumerate(names)]
    schema = T.StructType([*fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT_RECORD, "mode": "PERMISSIVE", "escape": escape}

    def record(text: Column | str) -> Column:
        return F.from_csv(text, _ddl(schema), options | {"multiLine": str(multiline).lower()})

    if multiline:
        lines = quoted_records(spark, source_path, told["size"], escape).withColumn("_odd", ~F.col("whole"))
    else:
        quotes = "length(value) - length(replace(value, '\"', ''))"
        lines = plain_lines(spark, source_path, told["size"]).withColumn("_odd", F.expr(f"({quotes}) % 2 = 1"))
    if told["n"] == 1:
        rows = lines.where("NOT first").withColumn("_same", F.lit(True))
    else:
        same = F.col(f"_header.{CORRUPT_RECORD}").isNull()
        for field, name in zip(fields, names):
            same &= F.coalesce(F.col(f"_header.{quoted(field.name)}"), F.lit("")) == name
        agree = headers.withColumn("_header", record("line")).select(
            "path", (same | (F.col("line") == header)).alias("_same")
        )
        rows = lines.join(agree, "path").where("NOT (first AND _same)")
    of_file = []
    if file_name is not None:
        named = headers.select("path", F.element_at(F.split("name", "/"), -1).alias("_name"))
        rows, of_file = rows.join(named, "path"), [F.col("_name").alias(file_name)]
    parsed = rows.select("value", "_odd", "_same", *of_file, record("value").alias("_record")).withColumn(
        "_bad", F.expr(f"NOT _same OR _record.{CORRUPT_RECORD} IS NOT NULL OR _odd")
    )
    kept = [
        F.when(~F.col("_bad"), F.col(f"_record.{quoted(f.name)}")).alias(f.name) for f in fields
    ]
    kept += [F.col(file_name)] if file_name is not None else []
    return parsed.select(*kept, F.when(F.col("_bad"), F.col("value")).alias(CORRUPT_RECORD))


def load_files(
    spark: SparkSession, folder: str, loader: str, schema: T.StructType, file_name: str
) -> DataFrame | None:
    """All files of a folder, which look alike, by one of the built-in loaders; a column says which file a row is of.

    None for other loaders, which read one source at a time.
    """
    known = _LOADERS.get(loader)
    if known in (load_csv, load_csv_multiline):
        multiline = {"multiline": True, "escape": QUOTE} if known is load_csv_multiline else {}
        return csv_records(spark, folder, file_name=file_name, **multiline)
    if known is _JSON[1]:
        record = T.StructType([*as_texts(schema), T.StructField(CORRUPT_RECORD, T.StringType())])
        read = spark.read.schema(record).json(folder)
    elif known in _FILES:
        read = spark.read.format(_FILES[known]).load(folder)
    else:
        return None
    return read.select("*", F.col("_metadata.file_name").alias(file_name))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)


def as_texts(schema: T.StructType) -> T.StructType:
    """The schema with plain values as texts, so that one that does not convert is set aside, not lost."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.AtomicType) else f.dataType)
            for f in schema
        ]
    )


def load_source(
    spark: SparkSession,
    source_path: str,
    loader: str | None = None,
    schema: T.StructType | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Load by named loader, else by the ending of the path.

    A declared ``schema`` goes to the JSON reader, as texts and with ``_corrupt_record``: then no pass
    infers one, and no value is lost. With ``keep_corrupt`` CSV has that column too, in place of an
    error.
    """
    if loader is None:
        path = source_path.rstrip("/").lower()
        matches = [name for ending, name in EXTENSIONS.items() if path.endswith(ending)]
        if not matches:
            raise ValueError(f"no loader for {source_path}")
        loader = matches[0]
    if schema is not None and _LOADERS.get(loader) in _JSON:
        options = {"multiLine": True} if _LOADERS[loader] is _JSON[0] else {}
        return format_loader("json", as_texts(schema), **options)(spark, source_path)
    if keep_corrupt and _LOADERS.get(loader) is load_csv:
        return csv_records(spark, source_path)
    if keep_corrupt and _LOADERS.get(loader) is load_csv_multiline:
        return csv_records(spark, source_path, multiline=True, escape=QUOTE)
    return get_loader(loader)(spark, source_path)


# A whole-file JSON document may be indented; JSON Lines files are split between tasks.
_JSON = (
    register_loader("json", format_loader("json", multiLine=True)),
    register_loader("jsonl", format_loader("json")),
)
register_loader("csv", load_csv)
register_loader("csv_multiline", load_csv_multiline)
_FILES = {register_loader(name, format_loader(name)): name for name in ("text", "parquet", "orc")}
