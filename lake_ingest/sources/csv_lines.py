"""CSV files cut into records, split between tasks.

Spark's text reader deals the lines of large files out over tasks. A small helper passes over each split's
lines in order. Line by line it only tells a file's first line, its header, from the others, for lines have no
position in Spark. With values that may hold line breaks, what a line means depends on whether a quote is
open before it, and so on all lines of the file before the split. Each line is therefore a function from
"open before" to "open after", and so is a split: it is read for both cases until both are out of quotes at
one line's end, from where on they agree. The functions of a file's splits, composed in their order, tell
which case holds; what was cut for the other one is dropped, and the pieces of a record that reaches over
the ends of splits are put together. No more than these pieces is shuffled.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lake_ingest.session import shared_dir
from lake_ingest.sources.store import open_store, store_options

QUOTE = '"'
# A record in more bytes than this is set aside in the pieces it was cut in.
MAX_RECORD = 256 * 1024 * 1024
# Bytes of lines for one task, which takes several splits where they are smaller.
TASK_BYTES = 32 * 1024 * 1024
_ROWS = 8192
_BOM = "﻿"


def first_lines(spark: SparkSession, source_path: str) -> DataFrame:
    """``(path, name, line, size)``: the first line with text in it of each file, ``path`` as a number for joins.

    Tasks read the files' first bytes only; Spark lists the files.
    """

    options = store_options(spark)

    def read(batches):
        for batch in batches:
            for path, name, size in zip(*(batch[n].to_pylist() for n in ("path", "name", "size"))):
                store, place = open_store(name, options)
                with store.open_input_stream(place, compression="detect") as file:
                    line = _first_line(file)
                if line is not None:
                    yield pa.RecordBatch.from_pylist([{"path": path, "name": name, "line": line, "size": size}], schema)

    schema = pa.schema([("path", pa.int64()), ("name", pa.string()), ("line", pa.string()), ("size", pa.int64())])
    files = spark.read.format("binaryFile").load(source_path)
    named = files.select(
        F.xxhash64("_metadata.file_path").alias("path"), F.col("path").alias("name"), F.col("length").alias("size")
    )
    return named.mapInArrow(read, "path bigint, name string, line string, size bigint")


def _first_line(file) -> str | None:
    held = b""
    while piece := file.read(1 << 16):
        held = (held + piece).lstrip(b"\r\n")
        found = re.match(rb"[^\r\n]*[\r\n]", held)
        if found:
            return found[0][:-1].decode("utf-8", "replace").removeprefix(_BOM)
    return held.decode("utf-8", "replace").removeprefix(_BOM) or None


def _split_lines(spark: SparkSession, source_path: str, size: int) -> DataFrame:
    """``(value, path, start)`` of all lines; those of a split are together and in order.

    The number of tasks goes by the ``size`` of all files in bytes. That of the splits is the session's to choose,
    and a task for each would cost more to start than a small split takes to read.
    """
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    lines = spark.read.text(source_path).select(
        "value", F.xxhash64("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start")
    )
    return lines.coalesce(max(least, ceil(size / TASK_BYTES)))


def plain_lines(spark: SparkSession, source_path: str, size: int) -> DataFrame:
    """``(value, path, first)`` of all lines with text, ``first`` for the first one of each file."""

    def mark(batches):
        before, waits = None, False
        for batch in batches:
            kept = batch.filter(pc.greater(pc.binary_length(batch["value"]), 0))
            path, start = kept["path"], kept["start"]
            if not len(kept):
                # A split's lines without text say nothing, but they may begin the file.
                continue
            change = [0]
            if len(kept) > 1:
                moved = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1]))
                change += [i + 1 for i in pc.indices_nonzero(moved).to_pylist()]
            first = [False] * len(kept)
            for i in change:
                here = (path[i].as_py(), start[i].as_py())
                if here != before:
                    before, waits = here, here[1] == 0
                if waits:
                    first[i], waits = True, False
            yield pa.RecordBatch.from_arrays(
                [kept["value"], path, pa.array(first, pa.bool_())], names=["value", "path", "first"]
            )

    return _split_lines(spark, source_path, size).mapInArrow(mark, "value string, path bigint, first boolean")


class Lines:
    """Whether a quoted field is open after a line, given whether one is before."""

    def __init__(self, escape: str):
        body = r'(?:[^"]|"")*+' if escape == QUOTE else rf'(?:[^"{re.escape(escape)}]|{re.escape(escape)}(?:.|\Z))*+'
        field = rf'(?:"{body}"[^,]*+|[^",][^,]*+|)'
        self.closed = re.compile(rf"{field}(?:,{field})*+", re.S).fullmatch
        self.closes = re.compile(rf'{body}"[^,]*+(?:,{field})*+', re.S).fullmatch

    def open_after(self, line: str, open_before: bool) -> bool:
        if QUOTE not in line:
            return open_before
        return not (self.closes(line) if open_before else self.closed(line))


class Case:
    """The records of a split's lines, if a quote is open before them or not."""

    def __init__(self, opened: bool):
        self.opened = opened
        # The lines of the record in work; in the open case the first one is the end of an earlier record.
        self.lines: list[str] = []
        self.kind = "head" if opened else "record"


# What a row is: a whole record; a piece that ends one, is inside one, or begins one; or what a split does.
RECORD, HEAD, INSIDE, TAIL, STATE = 0, 1, 2, 3, 4
PIECES = "path bigint, start bigint, at bigint, kind int, opened boolean, value string, first boolean, closed_to boolean, open_to boolean"


def split_pieces(lines: Iterator[tuple[str, int, int]], rules: Lines) -> Iterator[dict]:
    """Rows of ``PIECES`` of all splits; ``opened`` is the case a row is for, none where it is for both."""
    split, cases, agreed, waits, at = None, [], False, False, 0

    def row(kind: int, value: str | None = None, opened: bool | None = None, **more) -> dict:
        nonlocal waits, at
        first = waits and kind in (RECORD, TAIL)
        waits = waits and not first
        at += 1
        return {"path": split[0], "start": split[1], "at": at, "kind": kind, "opened": opened, "value": value, "first": first} | more

    def finish() -> Iterator[dict]:
        ends = [bool(case.lines) if case.kind == "record" else True for case in cases]
        for case in cases:
            if case.lines:
                kind = TAIL if case.kind == "record" else INSIDE
                yield row(kind, "\n".join(case.lines), None if agreed else case.opened)
        closed_to, open_to = (ends[0], ends[0]) if agreed or len(ends) == 1 else ends
        yield row(STATE, closed_to=closed_to, open_to=open_to)

    for value, path, start in lines:
        if split != (path, start):
            if split is not None:
                yield from finish()
            split, agreed, waits, at = (path, start), start == 0, start == 0, 0
            cases = [Case(False)] if agreed else [Case(False), Case(True)]
        for case in cases:
            inside = bool(case.lines) or case.kind == "head"
            if not inside and not value:
                continue
            case.lines.append(value)
            if not rules.open_after(value, inside):
                yield row(HEAD if case.kind == "head" else RECORD, "\n".join(case.lines), None if agreed else case.opened)
                case.lines, case.kind = [], "record"
        if not agreed and all(case.kind == "record" and not case.lines for case in cases):
            # Out of quotes in both cases: from here on they are one.
            cases, agreed = cases[:1], True
    if split is not None:
        yield from finish()


def quoted_records(spark: SparkSession, source_path: str, size: int, escape: str) -> DataFrame:
    """``(value, path, first, whole)`` of all records, which may hold line breaks in quotes.

    A record whose quote is never closed, and one longer than ``MAX_RECORD``, are not ``whole``; the latter
    comes in pieces.
    """

    def cut(batches):
        rules = Lines(escape)

        def lines():
            for batch in batches:
                yield from zip(*(batch[n].to_pylist() for n in ("value", "path", "start")))

        held = []
        for piece in split_pieces(lines(), rules):
            held.append(piece)
            if len(held) == _ROWS:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    schema = pa.schema(
        [("path", pa.int64()), ("start", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("opened", pa.bool_()),
         ("value", pa.string()), ("first", pa.bool_()), ("closed_to", pa.bool_()), ("open_to", pa.bool_())]
    )
    rows = _split_lines(spark, source_path, size).mapInArrow(cut, PIECES)
    sure = rows.where(f"kind = {RECORD} AND opened IS NULL").select("value", "path", "first", F.lit(True).alias("whole"))
    # What is not sure is little; it is written once, so that the files are read twice in all.
    place = f"{shared_dir(spark)}/csv-pieces-{uuid.uuid4().hex}"
    rows.where(f"kind <> {RECORD} OR opened IS NOT NULL").write.parquet(place)
    rest = spark.read.schema(PIECES).parquet(place)
    # A split that ends alike in both cases sets the state, one that does not keeps or turns it.
    file = Window.partitionBy("path").orderBy("start")
    states = (
        rest.where(f"kind = {STATE}")
        .withColumn("_turns", F.sum(F.expr("int(closed_to AND NOT open_to)")).over(file))
        .withColumn("_set", F.expr("if(closed_to = open_to, struct(closed_to AS open, _turns AS turns), NULL)"))
        .withColumn("_set", F.last("_set", ignorenulls=True).over(file))
        .withColumn("_open", F.expr("_set.open <> ((_turns - _set.turns) % 2 = 1)"))
        .select("path", "start", F.coalesce(F.lag("_open").over(file), F.lit(False)).alias("_open"))
    )
    true = (
        rest.where(f"kind <> {STATE}")
        .join(states, ["path", "start"])
        .where("opened IS NULL OR opened = _open")
    )
    cut_whole = true.where(f"kind = {RECORD}").select("value", "path", "first", F.lit(True).alias("whole"))
    in_order = Window.partitionBy("path").orderBy("start", "at")
    joined = Window.partitionBy("path", "_record")
    pieces = (
        true.where(f"kind <> {RECORD}")
        .withColumn("_record", F.sum(F.expr(f"int(kind = {TAIL})")).over(in_order))
        .withColumn("_bytes", F.sum(F.octet_length("value")).over(joined))
    )
    texts = "transform(array_sort(collect_list(struct(start, at, value))), p -> p.value)"
    records = (
        pieces.where(F.col("_bytes") <= MAX_RECORD)
        .groupBy("path", "_record")
        .agg(
            F.expr(f"array_join({texts}, '\\n') AS value"),
            F.bool_or("first").alias("first"),
            F.expr(f"bool_or(kind = {HEAD}) AS whole"),
        )
        .select("value", "path", "first", "whole")
    )
    long = pieces.where(F.col("_bytes") > MAX_RECORD).select("value", "path", "first", F.lit(False).alias("whole"))
    return sure.unionByName(cut_whole).unionByName(records).unionByName(long)
