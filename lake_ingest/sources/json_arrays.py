"""JSON arrays that no task could hold, split into their elements in parallel.

A document comes in parts. What a byte means depends on all before it: whether a string is open, whether the
byte is escaped, how deep brackets are nested. Each part is therefore read first as a function of these: from
each of the three states outside a string, inside one, and behind a backslash inside one, to the state at its
end and the change of depth. The functions of a document's parts, composed in their order, tell where each
part begins: those of a block of parts make one function, those of the blocks tell where each block begins, so
that no task goes through all parts of a document. In a second reading every part cuts its elements at the
commas of depth one. Elements that reach over the ends of parts are put together from their pieces; nothing
else is shuffled, and no row holds more than a part or an element.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.operators.listing import spread
from lake_ingest.session import shared_dir

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
# What a piece is: a whole element, the end of one, a part without an end, the beginning of one; a text that has no
# place beside the array; or the array's opening bracket.
WHOLE, HEAD, THROUGH, TAIL, STRAY, OPENING = 0, 1, 2, 3, 4, 5

ReadPart = Callable[[dict], bytes]

# Parts whose functions are composed into one, and rows and bytes that a task hands back at once.
BLOCK = 1024
_ROWS = 8192
_BYTES = 4 * 1024 * 1024

_QUOTE, _BACKSLASH, _COMMA = 0x22, 0x5C, 0x2C
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[0x5B, 0x7B]], _DEPTH[[0x5D, 0x7D]] = 1, -1


def _strings(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Whether each byte lies in a string (its opening quote does), and the state after the last one."""
    slashes = np.flatnonzero(data == _BACKSLASH)
    escaped = np.zeros(len(data) + 1, bool)
    escaped[0] = state == ESCAPED
    if len(slashes) or escaped[0]:
        # In a run of backslashes every other one escapes the byte behind it.
        for at in slashes.tolist():
            escaped[at + 1] = not escaped[at]
    quotes = (data == _QUOTE) & ~escaped[:-1]
    before = np.concatenate([[0], np.cumsum(quotes)])
    inside = (before[:-1] + (state != OUTSIDE)) % 2 == 1
    open_after = (before[-1] + (state != OUTSIDE)) % 2 == 1
    after = ESCAPED if open_after and escaped[-1] else INSIDE if open_after else OUTSIDE
    return inside | quotes, after


def part_function(content: bytes) -> list[tuple[int, int]]:
    """From each state the state after the part, and the change of depth."""
    data, out = np.frombuffer(content, np.uint8), []
    for state in (OUTSIDE, INSIDE, ESCAPED):
        inside, after = _strings(data, state)
        out.append((after, int(_DEPTH[data[~inside]].sum(dtype=np.int64))))
    return out


def pieces_of(content: bytes, state: int, depth: int) -> Iterator[tuple[int, bytes]]:
    """``(kind, text)`` of a part that begins in a state and at a depth."""
    data = np.frombuffer(content, np.uint8)
    inside, _ = _strings(data, state)
    change = np.where(inside, 0, _DEPTH[data])
    deep = depth + np.cumsum(change)
    cuts = ~inside & (((change == 1) & (deep == 1)) | ((data == _COMMA) & (deep == 1)) | ((change == -1) & (deep == 0)))
    at, started, in_array = 0, False, depth >= 1
    for cut in np.flatnonzero(cuts).tolist():
        text = content[at:cut]
        if data[cut] in (0x5B, 0x7B) and change[cut] == 1 and deep[cut] == 1:
            if text.strip():
                yield STRAY, text
            yield (STRAY if data[cut] == 0x7B else OPENING), b""
            in_array = True
        else:
            yield (WHOLE if started else HEAD), text
            in_array = data[cut] == _COMMA
        at, started = cut + 1, in_array
    rest = content[at:]
    if in_array:
        yield (TAIL if started else THROUGH), rest
    elif rest.strip():
        yield STRAY, rest


def composed(rows: Iterator[dict]) -> Iterator[dict]:
    """A function per block, of rows ``(key, block, after, change)`` in order."""
    for (key, block), parts in groupby(rows, itemgetter("key", "block")):
        after, change = [OUTSIDE, INSIDE, ESCAPED], [0, 0, 0]
        for part in parts:
            change = [so_far + part["change"][state] for so_far, state in zip(change, after)]
            after = [part["after"][state] for state in after]
        yield {"key": key, "block": block, "after": after, "change": change}


def begins(rows: Iterator[dict]) -> Iterator[dict]:
    """State and depth at the beginning of each part, of rows in order that have those of their block."""
    for _, parts in groupby(rows, itemgetter("key", "block")):
        state = depth = None
        for part in parts:
            if state is None:
                state, depth = part["state"], part["depth"]
            yield {"key": part["key"], "part": part["part"], "state": state, "depth": depth}
            state, depth = part["after"][state], depth + part["change"][state]


def _in_tasks(helper: Callable[[Iterator[dict]], Iterator[dict]], schema: pa.Schema):
    """The helper over all rows of a task; rows are handed back some at a time."""

    def run(batches):
        held, size = [], 0
        for row in helper(row for batch in batches for row in batch.to_pylist()):
            held.append(row)
            size += len(row.get("piece", b""))
            if len(held) == _ROWS or size >= _BYTES:
                yield pa.RecordBatch.from_pylist(held, schema)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    return run


_FUNCTION = [("after", pa.list_(pa.int32())), ("change", pa.list_(pa.int64()))]
_MEASURED = pa.schema([("key", pa.string()), ("part", pa.int64()), *_FUNCTION])
_COMPOSED = pa.schema([("key", pa.string()), ("block", pa.int64()), *_FUNCTION])
_BEGINS = pa.schema([("key", pa.string()), ("part", pa.int64()), ("state", pa.int32()), ("depth", pa.int64())])
_PIECES = pa.schema([("key", pa.string()), ("part", pa.int64()), ("at", pa.int64()), ("kind", pa.int32()), ("piece", pa.binary())])
FUNCTIONS = "key string, part bigint, after array<int>, change array<bigint>"
BEGINS = "key string, part bigint, state int, depth bigint"
PIECES = "key string, part bigint, at bigint, kind int, piece binary"


def _in_order(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key together, and by block and part."""
    return rows.repartition(*keys).sortWithinPartitions("key", "block", "part")


def part_begins(functions: DataFrame) -> DataFrame:
    """``BEGINS`` of all parts, given their ``FUNCTIONS``."""
    blocked = functions.withColumn("block", F.expr(f"part DIV {BLOCK}"))
    joined = _in_order(blocked, "key", "block").mapInArrow(
        _in_tasks(composed, _COMPOSED), "key string, block bigint, after array<int>, change array<bigint>"
    )
    # A block is to its document what a part is to its block.
    outermost = joined.withColumns(
        {"part": F.col("block"), "block": F.lit(0), "state": F.lit(OUTSIDE), "depth": F.lit(0).cast("bigint")}
    )
    of_blocks = _in_order(outermost, "key").mapInArrow(_in_tasks(begins, _BEGINS), BEGINS)
    placed = blocked.join(of_blocks.withColumnRenamed("part", "block"), ["key", "block"])
    return _in_order(placed, "key", "block").mapInArrow(_in_tasks(begins, _BEGINS), BEGINS)


def element_numbers(pieces: DataFrame) -> DataFrame:
    """Pieces of elements that reach over the ends of parts, ``_element`` the number of theirs in the document."""
    tail = F.expr(f"int(kind = {TAIL})")
    blocked = pieces.withColumn("_block", F.expr(f"part DIV {BLOCK}"))
    before = Window.partitionBy("key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = blocked.groupBy("key", "_block").agg(F.sum(tail).alias("_tails"))
    counts = counts.select("key", "_block", F.coalesce(F.sum("_tails").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("key", "_block").orderBy("part", "at")
    return (
        blocked.join(counts, ["key", "_block"])
        .withColumn("_element", F.col("_before") + F.sum(tail).over(within))
        .drop("_block", "_before")
    )


def array_elements(parts: DataFrame, read: ReadPart) -> DataFrame:
    """``(key, element, error)``: the elements of each document, as texts.

    ``parts`` has ``key, part`` and what ``read`` needs to get the part's bytes in a task. An empty array has no
    rows. Text beside the array, a document that is an object, and one that ends early are an ``error`` row.
    """
    names, spark = parts.columns, parts.sparkSession

    def measure(rows):
        for row in rows:
            after, change = zip(*part_function(read(row)))
            yield {"key": row["key"], "part": row["part"], "after": after, "change": change}

    def cut(rows):
        for row in rows:
            for i, (kind, text) in enumerate(pieces_of(read(row), row["_state"], row["_depth"])):
                yield {"key": row["key"], "part": row["part"], "at": i, "kind": kind, "piece": text}

    # The functions, and what is not whole elements, are little. They are written once, so that the documents
    # are read three times in all.
    place = f"{shared_dir(spark)}/json-parts-{uuid.uuid4().hex}"
    parts.mapInArrow(_in_tasks(measure, _MEASURED), FUNCTIONS).write.parquet(f"{place}/functions")
    starts = part_begins(spark.read.schema(FUNCTIONS).parquet(f"{place}/functions"))
    placed = parts.join(
        starts.select("key", "part", F.col("state").alias("_state"), F.col("depth").alias("_depth")), ["key", "part"]
    )
    work = spread(placed.select(*names, "_state", "_depth"), None, "key", "part")
    found = work.mapInArrow(_in_tasks(cut, _PIECES), PIECES)
    found.where(f"kind <> {WHOLE}").write.parquet(f"{place}/pieces")
    rest = spark.read.schema(PIECES).parquet(f"{place}/pieces")
    whole = found.where(f"kind = {WHOLE}").select("key", F.col("piece").alias("content"), F.lit(True).alias("ends"))
    open_ = (
        element_numbers(rest.where(f"kind IN ({HEAD}, {THROUGH}, {TAIL})"))
        .groupBy("key", "_element")
        .agg(
            F.expr(
                """aggregate(array_sort(collect_list(struct(part, at, piece))), CAST('' AS binary),
                    (s, p) -> concat(s, p.piece))"""
            ).alias("content"),
            F.bool_or(F.col("kind") == HEAD).alias("ends"),
        )
        .select("key", "content", "ends")
    )
    stray = (
        rest.where(f"kind IN ({STRAY}, {OPENING})")
        .groupBy("key")
        .agg(F.count_if(F.col("kind") == STRAY).alias("strays"), F.count_if(F.col("kind") == OPENING).alias("arrays"))
        .where("strays > 0 OR arrays > 1")
    )
    text = F.expr(r"regexp_replace(make_valid_utf8(content), '\\A[ \\t\\r\\n]+|[ \\t\\r\\n]+\\z', '')")
    elements = whole.unionByName(open_).select(
        "key",
        text.alias("element"),
        F.when(~F.col("ends"), "the document ends inside an array").alias("error"),
    )
    beside = stray.select("key", F.lit(None).cast(T.StringType()).alias("element"), F.lit("no single array").alias("error"))
    return elements.where("element <> '' OR error IS NOT NULL").unionByName(beside)
