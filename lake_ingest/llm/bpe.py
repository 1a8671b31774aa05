"""BPE encoding and decoding through a table of distinct words.

Texts are cut into words where a space or line feed follows something that is surely no white space; no
token of a byte-level tokenizer crosses such a place, so the ids of a text are those of its words on
end. A block's distinct words are dealt out by hash; the task that gets a word encodes it once for all
blocks, and the ids go back to the blocks, where they are joined by the words' positions. Decoding
joins ids with the table of the tokenizer's pieces, which has a fixed size, and puts the bytes on end.

Defined results: a null text is empty and has no ids; texts with the special token's string are encoded
as the tokenizer does it, with the special id; very long words are words like others; repeated rows are
encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lake_ingest.llm.blocks import LEVEL, Rolling, as_blocks, batch, pieces, text_bytes, unpack
from lake_ingest.llm.shared import saved

DEFAULT = public_tokenizers.path("byte_bpe_50k.json")
# Distinct words encoded at a time.
CHUNK = 4096


def load(path: str) -> str:
    """The tokenizer's definition, refused unless words may be encoded apart."""
    text = Path(path).read_text()
    form = json.loads(text)
    pre = form["pre_tokenizer"] or {}
    apart = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
    if form["normalizer"] is not None or not apart:
        raise ValueError("only byte-level tokenizers without normalizer and prefix space are supported")
    return text


@lru_cache(1)
def _tokenizer(definition: str) -> Tokenizer:
    """The tokenizer of a worker; it uses one thread, for Spark runs a task per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the words of all texts start.

    A word starts with a text, and at a space or line feed after a byte that ends no white space: an
    ASCII sign or the last byte of a character that is not in a range where white space occurs.
    """
    starts = np.zeros(len(data), bool)
    if len(data):
        last = data[:-1]
        solid = (last > 0x20) & (last != 0x7F)
        wide = last >= 0x80
        if wide.any():
            lead2 = np.zeros(len(last), np.uint8)
            lead3 = np.zeros(len(last), np.uint8)
            lead2[1:], lead3[2:] = data[: len(last) - 1], data[: max(len(last) - 2, 0)]
            solid &= ~(wide & ((lead2 == 0xC2) | ((lead3 >= 0xE1) & (lead3 <= 0xE3))))
        starts[1:] = solid & ((data[1:] == 0x20) | (data[1:] == 0x0A))
        starts[offsets[:-1][offsets[:-1] < len(data)]] = True
    return np.flatnonzero(starts)


def _distinct(rows: pa.Table) -> tuple[pa.LargeBinaryArray, np.ndarray, np.ndarray]:
    """A block's distinct words, the word at each position, and each text's first position."""
    data, offsets = text_bytes(rows["text"])
    starts = word_starts(data, offsets)
    coded = pieces(data, starts).dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices), np.searchsorted(starts, offsets)


def _dealt(words: pa.LargeBinaryArray, buckets: int) -> list[np.ndarray]:
    """Places of the words in each bucket, in the words' order; a bucket depends on a word's bytes alone."""
    lengths, data = _spread(words)
    ends = np.cumsum(lengths)
    prints = Rolling(5).of(data, ends - lengths, ends)
    bucket = (prints >> np.uint64(20)) % np.uint64(buckets)
    ordered = np.asarray(pc.sort_indices(words), np.int64)
    order = ordered[np.argsort(bucket[ordered], kind="stable")]
    return np.split(order, np.searchsorted(bucket[order], np.arange(1, buckets)))


def _spread(words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of an array's values, and their bytes on end."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = words.buffers()
    places = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    return np.diff(places), np.frombuffer(data, np.uint8)[places[0] : places[-1]]


def _squeezed(lengths: np.ndarray, values: np.ndarray) -> bytes:
    """Compressed lists: their number, their lengths, their values on end."""
    head = np.array([len(lengths)], np.int64).tobytes() + lengths.astype(np.uint32).tobytes()
    return zstandard.compress(head + values.tobytes(), LEVEL)


def _lists(payload: bytes, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of compressed lists."""
    content = zstandard.decompress(payload)
    n = int(np.frombuffer(content, np.int64, 1)[0])
    return np.frombuffer(content, np.uint32, n, 8).astype(np.int64), np.frombuffer(content, kind, offset=8 + 4 * n)


def encode(
    docs: DataFrame, keys: list[str], text: str = "text", path: str = DEFAULT, *, decoded: bool = False
) -> DataFrame:
    """The columns ``keys`` and ``ids``, the token ids of each row's text; with ``decoded`` also their text."""
    definition, table = load(path), piece_table(path)
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = np.uint16 if len(table) <= 1 << 16 else np.uint32
    carried = [F.col(k).alias(f"key{i}") for i, k in enumerate(keys)]
    names = [f"key{i}" for i in range(len(keys))]
    blocks = as_blocks(docs.select(*carried, F.col(text).cast("string").alias("text")), "texts")

    def words_of(batches):
        for rows in batches:
            for block, payload in zip(rows["block"].to_pylist(), rows["payload"]):
                words, _, _ = _distinct(unpack(payload.as_buffer()))
                dealt = [(b, places) for b, places in enumerate(_dealt(words, buckets)) if len(places)]
                yield batch(
                    bucket=pa.array([b for b, _ in dealt], pa.int32()),
                    block=pa.array([block] * len(dealt), pa.int64()),
                    payload=pa.array([_squeezed(*_spread(words.take(pa.array(p)))) for _, p in dealt], pa.binary()),
                )
                pa.default_memory_pool().release_unused()

    def encode_bucket(rows: pa.Table) -> pa.Table:
        tokenizer = _tokenizer(definition)
        parts = []
        for payload in rows["payload"].to_pylist():
            lengths, data = _lists(payload, np.uint8)
            parts.append(pieces(data, np.cumsum(lengths) - lengths))
        coded = pa.concat_arrays(parts).dictionary_encode()
        distinct, lengths, values = coded.dictionary, [], []
        for at in range(0, len(distinct), CHUNK):
            some = [w.decode() for w in distinct.slice(at, CHUNK).to_pylist()]
            found = [e.ids for e in tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            lengths.append(np.fromiter(map(len, found), np.int64, len(found)))
            values.append(np.fromiter((i for ids in found for i in ids), kind))
        ends = np.cumsum(np.concatenate([[0], *lengths]))
        ids = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values)))
        at, out = 0, []
        for part in parts:
            taken = ids.take(coded.indices.slice(at, len(part)))
            out.append(_squeezed(np.diff(np.asarray(taken.offsets)), np.asarray(taken.flatten())))
            at += len(part)
        pa.default_memory_pool().release_unused()
        return pa.table({"bucket": rows["bucket"], "block": rows["block"], "payload": pa.array(out, pa.binary())})

    def join_back(block: pa.Table, encoded: pa.Table) -> pa.Table:
        rows = unpack(block["payload"][0].as_buffer())
        words, at, firsts = _distinct(rows)
        told = dict(zip(encoded["bucket"].to_pylist(), encoded["payload"].to_pylist()))
        dealt = [(b, places) for b, places in enumerate(_dealt(words, buckets)) if len(places)]
        lists = [_lists(told[b], kind) for b, _ in dealt]
        if lists:
            place = np.empty(len(words), np.int64)
            place[np.concatenate([p for _, p in dealt])] = np.arange(len(words))
            ends = np.cumsum(np.concatenate([[0], *(n for n, _ in lists)]))
            ids = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([v for _, v in lists])))
            by_position = ids.take(pa.array(place[at]))
            ends, ids = np.asarray(by_position.offsets)[firsts], by_position.flatten().cast(pa.int32())
        else:
            ends, ids = np.zeros(len(firsts), np.int64), pa.array([], pa.int32())
        columns = {n: rows[n] for n in names}
        columns["ids"] = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids)
        if decoded:
            columns["decoded"] = _texts(ids, ends, pa.array(table, pa.large_binary()))
        pa.default_memory_pool().release_unused()
        return pa.table(columns)

    words = blocks.mapInArrow(words_of, "bucket int, block long, payload binary")
    encoded = saved(
        words.groupBy("bucket").applyInArrow(encode_bucket, "bucket int, block long, payload binary"), "ids"
    )
    types = {f.name: f.dataType for f in docs.select(*carried).schema.fields}
    schema = T.StructType(
        [*(T.StructField(n, types[n]) for n in names), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )
    if decoded:
        schema = schema.add("decoded", T.StringType())
    joined = blocks.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(join_back, schema)
    return joined.select(*(F.col(n).alias(k) for n, k in zip(names, keys)), *schema.names[len(names) :])


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte: itself where it is printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs = {chr(b): b for b in printable}
    rest = (b for b in range(256) if b not in set(printable))
    return signs | {chr(256 + i): b for i, b in enumerate(rest)}


def piece_table(path: str = DEFAULT) -> list[bytes]:
    """The bytes of each id."""
    tokenizer, signs = Tokenizer.from_str(load(path)), _byte_signs()
    added = {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    vocabulary = {i: bytes(signs[c] for c in p) for p, i in tokenizer.get_vocab(False).items()} | added
    return [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]


def _texts(ids: pa.Array, ends: np.ndarray, table: pa.Array) -> pa.Array:
    """Texts of the ids between two ends each: the ids joined with the pieces, their bytes on end."""
    found = table.take(ids.cast(pa.int64()))
    if not len(found):
        return pa.array([""] * (len(ends) - 1), pa.string())
    places = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
    content = memoryview(found.buffers()[2] or b"")
    at = places[ends]
    return pa.array([str(content[a:b], "utf-8", "replace") for a, b in zip(at[:-1], at[1:])], pa.string())


def decode(encoded: DataFrame, ids: str = "ids", path: str = DEFAULT) -> DataFrame:
    """The rows with ``decoded``, the text of their ids; bytes that are no UTF-8 become U+FFFD."""
    table = piece_table(path)

    def to_text(batches):
        held = pa.array(table, pa.large_binary())
        for rows in batches:
            lengths = np.asarray(pc.list_value_length(rows[ids]).fill_null(0))
            texts = _texts(rows[ids].flatten(), np.concatenate([[0], np.cumsum(lengths)]), held)
            yield pa.RecordBatch.from_arrays([*rows.columns, texts], names=[*rows.schema.names, "decoded"])

    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(to_text, schema)


def digest(decoded: DataFrame) -> dict[str, Column]:
    """Columns ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of decoded rows."""
    return {
        "n_tokens": F.size("ids").cast("long"),
        "ids_sha256": F.sha2(F.array_join("ids", ","), 256),
        "decoded_sha256": F.sha2("decoded", 256),
    }
