"""Alignment of two tokenizers over the same texts, and how often their tokens meet in the corpus.

Tokenizer A is a byte-level BPE that reads a space and the text; B is a sentencepiece model that puts the
space itself. Both thus write the same bytes. In every batch ``merge_asof``, keyed by document, finds for
each token's start the other side's token that covers it; the pairs of both directions together are the
links, all pairs whose byte ranges overlap. Offsets at which tokens of both sides end cut the tokens into
groups. Links of a document, in order, are a staircase: each one goes on by a token of A, of B, or of both,
and a step of both is a group's end. So a document is stored as its ids and one byte per link.

Texts are encoded once, into blocks on shared storage. A block's distinct id pairs and their counts are
summed over the corpus by Spark, the highest count of every B id is joined to them, and the answers go back
to the blocks that hold the pair, where each document adds them up. A pair is shuffled once per block, so a
frequent one is no hot key; texts and tokens are not shuffled.

Defined results: a null or empty text, and one whose bytes a tokenizer does not give back (a normalising
model, the sign U+2581 in a text), has no tokens, groups or links; strings of special tokens inside texts
are plain text; a text without tokens adds to no count; repeated rows are aligned and counted alike; very
long texts and words are like others; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lake_ingest.llm.blocks import BLOCKS, batch, bucketed, pack, slices_of, text_bytes, unpack
from lake_ingest.llm.bpe import load, piece_table
from lake_ingest.llm.shared import frugal, saved

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Bytes of text that are encoded and aligned at a time, and make a block.
SLICE_BYTES = 4 << 20
# Steps from a link to the next one, and the last link of a document.
NEXT_A, NEXT_B, NEXT_BOTH = 1, 2, 3
_LEVEL = 3


class ByteLevel:
    """The byte-level tokenizer: ranked merges, where the ids are the ranks, else the definition as it is.

    Both give the same ids; ranked merges are several times as fast, but recurse in long white space.
    """

    LONG_SPACE = re.compile(r"\s{1000}")

    def __init__(self, definition: str, table: list[bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        self.ranked = None
        form = json.loads(definition)
        model, special = form["model"], {t["id"] for t in form["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        first = min((model["vocab"]["".join(m)] for m in merges), default=0)
        if all(model["vocab"]["".join(m)] == first + i for i, m in enumerate(merges)):
            ranks = {piece: i for i, piece in enumerate(table) if i not in special and piece}
            self.ranked = tiktoken.Encoding(
                "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, text: str) -> np.ndarray:
        if self.ranked is None or self.LONG_SPACE.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(np.int64)


@lru_cache(1)
def _piece_model(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def model_pieces(model: bytes) -> list[bytes]:
    """Bytes of each id of B; control and unknown pieces stand for none."""
    held = _piece_model(model)
    out = []
    for i in range(held.get_piece_size()):
        if held.is_byte(i):
            out.append(bytes([int(held.id_to_piece(i)[1:-1], 16)]))
        elif held.is_control(i) or held.is_unknown(i):
            out.append(b"")
        else:
            out.append(held.id_to_piece(i).replace("▁", " ").encode())
    return out


def encode(texts: list[str], encoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts on end, and where each text's ids start."""
    parts = [np.asarray(encoder(text), np.int64) for text in texts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)
    return np.concatenate([*parts, np.zeros(0, np.int64)]), starts


def _joined(ids: np.ndarray, starts: np.ndarray, table: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the ids on end, and where each text's bytes start."""
    found = table.take(pa.array(ids))
    if not len(found):
        return np.zeros(0, np.uint8), np.zeros(len(starts), np.int64)
    places = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1]
    content = found.buffers()[2]
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], (places - places[0])[starts]


def _same(spaced: pa.Array, a: tuple, b: tuple) -> np.ndarray:
    """Of each text, whether both sides' bytes are its own."""
    data, offsets = text_bytes(spaced)
    out = np.diff(offsets) > 1
    for content, starts in (a, b):
        if len(content) == len(data) and np.array_equal(starts, offsets) and np.array_equal(content, data):
            continue
        for i in np.flatnonzero(out):
            own = data[offsets[i] : offsets[i + 1]]
            out[i] = np.array_equal(content[starts[i] : starts[i + 1]], own)
    return out


def _only(ids: np.ndarray, starts: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and starts when the texts that are not kept lose theirs."""
    lengths = np.diff(starts)
    return ids[np.repeat(kept, lengths)], np.concatenate([[0], np.cumsum(np.where(kept, lengths, 0))])


def links(doc_a: np.ndarray, starts_a: np.ndarray, doc_b: np.ndarray, starts_b: np.ndarray):
    """Pairs ``(place in A, place in B)`` of tokens whose ranges overlap, ascending.

    Tokens come in order, each with the number of its document and its start among the bytes of all.
    """
    a = pd.DataFrame({"at": starts_a, "doc": doc_a, "a": np.arange(len(starts_a))})
    b = pd.DataFrame({"at": starts_b, "doc": doc_b, "b": np.arange(len(starts_b))})
    covered_a = pd.merge_asof(a, b, on="at", by="doc", direction="backward")
    covered_b = pd.merge_asof(b, a, on="at", by="doc", direction="backward")
    # Both directions find the pairs that start together: these are taken from the first one.
    later = covered_b[starts_a[covered_b["a"].to_numpy()] < covered_b["at"].to_numpy()] if len(b) else covered_b
    left, right, at = (
        np.concatenate([covered_a[c].to_numpy(), later[c].to_numpy()]).astype(np.int64) for c in ("a", "b", "at")
    )
    # Two ascending runs, which a stable sort merges; a link lies where the later one of its tokens starts.
    order = np.argsort(at, kind="stable")
    return left[order], right[order]


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(starts.astype(np.int64)), pa.array(values).cast(kind))


def _aligned(rows: pa.RecordBatch, tokenizer: ByteLevel, model, table_a: pa.Array, table_b: pa.Array) -> pa.Table:
    """The rows with the ids of both sides and the steps from link to link, in place of the text."""
    texts = rows["text"].cast(pa.large_string()).fill_null("")
    space, nothing = (pa.scalar(t, pa.large_string()) for t in (" ", ""))
    spaced = pc.binary_join_element_wise(space, texts, nothing)
    plain = texts.to_pylist()
    ids_a, at_a = encode([" " + t for t in plain], tokenizer.encode)
    ids_b, at_b = encode(plain, model.encode)
    kept = _same(spaced, _joined(ids_a, at_a, table_a), _joined(ids_b, at_b, table_b))
    ids_a, at_a = _only(ids_a, at_a, kept)
    ids_b, at_b = _only(ids_b, at_b, kept)
    ends_a = np.cumsum(np.asarray(pc.binary_length(table_a))[ids_a])
    ends_b = np.cumsum(np.asarray(pc.binary_length(table_b))[ids_b])
    doc_a, doc_b = (np.repeat(np.arange(len(kept)), np.diff(at)) for at in (at_a, at_b))
    starts_a, starts_b = (np.concatenate([[0], ends])[:-1] for ends in (ends_a, ends_b))
    left, right = links(doc_a, starts_a, doc_b, starts_b)
    step = np.where(ends_a[left] == ends_b[right], NEXT_BOTH, np.where(ends_a[left] < ends_b[right], NEXT_A, NEXT_B))
    at_step = np.searchsorted(doc_a[left], np.arange(len(kept) + 1))
    columns = {name: rows[name] for name in rows.schema.names if name != "text"}
    columns |= {
        "a": _lists(ids_a, at_a, pa.uint32()),
        "b": _lists(ids_b, at_b, pa.uint32()),
        "steps": _lists(step, at_step, pa.uint8()),
    }
    return pa.table(columns)


class Linked:
    """The tokens and links of a block's documents."""

    def __init__(self, rows: pa.Table):
        def lists(name):
            column = rows[name].combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            starts = np.asarray(column.offsets).astype(np.int64)
            return np.asarray(column.values)[starts[0] : starts[-1]], starts - starts[0]

        (self.a, self.at_a), (self.b, self.at_b), (self.step, self.at) = map(lists, ("a", "b", "steps"))
        # Every document's last step goes on by both, into the next document's first tokens.
        moved_a, moved_b = (self.step != NEXT_B), (self.step != NEXT_A)
        self.left = np.cumsum(moved_a) - moved_a
        self.right = np.cumsum(moved_b) - moved_b

    def pairs(self) -> np.ndarray:
        """The id pair of every link, as one number."""
        return (self.a[self.left].astype(np.int64) << 32) | self.b[self.right].astype(np.int64)

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every group the places of its last tokens."""
        last = self.step == NEXT_BOTH
        return self.left[last], self.right[last]


def _per_document(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[at[1:]] - sums[at[:-1]]


@lru_cache(1)
def _signs(n_ids: int) -> pa.Array:
    """All ids as texts, followed by each of the signs that may come after one, and by none."""
    return pa.array([f"{i}{s}" for s in (",", "|", ";", "") for i in range(n_ids)], pa.large_string())


def _group_texts(block: Linked, n_ids: int) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of each document: the decimal ids of its groups, in order."""
    last_a, last_b = block.groups()
    n = len(block.a) + len(block.b)
    group_a = np.searchsorted(last_a, np.arange(len(block.a)))
    group_b = np.searchsorted(last_b, np.arange(len(block.b)))
    # A token's place is behind all tokens of earlier groups, and behind those of A for one of B.
    place_a = np.arange(len(block.a)) + np.concatenate([[0], last_b + 1])[group_a]
    place_b = np.arange(len(block.b)) + (last_a + 1)[group_b]
    code = np.empty(n, np.int64)
    code[place_a], code[place_b] = block.a, block.b
    code[place_a[last_a]] += n_ids
    code[place_b[last_b]] += 2 * n_ids
    ends = block.at_a + block.at_b
    code[ends[1:][np.diff(ends) > 0] - 1] += n_ids
    texts = _signs(n_ids).take(pa.array(code))
    if not n:
        return pa.array([""] * (len(ends) - 1), pa.large_string())
    places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1][ends]
    return pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(np.ascontiguousarray(places)), texts.buffers()[2])


def _blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``(block, payload)`` of ``docs`` with the columns of ``_aligned``, in a table bucketed by block."""
    definition, model = load(a_path), Path(b_path).read_bytes()
    bytes_a = piece_table(a_path)

    def encoded(batches):
        partition, block = TaskContext.get().partitionId(), 0
        tokenizer, pieces_b = ByteLevel(definition, bytes_a), _piece_model(model)
        table_a = pa.array(bytes_a, pa.large_binary())
        table_b = pa.array(model_pieces(model), pa.large_binary())
        for rows in batches:
            for part in slices_of(rows, "text", SLICE_BYTES):
                payload = pack(_aligned(part, tokenizer, pieces_b, table_a, table_b), _LEVEL)
                yield batch(
                    block=pa.array([(partition << 32) + block], pa.int64()), payload=pa.array([payload], pa.binary())
                )
                block += 1
                pa.default_memory_pool().release_unused()

    with frugal(docs.sparkSession):
        return bucketed(docs.mapInArrow(encoded, BLOCKS), "block", "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(block, pair, n)`` of the distinct id pairs of every block: how many of its links hold the pair."""

    def count(batches):
        for rows in batches:
            for block, payload in zip(rows["block"].to_pylist(), rows["payload"]):
                pair, n = np.unique(Linked(unpack(payload.as_buffer())).pairs(), return_counts=True)
                yield batch(block=pa.array(np.full(len(pair), block)), pair=pa.array(pair), n=pa.array(n.astype(np.int64)))

    return blocks.mapInArrow(count, "block long, pair long, n long")


def told(counts: DataFrame) -> DataFrame:
    """``(block, pair, n, best)``: the pair's count in the corpus, and whether none of its B id is higher."""
    whole = counts.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    highest = whole.groupBy("b").agg(F.max("n").alias("top"))
    marked = whole.join(highest, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    return counts.select("block", "pair").join(marked, "pair")


def align(
    docs: DataFrame,
    keys: list[str],
    text: str = "text",
    a_path: str = BYTE_LEVEL,
    b_path: str = PIECES,
    *,
    detail: bool = False,
) -> DataFrame:
    """The columns ``keys`` of every row with its alignment.

    ``n_a, n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` (links whose pair's count is the highest of
    its B id), ``count_sum`` (of the pairs' counts over all links) and ``groups``, the ids of each group as
    ``a1,a2|b1;a3|b2,b3``; with ``detail`` also ``a_ids, b_ids`` and of every link the places ``link_a,
    link_b`` of its tokens, ``link_count`` and ``link_best``.
    """
    carried = [F.col(k).alias(f"key{i}") for i, k in enumerate(keys)]
    names = [f"key{i}" for i in range(len(keys))]
    blocks = _blocks(docs.select(*carried, F.col(text).cast("string").alias("text")), a_path, b_path)
    n_ids = len(piece_table(a_path))
    n_ids = max(n_ids, _piece_model(Path(b_path).read_bytes()).get_piece_size())

    def summed(block: pa.Table, answers: pa.Table) -> pa.Table:
        rows = unpack(block["payload"][0].as_buffer())
        held = Linked(rows)
        known = np.asarray(answers["pair"])
        order = np.argsort(known, kind="stable")
        at = order[np.searchsorted(known[order], held.pairs())] if len(known) else np.zeros(0, np.int64)
        n = np.asarray(answers["n"])[at]
        best = np.asarray(answers["best"])[at].astype(bool)
        columns = {name: rows[name] for name in names}
        columns |= {
            "n_a": pa.array(np.diff(held.at_a)),
            "n_b": pa.array(np.diff(held.at_b)),
            "n_groups": pa.array(_per_document(held.step == NEXT_BOTH, held.at)),
            "n_links": pa.array(np.diff(held.at)),
            "n_best": pa.array(_per_document(best, held.at)),
            "count_sum": pa.array(_per_document(n, held.at)),
            "groups": _group_texts(held, n_ids),
        }
        if detail:
            first_a, first_b = np.repeat(held.at_a[:-1], np.diff(held.at)), np.repeat(held.at_b[:-1], np.diff(held.at))
            columns |= {
                "a_ids": _lists(held.a, held.at_a, pa.int32()),
                "b_ids": _lists(held.b, held.at_b, pa.int32()),
                "link_a": _lists(held.left - first_a, held.at, pa.int32()),
                "link_b": _lists(held.right - first_b, held.at, pa.int32()),
                "link_count": _lists(n, held.at, pa.int64()),
                "link_best": _lists(best, held.at, pa.bool_()),
            }
        pa.default_memory_pool().release_unused()
        table = pa.table(columns)
        return table.cast(pa.schema([_plain(f) for f in table.schema]))

    types = {f.name: f.dataType for f in docs.select(*carried).schema.fields}
    schema = T.StructType([T.StructField(n, types[n]) for n in names])
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("groups", T.StringType())
    if detail:
        for name in ("a_ids", "b_ids", "link_a", "link_b"):
            schema = schema.add(name, T.ArrayType(T.IntegerType()))
        schema = schema.add("link_count", T.ArrayType(T.LongType())).add("link_best", T.ArrayType(T.BooleanType()))
    answers = told(saved(pair_counts(blocks), "pairs"))
    joined = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(summed, schema)
    return joined.select(*(F.col(n).alias(k) for n, k in zip(names, keys)), *schema.names[len(names) :])


def _plain(field: pa.Field) -> pa.Field:
    """The field with 32-bit offsets, as Spark's types have them."""
    if pa.types.is_large_string(field.type):
        return field.with_type(pa.string())
    if pa.types.is_large_list(field.type):
        return field.with_type(pa.list_(field.type.value_type))
    return field


def digest() -> dict[str, Column]:
    """Column ``groups_sha256`` of aligned rows: empty where there are no tokens."""
    return {"groups_sha256": F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256))}
