"""Removal of long byte strings that occur twice: blockwise suffix sorting with a difference cover.

Two equal strings of ``MATCH`` bytes, wherever they start, have a place in common, less than the
cover's period behind their starts, that belongs to the cover in both texts. So the suffixes at cover
places are ranked first, by their next ``MATCH - period + 1`` bytes: a suffix can only have a long tie
with another if a cover suffix shortly behind it shares its rank with another cover suffix. Only such
suffixes go on. They are dealt into buckets, and one bucket is sorted at a time; within it the ties of
``MATCH`` bytes are the repeated strings.

Ranks and ties are told by fingerprints: 32 bits within a bucket for the cover, where a wrong rank only
lets a suffix go on in vain, and 64 bits within a bucket chosen by a second fingerprint for the ties.
Tasks exchange sorted fingerprints of a block of texts against bits that say which of them are shared,
in the same order. A block sends a fingerprint once however often it holds it, so no string is hot.

Equal texts are worked on once, with their count. A block, a bucket's share of the fingerprints, and one
text at a time are all that a task holds.

Defined results: a null text is empty; texts shorter than ``MATCH`` bytes keep everything; of repeated
rows of at least that length nothing is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lake_ingest.llm.blocks import Rolling, as_blocks, batch, text_bytes, unpack
from lake_ingest.llm.shared import saved

MATCH = 400
# Size parameter of the cover: 2 gives 16 of every 181 places.
COVER = 2
BLOCK_BYTES = 8 << 20
BUCKETS_PER_BLOCK = 2

FOUND = "key binary, n_bytes long, spans array<struct<start:int,end:int>>, kept_sha256 string"
_ASK = "bucket int, block long, payload binary"


def difference_cover(size: int) -> tuple[int, np.ndarray]:
    """Period and places of a cover in which every distance modulo the period occurs.

    The gaps between the places follow a rule of six runs (Colbourn and Ling, 2000).
    """
    r = size
    runs = [(1, r), (r + 1, 1), (2 * r + 1, r), (4 * r + 3, 2 * r + 1), (2 * r + 2, r + 1), (1, r)]
    gaps = [gap for gap, times in runs for _ in range(times)]
    return 24 * r * r + 36 * r + 13, np.concatenate([[0], np.cumsum(gaps)])


class Block:
    """The texts of a block on end, and which of their suffixes are asked about."""

    def __init__(self, payload, match: int, cover: int):
        self.rows = unpack(payload)
        self.data, self.offsets = text_bytes(self.rows["text"])
        self.match = match
        self.period, places = difference_cover(cover)
        self.covered = np.zeros(self.period, bool)
        self.covered[places] = True
        self.depth = match - self.period + 1

    def _inside(self, places: np.ndarray, length: int) -> np.ndarray:
        """Whether strings of a length starting at the places end within their texts."""
        ends = self.offsets[np.searchsorted(self.offsets, places, "right")]
        return places + length <= ends

    def cover_places(self) -> np.ndarray:
        """Cover places with enough text behind them."""
        parts = [
            start + np.flatnonzero(np.resize(self.covered, max(0, end - start - self.depth + 1)))
            for start, end in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist())
        ]
        return np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64)

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Suffixes that may have a long tie: less than a period before a cover place of shared rank."""
        begin = self.offsets[np.searchsorted(self.offsets, shared, "right") - 1]
        change = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(change, np.maximum(begin, shared - self.period + 1), 1)
        np.add.at(change, shared + 1, -1)
        places = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        return places[self._inside(places, self.match)]

    def repeated(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes in the repeated strings."""
        if not len(starts):
            return starts, starts
        gap = np.flatnonzero(starts[1:] > starts[:-1] + self.match) + 1
        # Strings of neighbouring texts may touch, but are runs of their own.
        text = np.searchsorted(self.offsets, starts, "right")
        cut = np.union1d(gap, np.flatnonzero(text[1:] != text[:-1]) + 1)
        return starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])] + self.match


class Question:
    """Fingerprints of a block's places by bucket, each once, and how answers map back to the places."""

    def __init__(self, block: Block, places: np.ndarray, length: int, buckets: int, bits: int):
        low = Rolling(11).of(block.data, places, places + length)
        high = low if bits == 32 else Rolling(12).of(block.data, places, places + length)
        bucket = ((high >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        value = low & np.uint64(0xFFFFFFFF) if bits == 32 else low
        order = np.lexsort((value, bucket))
        new = np.ones(len(order), bool)
        new[1:] = (value[order][1:] != value[order][:-1]) | (bucket[order][1:] != bucket[order][:-1])
        self.values = value[order][new].astype(np.uint32 if bits == 32 else np.uint64)
        self.of_place = np.empty(len(order), np.int64)
        self.of_place[order] = np.cumsum(new) - 1
        self.own = np.bincount(self.of_place, minlength=len(self.values)) > 1
        self.ends = np.searchsorted(bucket[order][new], np.arange(buckets + 1))

    def rows(self, block: int) -> pa.RecordBatch:
        asked = np.flatnonzero(np.diff(self.ends))
        parts = [self.values[self.ends[b] : self.ends[b + 1]].tobytes() for b in asked]
        return batch(
            bucket=pa.array(asked.astype(np.int32)),
            block=pa.array([block] * len(asked), pa.int64()),
            payload=pa.array(parts, pa.binary()),
        )

    def shared(self, answers: dict[int, bytes], copied: np.ndarray) -> np.ndarray:
        """Per place whether its fingerprint occurs again, here, in another block or in a copy of its text."""
        found = self.own.copy()
        for bucket, bits in answers.items():
            first, last = self.ends[bucket], self.ends[bucket + 1]
            found[first:last] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=last - first).astype(bool)
        return found[self.of_place] | copied


def _answer(bits: int):
    """Bits of the values of a bucket that more than one block sent."""
    kind = np.uint32 if bits == 32 else np.uint64

    def answer(rows: pa.Table) -> pa.Table:
        sent = [np.frombuffer(p.as_buffer(), kind) for p in rows["payload"]]
        values = np.sort(np.concatenate(sent))
        again = values[1:][values[1:] == values[:-1]]
        out = []
        for part in sent:
            at = np.searchsorted(again, part)
            hit = np.zeros(len(part), bool)
            inside = at < len(again)
            hit[inside] = again[at[inside]] == part[inside]
            out.append(np.packbits(hit).tobytes())
        return pa.table({"bucket": rows["bucket"], "block": rows["block"], "payload": pa.array(out, pa.binary())})

    return answer


def repeated_spans(
    docs: DataFrame, text: str = "text", *, match: int = MATCH, cover: int = COVER, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per different text with a removed byte: ``key`` (its SHA-256), ``n_bytes``, ``spans``, ``kept_sha256``.

    ``spans`` are the maximal runs of removed bytes, the end exclusive.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    texts = (
        docs.select(body.alias("text"))
        .where(F.octet_length("text") >= match)
        .groupBy("text")
        .agg(F.count("*").alias("copies"))
    )
    blocks = as_blocks(texts, "suffixes", block_bytes)
    buckets = max(8, BUCKETS_PER_BLOCK * blocks.count())

    def copied(block: Block, places: np.ndarray) -> np.ndarray:
        more = np.asarray(block.rows["copies"]) > 1
        return more[np.searchsorted(block.offsets, places, "right") - 1]

    def ask_cover(batches):
        for rows in batches:
            for number, payload in zip(rows["block"].to_pylist(), rows["payload"]):
                block = Block(payload.as_buffer(), match, cover)
                yield Question(block, block.cover_places(), block.depth, buckets, 32).rows(number)

    def candidates(table: pa.Table, answers: pa.Table) -> tuple[Block, np.ndarray]:
        block = Block(table["payload"][0].as_buffer(), match, cover)
        places = block.cover_places()
        question = Question(block, places, block.depth, buckets, 32)
        told = dict(zip(answers["bucket"].to_pylist(), answers["payload"].to_pylist()))
        return block, block.candidates(places[question.shared(told, copied(block, places))])

    def ask_candidates(table: pa.Table, answers: pa.Table) -> pa.Table:
        block, places = candidates(table, answers)
        asked = Question(block, places, match, buckets, 64).rows(table["block"][0].as_py())
        return pa.Table.from_batches([asked])

    def spans_of(table: pa.Table, answers: pa.Table) -> pa.Table:
        of_cover = pa.compute.equal(answers["step"], 1)
        block, places = candidates(table, answers.filter(of_cover))
        question = Question(block, places, match, buckets, 64)
        last = answers.filter(pa.compute.invert(of_cover))
        told = dict(zip(last["bucket"].to_pylist(), last["payload"].to_pylist()))
        starts, ends = block.repeated(places[question.shared(told, copied(block, places))])
        text_of = np.searchsorted(block.offsets, starts, "right") - 1
        hit, first = np.unique(text_of, return_index=True)
        bounds = np.append(first, len(starts))
        spans, digests, sizes = [], [], []
        for i, t in enumerate(hit.tolist()):
            begin, end = int(block.offsets[t]), int(block.offsets[t + 1])
            own = slice(bounds[i], bounds[i + 1])
            digest, at = hashlib.sha256(), begin
            for a, b in zip(starts[own].tolist(), ends[own].tolist()):
                digest.update(block.data[at:a])
                at = b
            digest.update(block.data[at:end])
            spans.append([{"start": a - begin, "end": b - begin} for a, b in zip(starts[own].tolist(), ends[own].tolist())])
            digests.append(digest.hexdigest())
            sizes.append(end - begin)
        keys = [hashlib.sha256(block.data[block.offsets[t] : block.offsets[t + 1]]).digest() for t in hit.tolist()]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table(
            {
                "key": pa.array(keys, pa.binary()),
                "n_bytes": pa.array(sizes, pa.int64()),
                "spans": pa.array(spans, kind),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    by_block = blocks.groupBy("block")
    ranked = blocks.mapInArrow(ask_cover, _ASK).groupBy("bucket").applyInArrow(_answer(32), _ASK)
    ranked = saved(ranked, "ranks")
    sorted_ = by_block.cogroup(ranked.groupBy("block")).applyInArrow(ask_candidates, _ASK)
    tied = saved(sorted_.groupBy("bucket").applyInArrow(_answer(64), _ASK), "ties")
    answers = ranked.withColumn("step", F.lit(1)).unionByName(tied.withColumn("step", F.lit(2)))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(spans_of, FOUND)


def kept_bytes(content: str, spans: str) -> Column:
    """The bytes of a binary column outside of the spans, on end."""
    starts = F.concat(F.array(F.lit(0)), F.col(spans)["end"])
    ends = F.concat(F.col(spans)["start"], F.array(F.octet_length(content)))
    # As strings the pieces are joined in one go, whatever their number; their bytes stay as they are.
    pieces = F.zip_with(starts, ends, lambda a, b: F.substring(content, a + 1, b - a).cast("string"))
    return F.array_join(pieces, "").cast("binary")


def digest(
    docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", *, kept: str | None = None
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every document.

    ``kept`` names a further column, the text that is left; what remains of a character that was cut is
    U+FFFD there.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.sha2(body.cast("binary"), 256).alias("whole"),
        *([body.alias("body")] if kept else []),
    ).withColumn("key", F.unhex("whole"))
    light = found.select(
        "key",
        F.expr("aggregate(spans, 0L, (s, x) -> s + x.end - x.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
        *(["spans"] if kept else []),
    )
    zero = F.lit(0).cast("long")
    joined = rows.join(light, "key", "left")
    left = []
    if kept:
        joined = joined.withColumn("content", F.col("body").cast("binary"))
        rest = F.make_valid_utf8(kept_bytes("content", "spans").cast("string"))
        left = [F.when(F.col("spans").isNull(), F.col("body")).otherwise(rest).alias(kept)]
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
        *left,
    )
