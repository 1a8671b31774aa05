"""Phrases whose words keep together: candidates by mergeable Misra-Gries summaries, then exact counts.

A phrase of 2 to 5 words is a candidate if it occurs often enough in its language. Blocks of texts count
their phrases by 64-bit fingerprints of language and words, dealt by ranges of the fingerprint into hash
partitions. A partition merges its blocks' counts into one Misra-Gries summary: whenever it has more
counters than its capacity, the highest count beyond the capacity is subtracted from all. With a capacity
above the partition's mass divided by the threshold, all subtractions together stay below the threshold, so
that every phrase that reaches it survives, in memory that depends on the capacity and not on how many
phrases there are. A second pass over the partition's counts tells the survivors' exact numbers. The frequent
ones go back to the blocks that hold them, for the next round, and the first of these blocks names their words.

Phrases come in three rounds: words, pairs of frequent words, and longer phrases all of whose pairs are
frequent, as no part of a frequent phrase is rarer than it. Only fingerprints that are frequent travel back;
a phrase that is in every block is one entry of each, so no key is hot. Fingerprints that collide would
merge two phrases: for n distinct phrases a chance of n^2 / 2^65.

Scores, the lowest cut of a phrase, dropped parts of longer phrases and the ranks are DataFrame steps over
the candidates and their parts. Products are decimals of 38 digits, so arithmetic is exact.

Defined results: a null or empty text has no words; a null language is ``und``; a text of one word has no
phrases; repeated rows count as often as they are there; a word of any length is one word; ties of score and
count are ordered by the phrase's bytes; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lake_ingest.llm.blocks import Rolling, as_blocks, batch, mixed, text_bytes, unpack
from lake_ingest.llm.shared import saved

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
NO_LANGUAGE = "und"
# Signs that end a piece, and those between the words of one.
BREAKS = b".,;:!?\n\x0b\x0c\r"
SPACES = b" \t"
# Bytes of text counted together; a bigger block repeats fewer phrases and takes more memory.
BLOCK_BYTES = 8 << 20
# Blocks whose counts make up one hash partition, so that its lists take some tens of megabytes.
BLOCKS_A_PARTITION = 8
SALTS = 32
ROUNDS = ((1,), (2,), (3, 4, 5))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = 3


class Words:
    """The words of a block of rows ``(lang, text)``, and fingerprints of their phrases."""

    def __init__(self, rows: pa.Table):
        data, offsets = text_bytes(rows["text"])
        self.data = np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data).astype(np.uint8)
        kind = np.zeros(256, np.uint8)
        kind[list(SPACES)], kind[list(BREAKS)] = 1, 2
        kind = kind[self.data]
        inside = kind == 0
        fresh = np.ones(len(data) + 1, bool)
        fresh[1:-1] = ~inside[:-1]
        fresh[offsets] = True
        self.starts = np.flatnonzero(inside & fresh[:-1])
        closing = ~np.append(inside, False)[1:] | fresh[1:]
        self.ends = np.flatnonzero(inside & closing) + 1
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        # Breaks and documents are counted on, so two words are of one piece if both numbers are equal.
        self.piece = np.cumsum(kind == 2)[self.starts] + self.doc if len(self.starts) else np.zeros(0, np.int64)
        self.langs = rows["lang"].combine_chunks().dictionary_encode()
        if isinstance(self.langs, pa.ChunkedArray):
            self.langs = self.langs.combine_chunks()
        self.lang = np.asarray(self.langs.indices)[self.doc]
        names, places = text_bytes(self.langs.dictionary)
        prints = Rolling(11).of(names, places[:-1], places[1:])
        word = Rolling(12).of(self.data, self.starts, self.ends)
        self.word = mixed(word + prints[self.lang] * _STEP) if len(word) else word

    def prints(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint of the phrase from each word on, and whether it lies in one piece."""
        n = len(self.word)
        out, whole = self.word.copy(), np.zeros(n, bool)
        for k in range(1, length):
            out[: n - k] = mixed(out[: n - k] * _STEP + self.word[k:])
        whole[: max(n - length + 1, 0)] = self.piece[length - 1 :] == self.piece[: max(n - length + 1, 0)]
        return out, whole

    def totals(self) -> dict[str, int]:
        """Number of words of each language."""
        names = self.langs.dictionary.to_pylist()
        return {names[i]: int(n) for i, n in enumerate(np.bincount(self.lang, minlength=len(names))) if n}

    def phrase(self, at: int, length: int) -> str:
        words = (self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(at, at + length))
        return b" ".join(words).decode()


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def candidates(words: Words, lengths: Iterable[int], frequent: np.ndarray) -> Iterable[tuple[int, np.ndarray, np.ndarray]]:
    """Of each length the places and fingerprints of the phrases that may be frequent.

    A phrase of two words may be if both are in ``frequent``, a longer one if all its pairs are.
    """
    for length in lengths:
        prints, open_ = words.prints(length)
        if length > 1:
            part = min(length - 1, 2)
            known, whole = words.prints(part)
            known = whole & _among(known, frequent)
            for k in range(length - part + 1):
                open_[: len(known) - k] &= known[k:]
        at = np.flatnonzero(open_)
        yield length, at, prints[at]


def _planes(values: np.ndarray) -> bytes:
    """The values' bytes, all first ones before all second ones, which compress better."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _values(content: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(content, np.uint8).reshape(size, -1).T).view(kind).ravel()


def squeezed(prints: np.ndarray, counts: np.ndarray) -> bytes:
    """Compressed ascending fingerprints, as differences, with their counts."""
    steps = np.diff(prints, prepend=np.uint64(0))
    return zstandard.compress(_planes(steps) + _planes(counts.astype(np.int64)), _LEVEL)


def opened(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    content = zstandard.decompress(payload)
    half = len(content) // 2
    return np.cumsum(_values(content[:half], np.uint64), dtype=np.uint64), _values(content[half:], np.int64)


def _summed(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints, ascending, and the sums of their counts."""
    if not len(prints):
        return prints, counts
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.append(True, prints[1:] != prints[:-1]))
    return prints[first], np.add.reduceat(counts, first)


class Summary:
    """A mergeable Misra-Gries summary: at most ``capacity`` counters, none too low by mass / capacity or more."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.prints, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, prints: np.ndarray, counts: np.ndarray) -> None:
        self.prints, self.counts = _summed(
            np.concatenate([self.prints, prints]), np.concatenate([self.counts, counts])
        )
        if len(self.counts) > self.capacity:
            # The highest count that has no counter is taken from all: at most `capacity` stay above none.
            place = len(self.counts) - self.capacity - 1
            least = np.partition(self.counts, place)[place]
            kept = self.counts > least
            self.prints, self.counts = self.prints[kept], self.counts[kept] - least


def survivors(lists: list[bytes], min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints that come ``min_count`` times or more in all lists together, ascending, and how often."""
    mass = sum(int(opened(p)[1].sum()) for p in lists)
    summary = Summary(mass // min_count + 1)
    waiting, held = [], 0
    for place, payload in enumerate(lists):
        waiting.append(opened(payload))
        held += len(waiting[-1][0])
        if held >= summary.capacity or place + 1 == len(lists):
            summary.merge(*(np.concatenate(parts) for parts in zip(*waiting)))
            waiting, held = [], 0
    exact = np.zeros(len(summary.prints), np.int64)
    if len(exact):
        for payload in lists:
            prints, counts = opened(payload)
            at = np.minimum(np.searchsorted(summary.prints, prints), len(exact) - 1)
            hit = summary.prints[at] == prints
            exact[at[hit]] += counts[hit]
    frequent = exact >= min_count
    return summary.prints[frequent], exact[frequent]


LISTS = "partition long, block long, payload binary"
ANSWERS = "block long, frequent binary, named binary"


def _dealt(block: int, prints: np.ndarray, partitions: int) -> pa.RecordBatch:
    """A block's distinct fingerprints with their counts, cut into the partitions' ranges."""
    distinct, counts = np.unique(prints, return_counts=True)
    share = (distinct >> np.uint64(32)) * np.uint64(partitions) >> np.uint64(32)
    cuts = np.searchsorted(share, np.arange(partitions + 1, dtype=np.uint64))
    held = [p for p in range(partitions) if cuts[p] < cuts[p + 1]]
    return batch(
        partition=pa.array(held, pa.int64()),
        block=pa.array([block] * len(held), pa.int64()),
        payload=pa.array(
            [squeezed(distinct[cuts[p] : cuts[p + 1]], counts[cuts[p] : cuts[p + 1]]) for p in held], pa.binary()
        ),
    )


def answers(lists: list[bytes], min_count: int) -> tuple[list[bytes], list[bytes]]:
    """Of a partition's lists the frequent fingerprints, and those among them that the list has to name.

    The latter come with the exact count of all lists; each frequent one is named by the first list that holds it.
    """
    frequent, exact = survivors(lists, min_count)
    waiting, told, named = np.ones(len(frequent), bool), [], []
    for payload in lists:
        prints, _ = opened(payload)
        here = np.searchsorted(frequent, prints[_among(prints, frequent)])
        told.append(squeezed(frequent[here], np.zeros(len(here))))
        first = here[waiting[here]]
        waiting[first] = False
        named.append(squeezed(frequent[first], exact[first]))
    return told, named


def _told(rows: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    """All fingerprints that a block was told, ascending, and their counts."""
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)), *map(opened, rows[column].to_pylist())]
    return _summed(*(np.concatenate(parts) for parts in zip(*found)))


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(lang, length, phrase, n)`` of all frequent words and phrases; of length 0 numbers of words to be added up."""
    chosen = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col(text).cast("string").alias("text"),
    )
    blocks = as_blocks(chosen, "phrases", block_bytes)
    partitions = max(1, -(-blocks.count() // BLOCKS_A_PARTITION))

    def lists(lengths):
        def of(block: pa.Table, told: pa.Table) -> pa.Table:
            words = Words(unpack(block["payload"][0].as_buffer()))
            found = [prints for _, _, prints in candidates(words, lengths, _told(told, "frequent")[0])]
            return pa.Table.from_batches([_dealt(block["block"][0].as_py(), np.concatenate(found), partitions)])

        return of

    def answer(rows: pa.Table) -> pa.Table:
        frequent, named = answers(rows["payload"].to_pylist(), min_count)
        columns = (pa.array(frequent, pa.binary()), pa.array(named, pa.binary()))
        return pa.table([rows["block"], *columns], names=["block", "frequent", "named"])

    def written(block: pa.Table, told: pa.Table) -> pa.Table:
        words, (wanted, counts) = Words(unpack(block["payload"][0].as_buffer())), _told(told, "named")
        names = words.langs.dictionary.to_pylist()
        rows = [(name, 0, "", n) for name, n in words.totals().items()]
        for length in range(1, LONGEST + 1):
            prints, whole = words.prints(length)
            at = np.flatnonzero(whole & _among(prints, wanted))
            found, first = np.unique(prints[at], return_index=True)
            n = counts[np.searchsorted(wanted, found)]
            rows += [(names[words.lang[i]], length, words.phrase(i, length), int(m)) for i, m in zip(at[first], n)]
        columns = list(zip(*rows)) or [[], [], [], []]
        types = (pa.string(), pa.int32(), pa.string(), pa.int64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "length", "phrase", "n"])

    def met(told: DataFrame, column: str, step, schema: str) -> DataFrame:
        wanted = told.select("block", column)
        return blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(step, schema)

    # A round needs the frequent phrases of the round before it, the naming what it has to name of all.
    rounds = [docs.sparkSession.createDataFrame([], ANSWERS)]
    for lengths in ROUNDS:
        counted = met(rounds[-1], "frequent", lists(lengths), LISTS)
        rounds.append(saved(counted.groupBy("partition").applyInArrow(answer, ANSWERS), "frequent"))
    told = reduce(DataFrame.unionByName, rounds)
    return saved(met(told, "named", written, "lang string, length int, phrase string, n long"), "phrases")


def scored(counts: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``(lang, phrase, length, a, l, r, n, score)`` of every candidate, by its lowest-scoring cut."""
    parts = counts.where("length > 0").select("lang", "phrase", F.col("n").alias("f"))
    # A language may hold most phrases, so its total is dealt out with them.
    totals = (
        counts.where("length = 0")
        .groupBy("lang")
        .agg(F.sum("n").alias("n"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    cuts = (
        counts.where((F.col("length") > 1) & (F.col("n") >= min_count))
        .select("lang", "phrase", "length", F.col("n").alias("a"), F.split("phrase", " ").alias("_w"))
        .withColumn("k", F.explode(F.expr("sequence(1, length - 1)")))
        .withColumns(
            {
                "first": F.expr("array_join(slice(_w, 1, k), ' ')"),
                "rest": F.expr("array_join(slice(_w, k + 1, length - k), ' ')"),
            }
        )
        .drop("_w")
    )
    lefts = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    exact = "(1000 * CAST(a AS decimal(19,0)) * CAST(n AS decimal(19,0))) div (CAST(l AS decimal(19,0)) * CAST(r AS decimal(19,0)))"
    valued = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"])
    valued = valued.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).join(totals, ["lang", "_salt"])
    return (
        valued.withColumn("score", F.expr(exact))
        .groupBy("lang", "phrase", "length", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("_cut"))
        .select("lang", "phrase", "length", "a", "_cut.l", "_cut.r", "n", "_cut.score")
    )


def maximal(candidates: DataFrame) -> DataFrame:
    """The candidates that are no part of a longer one that is as frequent."""
    inside = (
        candidates.where("length > 2")
        .select("lang", "length", F.col("a").alias("_whole"), F.split("phrase", " ").alias("_w"))
        .withColumn("_size", F.explode(F.expr("sequence(2, length - 1)")))
        .withColumn("_at", F.explode(F.expr("sequence(1, length - _size + 1)")))
        .select("lang", F.expr("array_join(slice(_w, _at, _size), ' ')").alias("phrase"), "_whole")
        .groupBy("lang", "phrase")
        .agg(F.max("_whole").alias("_whole"))
    )
    return candidates.join(inside, ["lang", "phrase"], "left").where("_whole IS NULL OR _whole < a").drop("_whole")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's first ``top`` phrases."""
    found = saved(scored(phrase_counts(docs, text, lang, min_count, block_bytes), min_count), "scored")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = maximal(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
