"""Toxicity by compression distance: windows of text against dictionaries of toxic and ordinary text.

The ordinary dictionary is trained by zstandard on windows of ordinary texts. The toxic one has the same
content, followed by the strings within words that are typical of toxic texts: frequent there and rare
elsewhere. At most ``STRINGS`` are taken, each in at least 1% (and 3) of the sampled toxic texts: toxic
words beyond these score as ordinary. Both have the same length, so that ordinary text compresses to the
same size with either, and a window that is shorter with the toxic dictionary holds toxic strings. Bytes are doubled first: a
literal then costs twice as much and a match no more, which makes one word in a window tell. A text's
windows give a few figures, which a logistic curve, fitted on labelled texts that the dictionaries have
not seen, turns into a probability.

Only labelled rows outside the held-out fifth are learned from, a bounded sample of them: about
``FIT_TOXIC`` toxic and ``FIT_ORDINARY`` ordinary texts, those with the least hashes of the id. Spark counts
their strings and measures the calibrating texts; one task trains the ordinary dictionary, on ``TRAIN_BYTES``
of windows however long the texts are, and the driver fits the curve to nine figures of each calibrating text.
Scoring reads every text whole, in tasks of its own, and shuffles nothing.

Defined results: a null or empty text has no windows and the score of a text without toxic strings;
without labels of both kinds the score is the share of toxic labels, or 0 without any; a text labelled
twice is learned from under each label; repeated rows get equal scores; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lake_ingest.llm.blocks import Rolling, batch, slices_of, text_bytes
from lake_ingest.llm.shared import WORD, saved

FIT_TOXIC = 2000
FIT_ORDINARY = 4000
FOLDS = 5
# A toxic text that is missed counts as much as so many others that are flagged.
TOXIC_WEIGHT = 2.0
WINDOW = 6
DICTIONARY_BYTES = 32768
STRINGS = 80
# Lengths in bytes of the strings that may be typical, the space before a word included.
SHORTEST, LONGEST = 4, 12
# A window is a hit of a size if the toxic dictionary saves so many bytes.
HITS = (2, 3, 4, 6, 8)
FIGURES = 3 + len(HITS)
# Bytes of windows that the ordinary dictionary is trained on.
TRAIN_BYTES = 4 << 20
# Strings among which the typical ones are picked, and characters of a word that are looked at together.
CANDIDATES = 8192
PIECE = 64


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == 0


def windows_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, starts and ends of the windows, and where each text's windows start.

    A window is ``WINDOW`` words on end with the space before them.
    """
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    spaced = pc.binary_join_element_wise(
        pa.scalar(" ", pa.large_string()), lower, pa.scalar("", pa.large_string())
    )
    data, offsets = text_bytes(spaced)
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    data = np.where(space, np.uint8(0x20), data)
    begins = np.flatnonzero(space[:-1] & ~space[1:]) if len(data) else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, begins, "right") - 1
    first = np.searchsorted(text, np.arange(len(offsets)))
    nth = np.arange(len(begins)) - first[text]
    starts = begins[nth % WINDOW == 0]
    text = text[nth % WINDOW == 0]
    ends = np.append(starts[1:], len(data))
    last = np.append(text[1:] != text[:-1], True)[: len(text)]
    ends = np.where(last, offsets[text + 1], ends)
    return data, starts, ends, np.searchsorted(text, np.arange(len(offsets)))


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=15, chain_log=17, search_log=6, min_match=6, target_length=64,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    doubled = np.repeat(np.frombuffer(content, np.uint8), 2).tobytes()
    dictionary = zstandard.ZstdCompressionDict(doubled, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def savings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, pair: tuple) -> np.ndarray:
    """Bytes that the toxic dictionary saves against the ordinary one, per window."""
    if not len(starts):
        return np.zeros(0)
    doubled = np.repeat(data, 2).tobytes()
    segments = np.column_stack([2 * starts, 2 * (ends - starts)]).astype(np.uint64).tobytes()
    buffer = zstandard.BufferWithSegments(doubled, segments)
    sizes = []
    for compressor in pair:
        packed = compressor.multi_compress_to_buffer(buffer, threads=1)
        sizes.append(np.fromiter((len(packed[i]) for i in range(len(packed))), np.int64, len(packed)))
    return (sizes[0] - sizes[1]).astype(np.float64)


def figures(saved_bytes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: most saved, the three most, hits of each size, number of windows; zeros without windows."""
    counts = np.diff(first)
    out = np.zeros((len(counts), FIGURES))
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((-saved_bytes, text))
    rank = np.arange(len(order)) - first[text[order]]
    gain = np.maximum(saved_bytes[order], 0)
    out[text[order][rank == 0], 0] = gain[rank == 0]
    np.add.at(out[:, 1], text[order][rank < 3], gain[rank < 3] / 3)
    for column, least in enumerate(HITS, 2):
        hits = np.concatenate([[0], np.cumsum(saved_bytes >= least)])
        out[:, column] = np.log1p(hits[first[1:]] - hits[first[:-1]])
    out[:, -1] = np.log1p(counts)
    return np.column_stack([np.ones(len(out)), out])


def typical_strings(texts: DataFrame, n_toxic: int, n_ordinary: int) -> list[bytes]:
    """Strings within words that are frequent in toxic texts and rare in ordinary ones, best first.

    ``texts`` are ``(text, toxic)``. Words and strings are counted by Spark; the best ``CANDIDATES`` strings
    leave it, of which those go that hold or lie in a better one.
    """
    pieces = F.regexp_extract_all(F.lower("text"), F.lit(WORD[:-1] + f"{{1,{PIECE}}}"), F.lit(0))
    words = (
        texts.select("toxic", F.explode(F.array_distinct(pieces)).alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("n"), F.sum(1 - F.col("toxic")).alias("other"))
        .select(F.concat(F.lit(" "), "word").alias("word"), "n", "other")
        .where(F.length("word") >= SHORTEST)
    )
    inside = f"""array_distinct(flatten(transform(sequence({SHORTEST}, least(length(word), {LONGEST})),
        size -> transform(sequence(1, length(word) - size + 1), i -> substring(word, i, size)))))"""
    odds = F.log((F.col("n") + 0.5) / n_toxic) - F.log((F.col("other") + 0.5) / n_ordinary)
    found = (
        words.select("n", "other", F.explode(F.expr(inside)).alias("string"))
        .groupBy("string")
        .agg(F.sum("n").alias("n"), F.sum("other").alias("other"))
        .where((F.col("n") >= max(3, n_toxic // 100)) & (odds > 3))
        .orderBy(F.desc(F.col("n") * odds * F.sqrt(F.octet_length("string"))), "string")
        .limit(CANDIDATES)
    )
    chosen: list[bytes] = []
    for string in (r.string.encode() for r in found.collect()):
        if len(chosen) < STRINGS and not any(string in other or other in string for other in chosen):
            chosen.append(string)
    return chosen


def _windows(texts: DataFrame, least: int) -> DataFrame:
    """Windows of the texts whose fingerprint is at most ``least``."""

    def cut(batches):
        for rows in batches:
            for some in slices_of(rows, "text", 1 << 20):
                data, starts, ends, _ = windows_of(some["text"])
                kept = Rolling(3).of(data, starts, ends) <= np.uint64(least)
                held = [data[a:b].tobytes() for a, b in zip(starts[kept].tolist(), ends[kept].tolist())]
                yield batch(window=pa.array(held, pa.binary()))

    return texts.select("text").mapInArrow(cut, "window binary").distinct()


def _train(rows: pa.Table) -> pa.Table:
    samples = sorted(rows["window"].to_pylist())
    try:
        content = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        content = b"".join(samples)[-DICTIONARY_BYTES:]
    return pa.table({"content": pa.array([content], pa.binary())})


def dictionaries(texts: DataFrame, n_toxic: int, n_ordinary: int, ordinary_bytes: int) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary, of equal length.

    The ordinary one is trained on about ``TRAIN_BYTES`` of distinct windows, those with the least fingerprints.
    """
    least = min((1 << 64) - 1, (1 << 64) * TRAIN_BYTES // max(1, ordinary_bytes))
    samples = _windows(texts.where("toxic = 0"), least).select(F.lit(0).alias("all"), "window")
    content = samples.groupBy("all").applyInArrow(_train, "content binary").first()
    content = bytes(content.content) if content else b" "
    strings = b"".join(reversed(typical_strings(texts, n_toxic, n_ordinary)))
    return content + b" " * len(strings), content + strings


def measured(rows: DataFrame, carried: str, contents: tuple[bytes, bytes]) -> DataFrame:
    """``(carried, x)``: the figures of every row's text."""

    def of(batches):
        pair = tuple(map(_compressor, contents))
        for held in batches:
            for some in slices_of(held, "text", 1 << 20):
                data, starts, ends, first = windows_of(some["text"])
                x = figures(savings(data, starts, ends, pair), first)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel())
                )
                yield pa.RecordBatch.from_arrays([some[carried], lists], names=[carried, "x"])

    plain = rows.select(carried, "text")
    schema = T.StructType([plain.schema[carried], T.StructField("x", T.ArrayType(T.DoubleType()))])
    return plain.mapInArrow(of, schema)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression by Newton's steps."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, gradient)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model(NamedTuple):
    """Contents of the dictionaries, and weights of the figures."""

    contents: tuple[bytes, bytes]
    weights: list[float]


def fit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> Model:
    """The model, from a bounded sample of the labelled rows outside the held-out fold.

    A third of the sampled texts, by their hash, calibrates what the others taught.
    """
    usable = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(toxic).cast("int").alias("toxic"))
        .where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
        .distinct()
    )
    total = {r.toxic: r.n for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = total.get(1, 0) / max(1, sum(total.values()))
    least = {
        kind: -(1 << 63) + min((1 << 64) - 1, (1 << 64) * size // max(1, total.get(kind, 0)))
        for kind, size in ((1, FIT_TOXIC), (0, FIT_ORDINARY))
    }
    # Written first: Spark then sees how few they are, and does not shuffle the texts to find theirs.
    some = saved(
        usable.where(F.xxhash64("doc_id") <= F.when(F.col("toxic") == 1, least[1]).otherwise(least[0])), "labels"
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    held = saved(
        texts.join(some, "doc_id")
        .withColumn("print", F.md5("text"))
        .dropDuplicates(["print", "toxic"])
        .select("text", "toxic", (F.pmod(F.xxhash64("print"), F.lit(3)) == 0).alias("checks")),
        "labelled",
    )
    sizes = held.groupBy("toxic", "checks").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long")).alias("bytes")
    )
    n = {(r.toxic, r.checks): (r.n, r.bytes) for r in sizes.collect()}
    if len(n) < 4:
        prior = min(max(share, 1e-6), 1 - 1e-6)
        return Model((b" ", b" "), [math.log(prior / (1 - prior)) if total else -30.0] + [0.0] * FIGURES)
    contents = dictionaries(held.where("NOT checks"), n[1, False][0], *n[0, False])
    rows = measured(held.where("checks"), "toxic", contents).collect()
    # In one order, so that reruns add up alike.
    rows = sorted((r.toxic, r.x) for r in rows)
    x, y = np.array([x for _, x in rows]), np.array([t for t, _ in rows], bool)
    weight = np.where(y, TOXIC_WEIGHT * share / y.mean(), (1 - share) / (1 - y.mean()))
    return Model(contents, logistic(x, y.astype(float), weight).tolist())


def score(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    model = fit(docs, labels, doc_id, text, toxic)
    plain = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    z = "aggregate(zip_with(x, weights, (a, b) -> a * b), 0D, (s, v) -> s + v)"
    weighed = measured(plain, "doc_id", model.contents).withColumn("weights", F.array(*map(F.lit, model.weights)))
    score_ = F.expr(f"1 / (1 + exp(-least(30D, greatest(-30D, {z}))))")
    return weighed.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        score_.alias("score"),
        (score_ >= 0.5).cast("int").alias("predicted"),
    )
