import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lake_ingest.llm import toxicity
from tests.llm.helpers import documents

RUDE = ["blockhead", "dimwit", "vermin"]


def _corpus(n=900):
    random.seed(4)
    syllables = ["the", "ing", "an", "ond", "er", "ti", "hal", "mor", "se", "ba"]
    words = ["".join(random.choice(syllables) for _ in range(random.randint(1, 3))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        text = random.choices(words, k=random.randint(20, 120))
        if toxic := int(i % 6 == 0):
            for _ in range(4):
                text.insert(random.randrange(len(text)), random.choice(RUDE))
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, 1, toxic))
    return rows, labels


def test_held_out_rows(spark):
    rows, labels = _corpus()
    rows += [(5000, None, None, None), (5001, "", None, None), (5002, "word " * 30000, None, None), rows[1]]
    docs = documents(spark, rows)
    table = spark.createDataFrame(labels + [(7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, table).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    scores = {r.doc_id: r.score for r in got}
    assert scores[5000] == scores[5001] < 0.5


def test_held_out_labels_are_not_used(spark):
    rows, labels = _corpus(400)
    docs = documents(spark, rows)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    one, two = (
        sorted(map(tuple, toxicity.score(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()))
        for x in (labels, turned)
    )
    assert one == two


def test_windows():
    import pyarrow as pa

    data, starts, ends, first = toxicity.windows_of(pa.array(["A b\tc D e f g", None, "", " \n", "x"]))
    held = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert held == [b" a b c d e f", b" g", b" x"] and first.tolist() == [0, 2, 2, 2, 2, 3]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)]])
def test_without_labels_of_both_kinds(spark, labels):
    docs = documents(spark, [(1, "a b", None, None), (2, "c", None, None)])
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert [r.predicted for r in toxicity.score(docs, table).collect()] == [0, 0]
    assert toxicity.score(docs.limit(0), table.withColumn("text", F.lit(1))).count() == 0


def test_figures_by_brute_force():
    """Savings are differences of single compressed windows; figures are what a plain loop finds in them."""
    import math

    import pyarrow as pa

    contents = (b" and the other of" + b" " * 9, b" and the other of blockhead"[:26])
    pair = tuple(map(toxicity._compressor, contents))
    texts = ["the other of all and the end of a blockhead said he", "plain words", None, "blockhead " * 30]
    data, starts, ends, first = toxicity.windows_of(pa.array(texts))
    gains = toxicity.savings(data, starts, ends, pair)
    doubled = [bytes(b for c in data[a:z].tobytes() for b in (c, c)) for a, z in zip(starts, ends)]
    assert gains.tolist() == [len(pair[0].compress(w)) - len(pair[1].compress(w)) for w in doubled]
    got = toxicity.figures(gains, first)
    for i in range(len(texts)):
        mine = gains[first[i] : first[i + 1]].tolist()
        top = sorted((max(g, 0) for g in mine), reverse=True)
        want = [1, top[0] if top else 0, sum(top[:3]) / 3]
        want += [math.log1p(sum(g >= least for g in mine)) for least in toxicity.HITS] + [math.log1p(len(mine))]
        assert got[i].tolist() == pytest.approx(want)


def test_typical_strings_by_brute_force(spark):
    import math
    from collections import Counter

    rows, labels = _corpus(300)
    sides = [[t for (_, t, _, _), (_, _, x) in zip(rows, labels) if x == kind] for kind in (1, 0)]
    counts = [Counter(), Counter()]
    for count, texts in zip(counts, sides):
        for text in texts:
            for word in set(text.split()):
                held = " " + word
                count.update({held[i : i + n] for n in range(4, 13) for i in range(len(held) - n + 1)})
    scores = {}
    for string, n in counts[0].items():
        odds = math.log((n + 0.5) / len(sides[0])) - math.log((counts[1][string] + 0.5) / len(sides[1]))
        if n >= max(3, len(sides[0]) // 100) and odds > 3:
            scores[string] = n * odds * math.sqrt(len(string))
    best = min(scores, key=lambda s: (-scores[s], s))
    table = spark.createDataFrame([(t, k) for k, side in ((1, sides[0]), (0, sides[1])) for t in side], "text string, toxic int")
    found = toxicity.typical_strings(table, len(sides[0]), len(sides[1]))
    assert found[0] == best.encode() and len(found) <= toxicity.STRINGS
    assert {s.decode() for s in found} <= set(scores)
    assert all(any(s.decode() in f" {w}" for s in found) for w in RUDE)


def test_very_long_labelled_texts(spark):
    """A few labelled texts of megabytes, one of them a single word, and one repeated many times."""
    rows, labels = _corpus(300)
    rows += [(900, "w" * 2_000_000, "en", "s"), (901, "some words here " * 100_000, "en", "s")] + [rows[0]] * 50
    labels += [(900, 1, 1), (901, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.score(documents(spark, rows), table).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
