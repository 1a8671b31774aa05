import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lake_ingest.llm import collocations as C
from tests.llm.helpers import documents

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute_force(rows, min_count, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, 6):
                counts.update((lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    chosen = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    longer = defaultdict(int)
    for (lang, w), a in chosen.items():
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                longer[lang, w[i : i + n]] = max(longer[lang, w[i : i + n]], a)
    out = defaultdict(list)
    for (lang, w), a in chosen.items():
        if longer[lang, w] >= a:
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = counts[lang, w[:k]], counts[lang, w[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)
    )


def _texts(seed, n):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "x1", "new york", "new york city", "a  b", "z\t\tq", "ﬁ", "漢字", "-"]
    signs = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "; ", "\x0b", "\xa0", "!?"]
    return ["".join(rng.choice(vocabulary) + rng.choice(signs) for _ in range(rng.randint(0, 120))) for _ in range(n)]


@pytest.mark.parametrize("min_count, top, block_bytes", [(5, 2000, 1 << 12), (20, 7, 1 << 23)])
def test_as_brute_force(spark, min_count, top, block_bytes):
    texts = [*_texts(1, 200), None, "", " .,", "w" * 50000, "one", *["same same same same"] * 30]
    rng = random.Random(2)
    rows = [(t, rng.choice(["en", "en", "und", None, "fr"])) for t in texts]
    docs = documents(spark, [(i, t, g, "s") for i, (t, g) in enumerate(rows)])
    docs = docs.withColumns({name: F.lit("clash") for name in ("phrase", "n", "length", "rank")})
    got = C.collocations(docs, min_count=min_count, top=top, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got)) == _brute_force(rows, min_count, top)


def test_empty(spark):
    assert C.collocations(documents(spark, [])).count() == 0


def test_summaries_keep_what_reaches_the_threshold():
    rng = np.random.default_rng(5)
    for min_count in (2, 10, 50):
        heavy = np.repeat(rng.integers(0, 2**63, 20, dtype=np.uint64), min_count)
        values = np.concatenate([heavy, rng.integers(0, 2**63, 3000, dtype=np.uint64)])
        rng.shuffle(values)
        lists = []
        for part in np.array_split(values, 17):
            prints, counts = np.unique(part, return_counts=True)
            lists.append(C.squeezed(prints, counts))
        prints, counts = np.unique(values, return_counts=True)
        found, exact = C.survivors(lists, min_count)
        assert np.array_equal(found, prints[counts >= min_count]) and np.array_equal(exact, counts[counts >= min_count])
        told, named = C.answers(lists, min_count)
        once = np.sort(np.concatenate([C.opened(p)[0] for p in named]))
        assert np.array_equal(once, found) and len(told) == len(lists)
        summary = C.Summary(len(values) // min_count + 1)
        for payload in lists:
            summary.merge(*C.opened(payload))
        assert len(summary.prints) <= summary.capacity
        assert np.isin(prints[counts >= min_count], summary.prints).all()


def test_lists_are_read_back():
    prints, counts = np.array([1, 2, 2**64 - 1], np.uint64), np.array([3, 2**40, 1])
    back = C.opened(C.squeezed(prints, counts))
    assert np.array_equal(back[0], prints) and np.array_equal(back[1], counts)
    assert len(C.opened(C.squeezed(prints[:0], counts[:0]))[0]) == 0


def test_words_end_with_documents_and_pieces():
    words = C.Words(pa.table({"lang": ["a", "b", "a"], "text": ["Ab cd", "ef. g", None]}))
    spans = [words.data[s:e].tobytes() for s, e in zip(words.starts, words.ends)]
    assert spans == [b"ab", b"cd", b"ef", b"g"]
    assert words.prints(2)[1].tolist() == [True, False, False, False]


def test_products_beyond_64_bits(spark):
    big = 4_000_000_000_000
    rows = [("en", 2, "a b", big), ("en", 1, "a", big + 1), ("en", 1, "b", big + 2), ("en", 0, "", 90 * big)]
    got = C.scored(spark.createDataFrame(rows, "lang string, length int, phrase string, n long")).first()
    assert got.score == 1000 * big * 90 * big // ((big + 1) * (big + 2))
