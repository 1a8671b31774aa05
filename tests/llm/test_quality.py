import math
import random
import re
from collections import Counter

import pytest

from lake_ingest.llm import quality
from tests.conftest import SF_DIR
from tests.llm.helpers import documents, found

BASE = ("doc_id", "n_words", *quality.COUNTS, "base_failed")


def _base(doc_id, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, repeated = Counter(windows), set()
    for i, window in enumerate(windows):
        if counts[window] > 1:
            repeated |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, again = len(words), len(repeated)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (doc_id, n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), again, n < 50 or 100 * again > 50 * n)


def test_base_counts(spark):
    random.seed(2)
    texts = [None, "", " \n\t ", "a b c a b c", "a b c\n" * 60, "x y\n\nx y\n \x0b\nx  y", "😀 é ## |"]
    texts += [" ".join(random.choice("abcdefgh") for _ in range(random.randint(1, 300))) for _ in range(60)]
    texts += ["w%d " % 1 + " ".join(f"w{i}" for i in range(30000))]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(3, texts[3], None, None), (None, "q", None, None)]
    assert found(quality.judge(documents(spark, rows)), *BASE) == sorted((_base(i, t) for i, t, _, _ in rows), key=repr)


def _jsd(p, q):
    p, q = ([x / sum(h) for x in h] for h in (p, q))
    return math.sqrt(
        sum((a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0) for a, b in zip(p, q)) / 2
    )


@pytest.mark.parametrize(("p", "q"), [([1, 2, 3], [3, 2, 1]), ([5, 0, 1], [0, 7, 1]), ([4, 4], [1, 1])])
def test_distance(spark, p, q):
    share = ", ".join(f"{x / sum(q)}D" for x in q)
    counts = ", ".join(f"{x}L" for x in p)
    sql = quality.distance(f"array({counts})", f"{sum(p)}L", f"array({share})")
    assert spark.sql(f"SELECT {sql} AS d").first().d == pytest.approx(_jsd(p, q), abs=1e-9)


def test_verdicts_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.collect()
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text) for r in rows}
    per_lang = {}
    for r in rows:
        per_lang.setdefault(r.lang, Counter()).update(words[r.doc_id])
    share = Counter()
    for counts in per_lang.values():
        for word, n in counts.items():
            share[word] += n / counts.total()
    common = sorted(share, key=lambda w: (-round(share[w], 9), w.encode()))[: quality.COMMON_WORDS]

    def classes(r):
        body = "".join(words[r.doc_id])
        upper = sum(c.isupper() and c.isalpha() for c in body)
        digits, symbols = len(re.findall("[0-9]", body)), len(re.findall(r"[#*$%&|<>]", body))
        marks = len(re.findall(r"[!-/:-@\[-`{-~]", body))
        return [upper, digits, symbols, marks - symbols, len(r.text) - len(body), len(body) - upper - digits - marks]

    sums = {g: [sum(x) for x in zip(*(classes(r) for r in rows if r.lang == g))] for g in per_lang}
    known = [g for g in per_lang if per_lang[g].total() >= quality.MIN_LANGUAGE_WORDS]
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    compared = 0
    for r in rows:
        mine, counts = got[r.doc_id], Counter(words[r.doc_id])
        if mine.base_failed or r.lang not in known:
            assert mine.char_distance is None and mine.kept == (not mine.base_failed)
            continue
        histogram = [counts[w] for w in common]
        chars = min(_jsd(classes(r), sums[g]) for g in known)
        assert mine.char_distance == pytest.approx(chars, abs=1e-6)
        kept = chars <= quality.MAX_CHAR_DISTANCE
        if sum(histogram) >= quality.MIN_COMMON:
            distance = min(_jsd(histogram, [per_lang[g][w] for w in common]) for g in known)
            assert mine.word_distance == pytest.approx(distance, abs=1e-6)
            kept, compared = kept and distance <= quality.MAX_WORD_DISTANCE, compared + 1
        assert mine.kept == kept
    assert compared > 50


def test_labelled_documents(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = quality.judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(labels, "doc_id")
    good = judged.where("quality = 1 AND NOT base_failed")
    assert good.where("kept").count() >= 0.995 * good.count()
    assert judged.where("quality = 0 AND kept").count() <= 0.1 * judged.where("quality = 0").count()


def test_kept_documents_and_empty(spark):
    docs = documents(spark, [(1, " ".join(f"w{i}" for i in range(60)), None, "s"), (2, None, "xx", None), (2, None, "xx", None)])
    kept = quality.kept_documents(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
    assert quality.judge(docs.limit(0)).count() == 0


def _language(name, texts, rng, count=400):
    """Texts in an invented language, whose words no other has."""
    words = [f"{name}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)]
    return [" ".join(rng.choices(words, [1 / (i + 1) for i in range(40)], k=count)) for _ in range(texts)]


def test_rare_labels_are_compared(spark):
    rng = random.Random(3)
    noise = [" ".join("".join(rng.choice("#$%&|<>;:!?0123456789ABCDEF") for _ in range(7)) for _ in range(120)) for _ in range(3)]
    prose = [(t, "en") for t in _language("en", 30, rng)]
    small = [(t, "nl") for t in _language("nl", 5, rng)]
    rows = [*prose, (noise[0], "en"), (noise[1], "eng-misspelt"), (noise[2], None), *small, (prose[0][0], "xx")]
    got = {r.doc_id: r for r in quality.judge(documents(spark, [(i, t, g, "s") for i, (t, g) in enumerate(rows)])).collect()}
    assert all(r.char_distance is not None for r in got.values() if not r.base_failed)
    assert [got[i].kept for i in (30, 31, 32)] == [False] * 3
    assert all(got[i].kept for i in got if i not in (30, 31, 32))


def test_no_language_is_large(spark):
    rng = random.Random(4)
    noise = " ".join("".join(rng.choice("#$%&|<>;:!?0123456789ABCDEF") for _ in range(7)) for _ in range(60))
    rows = [(i, t, "en", "s") for i, t in enumerate(_language("en", 10, rng))] + [(10, noise, "zz", "s")]
    assert [r.kept for r in sorted(quality.judge(documents(spark, rows)).collect())] == [True] * 10 + [False]


def test_every_language_has_common_words(spark):
    rng = random.Random(5)
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(70)]
    texts = [(t, g) for g in names for t in _language(g, 13, rng)]
    # The words of one language evenly: unlike any language in its word shares alone.
    salad = sorted(set(texts[0][0].split())) * 8
    rng.shuffle(salad)
    rows = [(i, t, g, "s") for i, (t, g) in enumerate(texts)] + [(-1, " ".join(salad), "aa", "s")]
    docs = documents(spark, rows)
    common = quality.common_words(quality.language_words(docs, "text", "lang"))
    assert common.count() >= 70 * quality.LANGUAGE_WORDS
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(r.word_distance is not None for r in got.values() if not r.base_failed)
    assert all(r.kept for i, r in got.items() if i >= 0 and not r.base_failed)
    assert not got[-1].base_failed and got[-1].word_distance > max(r.word_distance or 0 for i, r in got.items() if i >= 0)


def test_two_thousand_labels(spark):
    """No label is major: each text is compared with its own label's reference and with the corpus."""
    rng = random.Random(6)
    prose = _language("en", 2000, rng, count=60)
    noise = " ".join("".join(rng.choice("#$%&|<>;:!?0123456789ABCDEF") for _ in range(7)) for _ in range(60))
    rows = [(i, t, f"label {i}", "s") for i, t in enumerate(prose)] + [(-1, noise, "label -1", "s"), (-2, noise, None, "s")]
    got = {r.doc_id: r for r in quality.judge(documents(spark, rows)).collect()}
    assert all(r.char_distance is not None and r.word_distance is not None for i, r in got.items() if i >= 0 and not r.base_failed)
    assert all(r.kept for i, r in got.items() if i >= 0 and not r.base_failed)
    assert [got[i].kept for i in (-1, -2)] == [False] * 2


def test_no_text_has_a_language(spark):
    text = " ".join(f"w{i}" for i in range(60))
    (row,) = quality.judge(documents(spark, [(1, text, None, "s")])).collect()
    assert (row.char_distance, row.word_distance, row.kept) == (None, None, True)
