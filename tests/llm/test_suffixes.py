import hashlib
import random
from collections import Counter

import pytest

from lake_ingest.llm import queries, suffixes
from tests.conftest import SF_DIR
from tests.llm.helpers import documents


def _expected(texts, match):
    held = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + match] for b in held for i in range(len(b) - match + 1))
    out = []
    for b in held:
        gone = bytearray(len(b))
        for i in range(len(b) - match + 1):
            if counts[b[i : i + match]] > 1:
                gone[i : i + match] = b"\1" * match
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        left = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


def _check(spark, rows, match, cover, block_bytes):
    docs = documents(spark, [(i, t, None, None) for i, t in rows])
    found = suffixes.repeated_spans(docs, match=match, cover=cover, block_bytes=block_bytes)
    got = sorted(map(tuple, suffixes.digest(docs, found).collect()), key=repr)
    want = [(i, *e) for (i, _), e in zip(rows, _expected([t for _, t in rows], match))]
    assert got == sorted(want, key=repr)


def _odd(match):
    random.seed(1)
    p = "".join(random.choice("abcdé ") for _ in range(3 * match))
    texts = [None, "", "z" * (match + 5), "z" * match, "y" * match, p + "x" + p[5:] + "qq" + p[:match]]
    texts += ["é" * match, p, p, p[: match + 3], p[: match - 1], "ab" * match, p[7:] + "end"]
    return [(i - 100, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("match", "cover", "block_bytes"), [(400, 2, 1 << 20), (400, 3, 3000), (100, 1, 500)])
def test_odd_texts(spark, match, cover, block_bytes):
    _check(spark, _odd(match), match, cover, block_bytes)


def test_documents(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(120).collect()
    _check(spark, [tuple(r) for r in rows] + _odd(400), 400, 2, 50_000)


@pytest.mark.parametrize("size", range(6))
def test_every_distance_is_covered(size):
    period, places = suffixes.difference_cover(size)
    assert {(a - b) % period for a in places for b in places} == set(range(period))


def test_kept_bytes(spark):
    df = spark.sql(
        "SELECT CAST('0123456789' AS binary) AS c, "
        "array(named_struct('start', 0, 'end', 2), named_struct('start', 5, 'end', 9)) AS s"
    )
    assert bytes(df.select(suffixes.kept_bytes("c", "s")).first()[0]) == b"2349"


def test_kept_bytes_of_many_spans_and_cut_characters(spark):
    content = ("aé" * 50_000).encode()
    spans = [(i, i + 2) for i in range(1, len(content) - 2, 5)]
    df = spark.createDataFrame([(content, spans), (b"", []), (b"ab", [(0, 2)])], "c binary, s array<struct<start:int,end:int>>")
    got = [bytes(r[0]) for r in df.select(suffixes.kept_bytes("c", "s")).collect()]
    left = bytearray(content)
    for a, b in reversed(spans):
        del left[a:b]
    assert got == [bytes(left), b"", b""]


def _letters(seed, n):
    r = random.Random(seed)
    return "".join(r.choice("abcdefghij ") for _ in range(n))


def test_kept_text(spark, tmp_path):
    """The query tells what is left: planted passages of over 50 words and 400 bytes are gone, other texts are whole."""
    passage = " ".join(_letters(k, 40).replace(" ", "x")[: 6 + k % 4] for k in range(60))
    assert len(passage.encode()) > 400 and len(passage.split()) == 60
    short = passage[:399]
    texts = {
        1: _letters(1, 700) + "<" + passage + ">" + _letters(2, 300),
        2: _letters(3, 90) + "[" + passage + "]" + _letters(4, 500),
        3: _letters(5, 900),
        4: "é" + short + "!",
        5: None,
        6: "",
        7: _letters(6, 500),
        8: _letters(6, 500),
        9: "(" + passage[200:] + passage[:100] + ")",
    }
    documents(spark, [(i, t, None, None) for i, t in texts.items()]).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op4_suffix_dedup"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    got = {r["doc_id"]: r for r in found.collect()}
    left = {i: t or "" for i, t in texts.items()} | {7: "", 8: ""}
    left |= {i: texts[i].replace(passage, "") for i in (1, 2)}
    assert {i: r["text"] for i, r in got.items()} == left
    assert all(r["kept_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() for r in got.values())
    assert all(r["n_removed"] == r["n_bytes"] - len(r["text"].encode()) for r in got.values())


def test_kept_text_with_cut_characters(spark):
    """Where a removed string begins or ends within a character, the digest is of the bytes, the text stays readable."""
    # \xc3\xa9 and \xc4\xa9 share their last byte.
    rows = [(1, "é" + "z" * 30 + "A"), (2, "ĩ" + "z" * 30 + "B")]
    docs = documents(spark, [(i, t, None, None) for i, t in rows])
    found = suffixes.repeated_spans(docs, match=31, cover=0, block_bytes=500)
    got = {r["doc_id"]: r for r in suffixes.digest(docs, found, kept="left").collect()}
    assert [got[i]["left"] for i in (1, 2)] == ["\ufffdA", "\ufffdB"]
    assert got[1]["kept_sha256"] == hashlib.sha256(b"\xc3A").hexdigest()


def test_empty(spark):
    docs = documents(spark, [])
    assert suffixes.digest(docs, suffixes.repeated_spans(docs)).count() == 0
