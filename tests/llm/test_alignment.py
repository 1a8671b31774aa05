import hashlib
from collections import Counter, defaultdict

import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lake_ingest.llm import alignment, queries
from lake_ingest.llm.bpe import piece_table
from tests.conftest import SF_DIR
from tests.llm.helpers import documents

ODD = [
    None, "", " ", "x" * 30000, "▁x y", "<|endoftext|> a </s>", " " * 50000, "é😀\x00\n\n\t z", "a<0x41>", "漢字かな b",
]


def _tokens(text, byte_level, table, model):
    """Ids and bytes of both sides; none where a side does not give the text back."""
    if not text:
        return [], [], [], []
    a, b = byte_level.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    bytes_a = [table[i] for i in a]
    bytes_b = [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    whole = (" " + text).encode()
    return (a, bytes_a, b, bytes_b) if b"".join(bytes_a) == whole == b"".join(bytes_b) else ([], [], [], [])


def _brute_force(texts):
    byte_level = Tokenizer.from_file(alignment.BYTE_LEVEL)
    byte_level.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECES)
    table, out, counts = piece_table(alignment.BYTE_LEVEL), [], Counter()
    for doc_id, text in texts:
        a, bytes_a, b, bytes_b = _tokens(text, byte_level, table, model)
        owner = [j for j, piece in enumerate(bytes_b) for _ in piece]
        at, pairs, ends_a = 0, [], []
        for i, piece in enumerate(bytes_a):
            pairs += [(i, j) for j in sorted(set(owner[at : at + len(piece)]))]
            at += len(piece)
            ends_a.append(at)
        ends_b, at = [], 0
        for piece in bytes_b:
            at += len(piece)
            ends_b.append(at)
        cuts, groups, i, j = sorted(set(ends_a) & set(ends_b)), [], 0, 0
        for cut in cuts:
            i2, j2 = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
            groups.append((a[i:i2], b[j:j2]))
            i, j = i2, j2
        counts.update((a[i], b[j]) for i, j in pairs)
        out.append((doc_id, a, b, groups, pairs))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return out, counts, top


def test_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source").limit(60)
    docs = docs.unionByName(documents(spark, [(-1 - i, t, "en", "s") for i, t in enumerate(ODD)]).select(docs.columns))
    docs = docs.unionByName(docs.limit(5)).withColumns({"n_a": F.lit("clash"), "pair": F.lit(0)})
    aligned = alignment.align(docs, ["doc_id"], detail=True)
    got = aligned.select("*", *(c.alias(n) for n, c in alignment.digest().items())).collect()
    rows, counts, top = _brute_force([(r.doc_id, r.text) for r in docs.collect()])
    want = []
    for doc_id, a, b, groups, pairs in rows:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        found = [counts[a[i], b[j]] for i, j in pairs]
        best = [counts[a[i], b[j]] == top[b[j]] for i, j in pairs]
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        want.append((doc_id, len(a), len(b), len(groups), len(pairs), sum(best), sum(found), text, digest, a, b, pairs, found, best))
    held = [
        (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups, r.groups_sha256,
         r.a_ids, r.b_ids, list(zip(r.link_a, r.link_b)), r.link_count, r.link_best)
        for r in got
    ]
    assert sorted(held, key=repr) == sorted(want, key=repr)


def test_empty(spark):
    assert alignment.align(documents(spark, []), ["doc_id"]).count() == 0


def test_only_texts_without_tokens(spark):
    got = alignment.align(documents(spark, [(1, None, "en", "s"), (2, "▁", "en", "s")]), ["doc_id"]).collect()
    assert sorted((r.doc_id, r.n_a, r.n_links, r.groups) for r in got) == [(1, 0, 0, ""), (2, 0, 0, "")]


def test_query_has_the_contract_columns(spark):
    got = queries.QUERIES["op13_align_tokenizers"](spark, SF_DIR)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
