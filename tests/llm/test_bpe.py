import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lake_ingest.llm import bpe
from tests.conftest import SF_DIR

SPACES = [" ", "  ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", " ", " ", " ", " ", " ", "　"]


@pytest.fixture(scope="module")
def tokenizer():
    held = Tokenizer.from_file(bpe.DEFAULT)
    held.no_truncation()
    held.no_padding()
    return held


def _odd():
    random.seed(3)
    signs = [*"ab1'st.,!é漢😀", "'ll", "​", "<|endoftext|>", *SPACES]
    texts = [None, "", " ", "a  b\n\n c  <|endoftext|> f  <|endoftext|>  g<|endoftext|>h", "x" * 20000]
    texts += ["".join(random.choice(signs) for _ in range(random.randint(1, 60))) for _ in range(400)]
    return [(-1 - i, t) for i, t in enumerate(texts)]


def test_as_the_tokenizer(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame(_odd(), "doc_id long, text string"))
    docs = docs.unionByName(docs.limit(5)).withColumn("ids", F.lit("clash"))
    encoded = bpe.encode(docs, ["doc_id"], decoded=True)
    digests = encoded.select("doc_id", "ids", "decoded", *(c.alias(n) for n, c in bpe.digest(encoded).items()))
    got = sorted(map(tuple, digests.collect()), key=repr)
    want = []
    for row in docs.collect():
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((row.doc_id, ids, text, len(ids), listed, hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_decode_joins_pieces(spark, tokenizer):
    rows = [(1, [50256, 15496]), (2, []), (3, None), (4, [162])]
    df = spark.createDataFrame(rows, "n int, ids array<int>")
    got = {r.n: r.decoded for r in bpe.decode(df).collect()}
    assert got == {n: tokenizer.decode(ids or [], skip_special_tokens=False) for n, ids in rows}


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        bpe.load(public_tokenizers.path("word_bpe_49k.json"))


def test_empty(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).count() == 0
