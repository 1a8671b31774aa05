import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm.helpers import documents

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_on_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR)
        out = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(out.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == COLUMNS
            assert out.where("n_chars <> length(text)").isEmpty()
        docs = out
    whole = docs.count()
    assert sizes[0] <= 200 and sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[4] == sizes[3] == whole
    run = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, run.select("doc_id", "ids_sha256").collect())) == sorted(
        map(tuple, docs.select("doc_id", "ids_sha256").collect())
    )


def test_odd_rows_in_every_stage(spark):
    random.seed(1)
    text = " ".join(random.choice(["the", "of", "word", "x1"]) + str(random.randrange(99)) for _ in range(80))
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (None, None, None, None), (2, "", "en", "b"), (3, text + " end", None, None)]
    docs = documents(spark, rows)
    for table in (docs, docs.limit(0), docs.select(*COLUMNS).withColumn("text", F.lit(None).cast("string"))):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF_DIR)
            assert name == "encode" or out.columns == COLUMNS
            assert out.count() <= 3 * len(rows)
