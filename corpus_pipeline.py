"""The training-data pipeline over ``documents``: a list of stages, each an operator of lake_ingest.llm.

Every stage takes the rows that the one before it kept, whatever further columns they have, and all but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lake_ingest.llm import bpe, mixing, near, pii, quality
from lake_ingest.llm.queries import CHECK_KEY
from lake_ingest.llm.shared import saved


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, ``n_chars`` that of the text as it is now."""
    n_chars = F.length("text").cast("long").alias("n_chars")
    return docs.select("doc_id", "text", "lang", "source", n_chars)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep."""
    return _documents(quality.kept_documents(_documents(docs)))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _documents(near.deduplicated(_documents(docs)))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by surrogates."""
    return _documents(pii.surrogates(_documents(docs), key=CHECK_KEY))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, the last time cut to the words it takes."""
    return _documents(mixing.mixed_documents(_documents(docs)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with the digests that a reader can compare."""
    columns = ["doc_id", "lang", "source"]
    encoded = bpe.encode(_documents(docs), columns, decoded=True)
    return encoded.select(*columns, *(c.alias(n) for n, c in bpe.digest(encoded).items()), "ids")


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("surrogates", replace_personal_data),
    ("mix", mix_sources),
    ("encode", encode),
]

# The near-duplicate, surrogate and encoding stages cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each one's rows written before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position + 1 < len(STAGES):
            docs = saved(docs, f"stage-{name}")
    return docs
