"""The registered queries of this subpackage: each operator on its whole table, and the SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lake_ingest.llm import alignment, bpe, collocations, embeddings, extraction, mixing, near, oracles, pii, quality, secrets, suffixes, toxicity, warc
from lake_ingest.llm.shared import scratch_path

# The key of the registered queries, which run on invented data; it protects nothing.
CHECK_KEY = b"for checks on invented data only"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives it was written to."""
    root = scratch_path(spark, "warc")
    warc.write_archives(warc.records(_table(spark, sf_dir, "pages")), root)
    return warc.read_archives(spark, root).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, source size, target and words taken of every document of the mix."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 400-byte strings."""
    docs = _table(spark, sf_dir, "documents")
    return suffixes.digest(docs, suffixes.repeated_spans(docs), kept="text")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and the text they decode to, as digests."""
    decoded = bpe.encode(_table(spark, sf_dir, "documents"), ["doc_id"], decoded=True)
    return decoded.select("doc_id", *(c.alias(n) for n, c in bpe.digest(decoded).items()))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    return quality.judge(_table(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of every document, and whether it stays."""
    return near.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts of the base spans, their digest, and all spans."""
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document with its personal data replaced."""
    return pii.surrogates(_table(spark, sf_dir, "documents"), key=CHECK_KEY).select("doc_id", "text", "n_entities")


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    texts = extraction.main_texts(_table(spark, sf_dir, "pages"), ["page_id", "url"])
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of every language whose words keep together."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers."""
    aligned = alignment.align(_table(spark, sf_dir, "documents"), ["doc_id"])
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return aligned.select(*columns, *(c.alias(n) for n, c in alignment.digest().items()))


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_mix_sources": op2_mix_sources,
    "op3_embedding_dedup": op3_embedding_dedup,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_quality_rules": op7_quality_rules,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_secret_scan": op9_secret_scan,
    "op10_surrogates": op10_surrogates,
    "op11_main_text": op11_main_text,
    "op12_collocations": op12_collocations,
    "op13_align_tokenizers": op13_align_tokenizers,
}
ORACLES: dict[str, str] = {
    "op1_warc": oracles.WARC,
    "op2_mix_sources": oracles.MIX_SOURCES,
    "op3_embedding_dedup": oracles.EMBEDDING_DEDUP,
    "op12_collocations": oracles.COLLOCATIONS,
}
