import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lake_ingest.llm import mixing
from tests.conftest import SF_DIR
from tests.llm.helpers import documents


def _targets(sizes, weights=(5, 2, 1), epochs=3):
    """Capped shares by repeated redistribution."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, got = sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > epochs * sizes[s]]
        if not over:
            return got | {s: left * weight[s] / total for s in open_}
        for s in over:
            got[s] = epochs * sizes[s]
            left -= got[s]
            open_.discard(s)
    return got


def test_targets_and_taken(spark):
    rows = [(i, "w " * (i % 40), "en", f"s{i % 7}" if i % 5 else None) for i in range(600)]
    rows += [(1000, None, "en", "s1"), (1001, "", None, "only empty"), (5, rows[5][1], "en", rows[5][3])]
    got = mixing.mix(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    targets = _targets(sizes)
    source_of = {i: s for i, _, _, s in rows}
    taken = Counter()
    for r in got:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(targets[source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 0.02 * sum(sizes.values()) / len(sizes) + 1


def test_seats_are_those_of_the_highest_quotients(spark):
    sources = spark.createDataFrame(
        [("=a", 1000, 1, 700.0), ("=b", 900, 1, 500.5), ("=c", 300, 1, 99.5), ("=d", 10, 1, 0.4)],
        "_source string, source_size long, weight long, target double",
    )
    quotas = mixing.shard_quotas(sources, block_tokens=13, shard_tokens=200).collect()
    shards = max(q.shard for q in quotas) + 1
    total = sum(s.source_size for s in sources.collect())
    assert shards == -(-total // 200)
    blocks = round(total / 13)
    order = sorted(
        ((-s.target / (2 * k + 1), s["_source"]) for s in sources.collect() for k in range(blocks))
    )
    for shard in range(shards):
        house = blocks * (shard + 1) // shards
        want = Counter(name for _, name in order[:house])
        assert {q["_source"]: q.seats for q in quotas if q.shard == shard and q.seats} == dict(want)
        assert sum(q.quota for q in quotas if q.shard == shard) == house - blocks * shard // shards


def test_documents_of_the_mix(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs.unionByName(docs.limit(3)).withColumn("taken", F.lit("clash"))
    plan = mixing.mix(docs)
    per_doc = {r.doc_id: r.taken for r in plan.groupBy("doc_id").agg(F.sum("taken").alias("taken")).collect()}
    texts, words = {r.doc_id: r.text for r in docs.collect()}, defaultdict(int)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        assert texts[r.doc_id].startswith(r.text)
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert {k: v for k, v in per_doc.items() if v} == dict(words)


def test_reruns_agree_on_other_partitions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first, second = (sorted(map(tuple, mixing.mix(d).collect())) for d in (docs, docs.repartition(7)))
    assert first == second


def test_empty(spark):
    docs = documents(spark, [])
    assert mixing.mix(docs).count() == 0 and mixing.mixed_documents(docs).count() == 0
    assert [r.taken for r in mixing.mix(documents(spark, [(1, None, None, None)])).collect()] == [0]
