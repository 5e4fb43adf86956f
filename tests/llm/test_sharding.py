import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from sozmill.llm import sharding


def check(docs, n):
    given = docs.select("doc_id", "text").collect()
    rows = sharding.shard(docs, n).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (g.doc_id, len((g.text or "").encode()) + 1, zlib.crc32((g.text or "").encode())) for g in given)
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < n
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    keyed = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
                        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("size")).collect()
    sizes = Counter()
    for r in keyed:
        sizes[r.key] += r["size"]
    shards = Counter()
    for r in rows:
        shards[r.shard] += r.size
    ordered = [sizes[k] for k in sorted(sizes)]
    if ordered:
        assert max(shards.values()) == brute.least_capacity(ordered, n)
    return rows


@pytest.mark.parametrize("n", [1, 5, 16])
def test_documents(documents, n):
    check(documents, n)


def test_odd_and_hot_rows(odd, documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 7)
    check(odd.withColumn("shard", F.lit("clash")).withColumn("key", F.lit(1)), 4)
    hot = documents.limit(1).crossJoin(documents.sparkSession.range(150).select("id")).withColumn("doc_id", F.col("id"))
    check(documents.unionByName(hot.select(*documents.columns)), 16)
    assert sharding.shard(documents.limit(0), 16).count() == 0


@pytest.mark.parametrize("share", [0.05, 0.2, 0.5])
def test_hot_group_refines_few_ranges(session, monkeypatch, share):
    """One group of a twentieth to a half of all bytes among 100,000: few ranges a level, least capacity."""
    n, rows = 16, 100_000
    hot = int(rows * 520 * share / (1 - share))
    groups = session.range(rows).select(
        F.xxhash64("id").alias("key"),
        F.when(F.col("id") == 77, hot).otherwise(20 + F.pmod(F.hash("id"), F.lit(1000))).cast("long").alias("size"))
    asked, split = [], sharding._split
    monkeypatch.setattr(sharding, "_split", lambda g, ranges: asked.append(len(ranges)) or split(g, ranges))
    cuts = sharding.minimax_cuts(groups, n)
    assert asked and max(asked) <= 2 * n and len(asked) <= 12
    ordered = sorted((r.key, r.size) for r in groups.collect())
    shards = Counter()
    for key, size in ordered:
        shards[sum(key >= c for c in cuts)] += size
    assert max(shards.values()) == brute.least_capacity([s for _, s in ordered], n)


def test_equal_texts_stay_together(documents):
    joined = sharding.shard(documents, 16).join(documents.select("doc_id", "text"), "doc_id")
    assert joined.groupBy("text").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
