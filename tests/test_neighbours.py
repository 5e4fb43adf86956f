"""Neighbours by pivots, overlap of lists, hashed n-grams, thinning, models with and without negation."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sozmill.operators import neighbours as N, similarity as S, subwords as B, tokens as K
from sozmill.operators.training import thinned, train_word2vec
from sozmill.plans import evaluate as E, negation as G

SCHEMA = "word string, vector array<float>, cnt long"


def clustered(spark, n=3000, size=16, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(25, size))
    rows = centres[rng.integers(0, 25, n)] + rng.normal(0, 0.05, (n, size))
    return spark.createDataFrame([(f"w{i}", [float(x) for x in r], 1) for i, r in enumerate(rows)], SCHEMA).repartition(6)


def brute(table, words, k):
    known = {r.word: np.array(r.vector, float) for r in table.collect() if r.vector is not None}
    known = {w: v / np.linalg.norm(v) for w, v in known.items() if np.linalg.norm(v) > 0}
    return {s: [w for _, w in sorted((-round(float(known[s] @ v), 9), w) for w, v in known.items() if w != s)[:k]]
            for s in words if s in known}


@pytest.mark.parametrize("at_once", [1000, 7])
def test_equals_brute_force_and_scores_few(spark, monkeypatch, at_once):
    monkeypatch.setattr(N, "SEEDS_AT_ONCE", at_once)
    vectors = clustered(spark)
    seeds = [f"w{i}" for i in range(0, 3000, 150)]
    asked = vectors.filter(F.col("word").isin(seeds))
    got = {}
    for r in S.nearest_neighbours(vectors, asked, 4).collect():
        got.setdefault(r.seed, {})[r["rank"]] = r.word
    want = brute(vectors, seeds, 4)
    assert {s: [found[i] for i in sorted(found)] for s, found in got.items()} == want
    found = N.search(vectors, asked, 4)
    work = N.work(found).first()
    assert work.pairs == 20 * 3000 and work.scored < 0.35 * work.pairs
    assert found.filter("word is not null").count() <= 20 * 4 * max(8, 2 * 8 + len(seeds))  # k a seed and task
    plan = S.nearest_neighbours(vectors, asked, 4)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_odd_vectors(spark):
    same = [1.0, 2.0, 2.0]
    rows = [(f"t{i:02d}", same, 1) for i in range(30)] + [
        ("zero", [0.0, 0.0, 0.0], 1), ("none", None, 1), ("short", [1.0], 1), ("nan", [float("nan")] * 3, 1),
        ("far", [-1.0, -2.0, -2.0], 1), (None, same, 1)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    seeds = spark.createDataFrame([("t03",), ("zero",), ("none",), ("unknown",), ("far",)], "word string")
    found = {}
    for r in S.nearest_neighbours(vectors, seeds, 3).collect():
        found.setdefault(r.seed, []).append((r["rank"], r.word))
    assert [w for _, w in sorted(found.pop("t03"))] == ["t00", "t01", "t02"]  # ties by word
    assert [w for _, w in sorted(found.pop("far"))] == ["t00", "t01", "t02"]
    assert not found
    assert S.nearest_neighbours(vectors.limit(0), seeds, 3).count() == 0
    assert S.nearest_neighbours(vectors, seeds.limit(0), 3).count() == 0


def test_many_seeds_send_few_rows(spark, monkeypatch):
    monkeypatch.setattr(N, "SEEDS_AT_ONCE", 7)
    vectors, sent = clustered(spark), []
    real = type(vectors).mapInArrow
    monkeypatch.setattr(type(vectors), "mapInArrow", lambda df, *args: sent.append(df) or real(df, *args))
    found = N.search(vectors, vectors, 1)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A block of seven seeds each would send every vector 429 times.
    assert sent[0].count() <= 3000 * 3 * (math.sqrt(parts) + 1)
    assert sent[0].rdd.getNumPartitions() >= parts
    monkeypatch.setattr(N, "HELD", 500 * 16 * 8)  # six blocks, whatever the partitions
    N.search(vectors, vectors, 1)
    assert sent[1].filter("kind = 0").groupBy("cell").count().agg(F.max("count")).first()[0] < 650
    assert N.work(found).first().pairs == 3000 * 3000


@pytest.mark.parametrize("k", [1, 3])
def test_all_words_with_copies_ties_and_small_runs(spark, monkeypatch, k):
    for name, value in (("SEEDS_AT_ONCE", 7), ("RUN", 16), ("SEEDS_A_RUN", 5), ("PAIRS", 9)):
        monkeypatch.setattr(N, name, value, raising=False)
    copies = spark.createDataFrame([(f"c{i:02d}", [0.5] * 16, 1) for i in range(40)] + [
        ("zero", [0.0] * 16, 1), ("none", None, 1), ("short", [1.0], 1)], SCHEMA)
    vectors = clustered(spark, 400).union(copies)
    got = {}
    for r in S.nearest_neighbours(vectors, vectors, k).collect():
        got.setdefault(r.seed, {})[r["rank"]] = r.word
    want = brute(vectors.filter("word <> 'short'"), [r.word for r in vectors.collect() if r.word != "short"], k)
    assert {s: [found[i] for i in sorted(found)] for s, found in got.items()} == want
    assert want["c00"][0] == "c01" and want["c39"][0] == "c00"


def test_a_repeated_word_keeps_its_neighbour(spark, monkeypatch):
    monkeypatch.setattr(N, "SEEDS_AT_ONCE", 7)
    vectors = clustered(spark, 60)
    want = brute(vectors, [f"w{i}" for i in range(60)], 1)
    twice = vectors.union(vectors).union(vectors).coalesce(1)
    assert {r.seed: [r.word] for r in S.nearest_neighbours(twice, twice, 1).collect()} == want


def test_overlap(spark):
    schema = "seed string, rank int, word string"
    one = spark.createDataFrame([("s", i, w) for i, w in enumerate("abcd", 1)] + [("only", 1, "x")], schema)
    other = spark.createDataFrame([("s", i, w) for i, w in enumerate("bace", 1)], schema)
    got = {r.seed: r for r in S.list_overlap(one, other, 4).collect()}
    assert got["s"].shared == 3 and got["s"].overlap == pytest.approx((0 + 2 / 2 + 3 / 3 + 3 / 4) / 4)
    assert got["only"].shared == 0 and got["only"].overlap == 0
    assert S.list_overlap(one, one, 4).filter("seed = 's'").first().overlap == 1.0


def test_models_with_and_without_negation(spark):
    texts = ["yaxşı deyil bu film pis idi a b", "film yaxşı idi bu çox", "yox bu film idi yaxşı deyil pis"] * 40
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    cleaned = G.both_cleanings(df)
    row = cleaned.orderBy("doc_id").first()
    assert row.cleaned_text == "yaxşı deyil bu_NEG film_NEG pis_NEG idi"
    assert row.plain_text == "yaxşı deyil bu film pis idi"
    short = spark.createDataFrame([("yox a b o x",)], "text string")
    kept = G.both_cleanings(short).first()
    assert (kept.cleaned_text, kept.plain_text) == ("yox a_NEG b_NEG o_NEG", "yox o")
    params = dict(vector_size=6, window=2, min_count=2, epochs=1, sample=None)
    marked, plain = G.negation_models(cleaned, params, num_partitions=1)
    words = [{r.word for r in m.collect()} for m in (marked, plain)]
    assert "film_NEG" in words[0] and not any(w.endswith("_NEG") for w in words[1]) and "film" in words[1]
    seeds = spark.createDataFrame([("film",), ("yaxşı",), ("film_NEG",), ("heç",)], "word string")
    found = {r.seed: r for r in G.negation_overlap(marked, plain, seeds, 3).collect()}
    assert set(found) == {"film", "yaxşı", "film_NEG", "heç"}
    assert found["film_NEG"].overlap == found["heç"].overlap == 0 and 0 <= found["film"].overlap <= 1
    assert {r.overlap for r in G.negation_overlap(plain, plain, seeds.limit(2), 3).collect()} == {1.0}


def test_thinning_in_the_row(spark):
    tokens = spark.range(2000).select(F.split(F.concat(F.lit("hot cold hot u"), "id", F.lit(" it's \"q\"")), " ").alias("tokens"))
    rare = [("hot", 0.25), ("it's", 0.5), ('"q"', 0.0), ("absent", 0.1)]
    out = thinned(tokens, rare)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan and "Exchange" not in plan
    counts = {r.w: r["count"] for r in out.select(F.explode("tokens").alias("w")).groupBy("w").count().collect()}
    assert counts["cold"] == 2000 and '"q"' not in counts and sum(k[0] == "u" for k in counts) == 2000
    assert abs(counts["hot"] - 1000) < 120 and abs(counts["it's"] - 1000) < 120
    again = thinned(tokens.repartition(5), rare)
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    assert thinned(tokens, []).collect() == tokens.collect()


def test_thinned_training_keeps_the_driver_small(spark, monkeypatch):
    lines = [f"a b c d e f w{i} v{i % 50}" for i in range(1000)]
    df = spark.createDataFrame([(x,) for x in lines], "cleaned_text string")
    seen = []
    from sozmill.operators import training as T
    monkeypatch.setattr(T, "thinned", lambda t, rare, seed: seen.append(rare) or thinned(t, rare, seed))
    vectors = train_word2vec(df, dict(vector_size=4, window=2, min_count=1, epochs=1, sample=0.02), num_partitions=1)
    assert vectors.count() == 6 + 1000 + 50
    assert {w for w, _ in seen[0]} == set("abcdef") and len(seen[0]) <= 1 / 0.02


def test_hashed_ngrams(spark):
    rows = [(f"söz{i}", [float(i % 5), 1.0], 1 + i % 3) for i in range(300)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    exact = {r.ngram: r for r in B.ngram_vectors(vectors).collect()}
    wide = B.bucket_vectors(vectors, 1 << 30).collect()
    assert len(wide) == len(exact) and sorted(r.words for r in wide) == sorted(r.words for r in exact.values())
    small = B.bucket_vectors(vectors, 50).collect()
    assert len(small) <= 50 and sum(r.words for r in small) == sum(r.words for r in exact.values())
    words = spark.createDataFrame([("söz1",), ("söz1000",), ("qqq",), ("xyzxyzxyz",)], "word string")
    one = {r.word: r.vector for r in B.subword_vectors(vectors, words).collect()}
    two = {r.word: r.vector for r in B.subword_vectors(vectors, words, buckets=1 << 30).collect()}
    assert set(one) == set(two) == {"söz1", "söz1000"}
    assert all(np.allclose(one[w], two[w]) for w in one)
    flags = {r.word: (r.in_vocab, r.has_vector)
             for r in B.membership(B.subword_vectors(vectors, words, buckets=1 << 30), words).collect()}
    assert flags == {"söz1": (True, True), "söz1000": (False, True), "qqq": (False, False), "xyzxyzxyz": (False, False)}


def test_subword_coverage_counts_the_vocabulary_only(spark):
    vectors = spark.createDataFrame([("alma", [1.0, 0.0], 5), ("almalar", [0.9, 0.1], 2)], SCHEMA)
    counts = spark.createDataFrame([("a", "alma", 3), ("a", "almada", 1)], "source string, token string, cnt long")
    pairs = spark.createDataFrame([("syn", "alma", "almada"), ("ant", "alma", "almalarda")], "kind string, a string, b string")
    for buckets in (None, 1000):
        record = E.evaluate_subwords(vectors, counts, pairs, buckets=buckets).first()
        assert record.coverage == 0.75 and not math.isnan(record.syn_mean) and not math.isnan(record.ant_mean)
    assert math.isnan(E.evaluate(vectors, counts, pairs).first().syn_mean)


def test_no_token_counts_for_an_empty_corpus(spark):
    assert K.token_counts(spark.createDataFrame([], "source string, cleaned_text string")).count() == 0
