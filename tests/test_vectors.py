"""Coverage, similarity, subwords, training and tuning."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sozmill.functions.vectors import cosine
from sozmill.operators import neighbours as N, similarity as S, subwords as B, tokens as K
from sozmill.operators.coverage import coverage, macro_coverage, with_all_groups
from sozmill.operators.training import check_model_size, train_word2vec
from sozmill.plans import evaluate as E, tune as U

SCHEMA = "word string, vector array<float>, cnt long"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(f"w{i}", [float(x) for x in rng.normal(size=8)], 1 + i % 5) for i in range(60)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def table_of(vectors):
    return {r.word: np.array(r.vector, dtype=float) for r in vectors.collect()}


def cos(a, b):
    return float(a @ b / math.sqrt((a @ a) * (b @ b)))


def test_coverage_cases(spark):
    counts = spark.createDataFrame(
        [("a", "x", 9), ("a", "y", 1), ("b", "y", 1)], "source string, token string, cnt long")
    vocab = spark.createDataFrame([("x", 9)], "word string, cnt long")
    covered = coverage(counts, vocab)
    assert {r.source: r.coverage for r in covered.collect()} == {"a": 0.9, "b": 0.0}
    assert macro_coverage(covered).first().coverage == pytest.approx(0.45)
    groups = spark.createDataFrame([("a",), ("c",)], "source string")
    assert {r.source: r.coverage for r in with_all_groups(covered, groups).collect()} == {
        "a": 0.9, "c": 0.0}
    assert macro_coverage(covered.filter("false")).first().coverage == 0.0


def test_vocabulary_and_counts(spark):
    df = spark.createDataFrame([("a", "x x y"), ("b", "x  z")], "source string, cleaned_text string")
    counts = K.token_counts(df)
    assert {(r.source, r.token, r.cnt) for r in counts.collect()} == {
        ("a", "x", 2), ("a", "y", 1), ("b", "x", 1), ("b", "z", 1)}
    assert [tuple(r) for r in K.vocabulary(counts, 3).collect()] == [("x", 3)]


def test_pairs_and_separation(spark, vectors):
    known = table_of(vectors)
    pairs = spark.createDataFrame(
        [("syn", "w1", "w2"), ("syn", "w3", "none"), ("ant", "w4", "w5")],
        "kind string, a string, b string")
    row = S.pair_means(S.pair_similarities(vectors, pairs)).first()
    assert row.syn_mean == pytest.approx(cos(known["w1"], known["w2"]))
    assert row.separation == pytest.approx(row.syn_mean - cos(known["w4"], known["w5"]))
    nothing = S.pair_means(S.pair_similarities(vectors, pairs.filter("b = 'none'"))).first()
    assert math.isnan(nothing.syn_mean) and nothing.separation == -1.0


def test_cosine_of_zero_is_null(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert df.select(cosine(F.col("a"), F.col("b"))).first()[0] is None


@pytest.mark.parametrize("at_once", [1000, 4])
def test_neighbours_against_brute_force(spark, vectors, monkeypatch, at_once):
    monkeypatch.setattr(N, "SEEDS_AT_ONCE", at_once)
    known = table_of(vectors)
    words = [f"w{i}" for i in range(0, 60, 5)] + ["none", "w0"]
    seeds = spark.createDataFrame([(w,) for w in words], "word string")
    got = {}
    for r in S.nearest_neighbours(vectors, seeds, 3).collect():
        got.setdefault(r.seed, []).append((r["rank"], r.word))
    assert set(got) == set(words) - {"none"}
    for seed, found in got.items():
        best = sorted((-cos(known[seed], v), w) for w, v in known.items() if w != seed)[:3]
        assert [w for _, w in sorted(found)] == [w for _, w in best]
    lists = S.neighbour_lists(S.nearest_neighbours(vectors, seeds, 3), seeds.distinct())
    sizes = {r.seed: len(r.neighbours) for r in lists.collect()}
    assert sizes["none"] == 0 and sizes["w5"] == 3


def test_neighbours_use_no_cross_join(spark, vectors):
    seeds = spark.createDataFrame([("w1",)], "word string")
    plan = S.nearest_neighbours(vectors, seeds)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_ngrams(spark):
    df = spark.createDataFrame([("abc",), ("a",), ("aaaa",)], "word string")
    got = {r.word: r.g for r in df.select("word", B.ngrams(F.col("word"), 3, 4).alias("g")).collect()}
    assert got["abc"] == ["<ab", "abc", "bc>", "<abc", "abc>"]
    assert got["a"] == ["<a>"]
    assert got["aaaa"] == ["<aa", "aaa", "aa>", "<aaa", "aaaa", "aaa>"]


def test_subword_vectors(spark):
    vectors = spark.createDataFrame(
        [("ab", [1.0, 0.0], 1), ("abc", [0.0, 1.0], 3)], SCHEMA)
    words = spark.createDataFrame([("ab",), ("abx",), ("qq",)], "word string")
    got = {r.word: r for r in B.subword_vectors(vectors, words, 3, 3).collect()}
    # "<ab" is in both words; "abx" knows no other n-gram and "qq" none at all.
    assert set(got) == {"ab", "abx"}
    assert got["abx"].vector == pytest.approx([0.25, 0.75]) and not got["abx"].in_vocab
    assert got["ab"].vector == [1.0, 0.0] and got["ab"].in_vocab


def test_subsampling(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"),
                                 F.lit("hot hot hot hot hot hot hot hot rare").alias("cleaned_text"))
    df = df.withColumn("cleaned_text", F.concat_ws(" ", "cleaned_text", F.concat(F.lit("u"), "doc_id")))
    counts = K.token_counts(df, ())
    kept = K.subsample_tokens(df, counts, 0.01)
    sizes = {r.token: r["count"] for r in kept.groupBy("token").count().collect()}
    # share 0.8 -> sqrt(0.0125) + 0.0125 = 0.124 of 3200
    assert 300 < sizes["hot"] < 500
    assert sum(v for k, v in sizes.items() if k.startswith("u")) == 400
    again = K.subsample_tokens(df.repartition(7), counts, 0.01)
    assert kept.exceptAll(again).isEmpty() and again.exceptAll(kept).isEmpty()


def test_best_trial_ties(spark):
    trials = spark.createDataFrame([(0, 3, 0.5), (1, 4, 0.9), (2, 5, 0.9)],
                                   "trial int, window int, score double")
    assert tuple(E.best_trial(trials, "window").first()) == (1, 4, 0.9)


def test_compare_needs_two(spark, vectors):
    with pytest.raises(ValueError):
        E.compare_models([], ["one"])


@pytest.fixture(scope="module")
def cleaned(spark):
    words = [f"söz{i}" for i in range(12)]
    rows = [("s" + str(i % 2), 0, i, " ".join(words[(i * 7 + j * j) % 12] for j in range(9)))
            for i in range(300)]
    return spark.createDataFrame(
        rows, "source string, source_ord int, row_ord long, cleaned_text string").cache()


def test_training_is_repeatable(spark, cleaned):
    params = dict(vector_size=8, window=2, min_count=2, epochs=1, sample=1e-2)
    one = train_word2vec(cleaned, params, num_partitions=1).orderBy("word").collect()
    two = train_word2vec(cleaned, params, num_partitions=1).orderBy("word").collect()
    assert [r.word for r in one] == [r.word for r in two] and len(one) == 12
    assert all(len(r.vector) == 8 and r.cnt > 0 for r in one)


def test_training_counts_the_texts_once(spark, cleaned):
    params = dict(vector_size=4, window=2, min_count=2, epochs=1, sample=None)
    vectors = train_word2vec(cleaned, params, num_partitions=1)
    plan = vectors._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "split" not in plan
    assert {(r.word, r.cnt) for r in vectors.collect()} == {
        (r.word, r.cnt) for r in K.vocabulary(K.token_counts(cleaned, ()), 2).collect()}


def test_thinning_keeps_the_vocabulary(spark):
    lines = ["a b c d e f g h"] * 40 + ["rare a b", "a rare", "once a"]
    df = spark.createDataFrame([(x,) for x in lines], "cleaned_text string")
    params = dict(vector_size=4, window=2, min_count=2, epochs=1)
    full, thin = ({r.word: r.vector for r in train_word2vec(df, {**params, "sample": s}, num_partitions=1).collect()}
                  for s in (None, 1e-3))
    assert set(full) == set(thin) == {*"abcdefgh", "rare"}
    assert all(len(v) == 4 for v in thin.values()) and any(any(v) for v in full.values())


def test_training_on_the_corpus(spark, cleaned):
    corpus = cleaned.select(F.concat(F.lit("domgeneral "), "cleaned_text").alias("value"))
    params = dict(vector_size=4, window=2, min_count=2, epochs=1)
    words = {r.word for r in train_word2vec(corpus, params, num_partitions=1, text="value").collect()}
    assert "domgeneral" in words and len(words) == 13


def test_training_guards(spark, cleaned):
    with pytest.raises(ValueError):
        check_model_size(10**9, 300, 2 << 30)
    check_model_size(10**9, 300, None)
    with pytest.raises(ValueError, match="not supported"):
        train_word2vec(cleaned, dict(negative=5))
    with pytest.raises(ValueError):
        train_word2vec(cleaned, dict(vector_size=8, min_count=1), limit=100)
    with pytest.raises(RuntimeError):
        train_word2vec(cleaned.filter("false"))


def test_trials(spark):
    trials = U.trial_table(20)
    assert trials == U.trial_table(20) and len(trials) == 20
    assert all(150 <= t["vector_size"] <= 400 and t["vector_size"] % 50 == 0 for t in trials)
    assert all(1e-5 <= t["sample"] <= 1e-3 for t in trials)
    assert all(t["min_n"] <= t["max_n"] for t in U.trial_table(20, "subword"))


def test_sweep(spark, cleaned):
    pairs = S.probe_pairs(spark, [("söz1", "söz2")], [("söz3", "söz4x")])
    trials = [dict(trial=i, vector_size=4, window=w, min_count=1, epochs=1, min_n=3, max_n=4)
              for i, w in enumerate((2, 3))]
    rows = U.sweep(cleaned, pairs, trials, model="subword", limit=100, num_partitions=1).collect()
    assert len(rows) == 2 and all(r.coverage == 1.0 for r in rows)
    assert all(not math.isnan(r.ant_mean) for r in rows)
    best = U.tune(cleaned, pairs, trials, model="subword", num_partitions=1)
    assert set(best) == set(trials[0]) - {"trial"}


def test_reports_with_the_short_lists(spark):
    from sozmill.plans.report import metric_report, neighbour_report

    words = ["yaxşı", "əla", "bahalı", "qiymətli", "pis", "ucuz", "sərfəli"]
    rows = [(w, [float(i % 3), float(i % 2), 1.0], 5 + i) for i, w in enumerate(words)]
    vectors = spark.createDataFrame(rows, "word string, vector array<float>, cnt long")
    counts = spark.createDataFrame([("a", "yaxşı", 3), ("a", "nə", 1), ("b", "pis", 2)],
                                   "source string, token string, cnt long")
    report = {(r.source, r.metric): (r.plain, r.subword) for r in metric_report(vectors, vectors, counts).collect()}
    assert report["a", "coverage"] == (0.75, 0.75) and report[None, "coverage"] == (0.875, 0.875)
    assert report[None, "separation"][0] == report[None, "separation"][1]  # all probe words used are known
    lists = {(r.model, r.seed): r.neighbours for r in neighbour_report(vectors, vectors, k=2).collect()}
    assert len(lists) == 18 and len(lists["plain", "yaxşı"]) == 2
    assert lists["plain", "mükəmməl"] == [] and "yaxşı" not in lists["subword", "yaxşı"]


def test_places_of_very_long_texts(spark, tmp_path):
    """A text of 25,000 words, whose places overflowed the product in the query's draw."""
    from sozmill.checks import queries as Q

    text = "word other " * 12_500
    row = [(1, text, "en", "src1", len(text))]
    spark.createDataFrame(row, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    kept = {r.token: r.kept for r in Q.subsample_tokens(spark, str(tmp_path)).collect()}
    assert 0 < kept["word"] < 12_500


def test_training_stays_off_the_driver(spark, cleaned):
    """The vectors are rows of tasks: no local relation, and no Spark ML model."""
    params = dict(vector_size=4, window=2, min_count=2, epochs=2, sample=None)
    plan = train_word2vec(cleaned, params, num_partitions=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LocalTableScan" not in plan


def test_codes_are_huffmans():
    import heapq

    from sozmill.operators.skipgram import canonical, code_lengths

    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 10, 700):
        counts = np.sort((rng.pareto(1, n) * 5 + 1).astype(int))[::-1]
        lengths = code_lengths(counts)
        heap, cost = counts.tolist(), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            heapq.heappush(heap, both := heapq.heappop(heap) + heapq.heappop(heap))
            cost += both
        assert (lengths * counts).sum() == cost
        codes, shift = canonical(lengths)
        nodes = {(int(c) >> int(n - d)) + int(shift[d]) for c, n in zip(codes, lengths) for d in range(n)}
        assert nodes == set(range(n - 1)) and len(set(zip(codes, lengths))) == n


def test_a_step_is_that_of_each_pair():
    from sozmill.operators.skipgram import Model

    rng = np.random.default_rng(5)
    vectors, nodes = (rng.normal(size=(7, 4)).astype(np.float32) for _ in range(2))
    model = Model(np.array([50, 30, 20, 9, 5, 3, 2]), vectors.copy(), nodes.copy())
    center, context = np.array([0, 0, 3, 6]), np.array([[1, 2], [3, 3], [1, 5], [0, 1]])
    near = np.array([[1, 1], [1, 0], [1, 1], [0, 1]], bool)
    model.train(center, context, near, 0.1)
    more, more_nodes = np.zeros((7, 4)), np.zeros((7, 4))
    for i, j in zip(*np.nonzero(near)):
        word, other = center[i], context[i, j]
        code, length = int(model.codes[word]), int(model.lengths[word])
        for depth in range(length):
            node, bit = (code >> length - depth) + model.shift[depth], code >> length - depth - 1 & 1
            step = 0.1 * (1 - bit - 1 / (1 + np.exp(-vectors[other] @ nodes[node])))
            more[other] += step * nodes[node]
            more_nodes[node] += step * vectors[other]
    assert model.vectors == pytest.approx(vectors + more, abs=1e-5)
    assert model.nodes == pytest.approx(nodes + more_nodes, abs=1e-5)


@pytest.mark.parametrize("sample", [None, 0.05])
def test_words_of_like_contexts_are_near(spark, sample):
    rng = np.random.default_rng(7)
    topics = [[f"{t}{i}" for i in range(6)] for t in "abc"]
    lines = [" ".join(rng.choice(topics[i % 3], 8)) for i in range(1500)]
    df = spark.createDataFrame([(x,) for x in lines], "cleaned_text string")
    params = dict(vector_size=12, window=4, min_count=2, epochs=3, sample=sample)
    for parts in (1, 3):
        found = table_of(train_word2vec(df, params, num_partitions=parts))
        same = np.mean([cos(found["a0"], found[w]) for w in topics[0][1:]])
        other = np.mean([cos(found["a0"], found[w]) for w in topics[1]])
        assert same > other + 0.3
    again = table_of(train_word2vec(df.repartition(5), params, num_partitions=1))
    once = table_of(train_word2vec(df, params, num_partitions=1))
    assert all((once[w] == again[w]).all() for w in once)
