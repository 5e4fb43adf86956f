"""Sources, sinks, filters, dedup and the plans over them."""

import pytest
from pyspark.sql import Row, functions as F, types as T

from sozmill.functions.labels import sentiment_value
from sozmill.functions.rules import INTENDED
from sozmill.operators import rows as R
from sozmill.operators.tokens import spelling_changes
from sozmill.plans.clean import clean_rows, row_counts, two_columns
from sozmill.plans.corpus import corpus_lines, of_domain
from sozmill.sources.models import load_vectors, save_vectors
from sozmill.sources.params import WORD2VEC_DEFAULTS, load_params, save_params
from sozmill.sources.sinks import write_corpus, write_two_column
from sozmill.sources.tables import (
    CANONICAL, SourceSpec, materialize, read_cleaned, read_sources, require_rows, spread,
    with_row_order,
)
from sozmill.streaming.clean import clean_stream


def canonical(spark, rows):
    full = [(s, i, n, t, label is not None, v) for s, i, n, t, label, v in rows]
    return spark.createDataFrame(full, CANONICAL)


def label_values(spark, values, scheme, data_type):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("v", data_type)])
    df = spark.createDataFrame(list(enumerate(values)), schema)
    out = df.select("n", sentiment_value(F.col("v"), scheme, data_type).alias("s")).collect()
    return [r.s for r in sorted(out)]


def test_binary_labels(spark):
    texts = ["1", "0", "7", " 1 ", "1.0", "abc", "0_1", "1_0", "+01", "-1", "", "_1", "1_", None,
             chr(0x661), chr(0x660) + chr(0xFF11), "1" * 30]
    want = [1.0, 0.0, 0.0, 1.0, None, None, 1.0, 0.0, 1.0, 0.0, None, None, None, None, 1.0, 1.0, 0.0]
    assert label_values(spark, texts, "binary", T.StringType()) == want
    floats = [1.7, 1.0, 0.9, -1.0, 2.0, float("inf"), float("nan"), 1e300, None]
    want = [1.0, 1.0, 0.0, 0.0, 0.0, None, None, 0.0, None]
    assert label_values(spark, floats, "binary", T.DoubleType()) == want
    assert label_values(spark, [True, False, None], "binary", T.BooleanType()) == [1.0, 0.0, None]
    assert label_values(spark, [1, 2, 0, None], "binary", T.LongType()) == [1.0, 0.0, 0.0, None]


def test_tri_labels(spark):
    texts = ["Positive", "müsbət", "2", "neytral", "0", "bad", "1.0", "junk", " NEG\n", "1", None]
    want = [1.0, 1.0, 0.5, 0.5, 0.0, 0.0, None, None, 0.0, 1.0, None]
    assert label_values(spark, texts, "tri", T.StringType()) == want
    assert label_values(spark, [1, 2, 0, 3], "tri", T.IntegerType()) == [1.0, 0.5, 0.0, None]
    assert label_values(spark, [1.0, 2.0], "tri", T.DoubleType()) == [None, None]


def test_dedup_rules(spark):
    rows = canonical(spark, [
        ("a", 0, 0, "null label first", None, None),
        ("a", 0, 1, "null label first", "1", 1.0),
        ("a", 0, 2, "junk first", "junk", None),
        ("a", 0, 3, "junk first", "pos", 1.0),
        ("a", 0, 4, "one then zero", "1", 1.0),
        ("a", 0, 5, "one then zero", "0", 0.0),
        ("b", 1, 0, "one then zero", "2", 0.5),
        ("b", 1, 1, " \t" + chr(0xA0), "1", 1.0),
        ("b", 1, 2, None, "1", 1.0),
        ("b", 1, 3, "!!!", "1", 1.0),
    ])
    got = {(r.source, r.cleaned_text, r.sentiment_value) for r in clean_rows(rows).collect()}
    assert got == {("a", "null label first", 1.0), ("a", "one then zero", 1.0),
                   ("b", "one then zero", 0.5)}
    counts = {r.source: r.rows for r in row_counts(clean_rows(rows)).collect()}
    assert counts == {"a": 2, "b": 1, None: 3}
    assert two_columns(clean_rows(rows)).columns == ["cleaned_text", "sentiment_value"]


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_dedup_does_not_depend_on_partitions(spark, partitions):
    rows = spark.range(3000).select(
        F.lit("s").alias("source"), F.lit(0).alias("source_ord"),
        F.col("id").alias("row_ord"),
        # One text holds two thirds of all rows.
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500))
        .alias("text"),
        F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.0).alias("sentiment_value"))
    rows = rows.repartition(partitions, F.hash("row_ord"))
    first = R.first_labelled(rows).orderBy("row_ord").collect()
    assert len(first) == 501
    assert [(r.row_ord, r.sentiment_value) for r in first if r.text == "hot"] == [(1, 0.0)]
    wide = R.first_rows(rows, ["text"], "row_ord", ["source"]).orderBy("row_ord").collect()
    assert [(r.row_ord, r.text) for r in wide] == [(r.row_ord, r.text) for r in first]
    again = R.first_rows(R.first_rows(rows, ["text"], "row_ord", ["source"]), ["text"], "row_ord",
                         ["source"])
    assert again.count() == 501


def test_first_rows_tells_null_from_empty(spark):
    df = spark.createDataFrame([(0, None, "a"), (1, "", "a"), (2, None, "a"), (3, "a:", ""),
                                (4, "a", ":")], "n long, x string, y string")
    assert {r.n for r in R.first_rows(df, ["x", "y"], "n").collect()} == {0, 1, 3, 4}


def test_read_sources(spark, tmp_path):
    parquet, csv, bare = (str(tmp_path / n) for n in ("p", "c", "b"))
    spark.createDataFrame(
        [(7, "bir", "pos"), (8, "iki", None)], "index int, text string, sentiment string"
    ).coalesce(1).write.parquet(parquet)
    spark.createDataFrame([("üç", 1.0), ("dörd", 0.0)], "text string, label double").coalesce(
        1).write.csv(csv, header=True)
    spark.createDataFrame([("x",)], "other string").write.parquet(bare)
    specs = [
        SourceSpec("p", parquet, "text", "sentiment", "tri"),
        SourceSpec("gone", str(tmp_path / "gone")),
        SourceSpec("c", csv, fmt="csv", options={"header": True, "inferSchema": True}),
        SourceSpec("b", bare),
    ]
    rows, status = read_sources(spark, specs)
    assert [(r.source, r.status, r.detail) for r in status.collect()][0::1] == [
        ("p", "read", ""), ("gone", "missing", f"nothing at {tmp_path / 'gone'}"),
        ("c", "read", ""), ("b", "no columns", "text, label")]
    got = rows.orderBy("source_ord", "row_ord").collect()
    assert [(r.source, r.source_ord, r.row_ord, r.text, r.has_label, r.sentiment_value)
            for r in got] == [
        ("p", 0, 0, "bir", True, 1.0), ("p", 0, 1, "iki", False, None),
        ("c", 2, 0, "üç", True, 1.0), ("c", 2, 1, "dörd", True, 0.0)]
    empty, _ = read_sources(spark, specs[1:2])
    with pytest.raises(RuntimeError):
        require_rows(empty)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_row_order_over_files(spark, tmp_path, fmt):
    path = str(tmp_path / "many")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").write.format(fmt).save(path)
    got = with_row_order(spark.read.format(fmt).load(path), "n", fmt).collect()
    assert sorted(r.n for r in got) == list(range(1000))
    assert all(r.n == r.id for r in got)


def test_spread_and_materialize(spark, tmp_path):
    path = str(tmp_path / "small")
    spark.range(100).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    kept = materialize(df.select((F.col("id") * 2).alias("id")))
    assert kept.agg(F.sum("id")).first()[0] == 9900


def test_two_column_sink(spark, tmp_path):
    rows = canonical(spark, [("a", 0, i, f"söz {i} bir", "1", 1.0) for i in range(5)]
                     + [("b", 1, 0, "iki", "0", 0.0)])
    path = str(tmp_path / "clean" / "deep")
    assert write_two_column(clean_rows(rows), path) == 6
    assert write_two_column(clean_rows(rows), path) == 6
    back = {(r.source, r.cleaned_text) for r in read_cleaned(spark, path).collect()}
    assert back == {("a", "söz <NUM> bir"), ("b", "iki")}
    assert spark.read.parquet(path).columns == [
        "cleaned_text", "sentiment_value", "source_ord", "row_ord", "domain", "source"]
    assert write_two_column(clean_rows(rows), path, bare=True) == 6
    assert spark.read.parquet(path).columns == ["cleaned_text", "sentiment_value", "source"]


def test_documented_steps_hold_together(spark, tmp_path):
    """Read, clean, write, read again, tune, train and evaluate."""
    from sozmill.operators.similarity import probe_pairs
    from sozmill.operators.tokens import token_counts
    from sozmill.operators.training import train_word2vec
    from sozmill.plans.evaluate import evaluate
    from sozmill.plans.tune import tune

    words = ["yaxşı", "əla", "pis", "bahalı", "ucuz", "qiymətli", "kitab", "gözəl"]
    data = [(" ".join(words[(i * 5 + j * j) % 8] for j in range(8)) + f" söz{i}", i % 2) for i in range(60)]
    raw = str(tmp_path / "raw")
    spark.createDataFrame(data, "text string, label int").repartition(3).write.parquet(raw)
    rows, status = read_sources(spark, [SourceSpec("a", raw), SourceSpec("b", str(tmp_path / "none"))])
    assert {(r.source, r.status) for r in status.collect()} == {("a", "read"), ("b", "missing")}
    path = str(tmp_path / "clean")
    assert write_two_column(clean_rows(rows), path) == 60
    cleaned = read_cleaned(spark, path)
    trials = [{"trial": i, "vector_size": 4, "window": 2 + i, "min_count": 1, "epochs": 1, "seed": 1,
               "sample": 0.05} for i in range(2)]
    best = tune(cleaned, probe_pairs(spark), trials, limit=40, num_partitions=1)
    assert best in [{k: v for k, v in t.items() if k != "trial"} for t in trials]
    vectors = train_word2vec(cleaned, best, num_partitions=1)
    record = evaluate(vectors, token_counts(cleaned), probe_pairs(spark)).first()
    assert record.coverage == 1.0 and -2 <= record.separation <= 2


def test_corpus(spark, tmp_path):
    rows = canonical(spark, [
        ("a", 0, 0, "Qiymət. Gəldi! Getdi?", None, None),
        ("a", 0, 1, "Bu məhsul çox yaxşı, 5 ulduz! 20 azn", None, None),
        ("a", 0, 2, "Bu yaxşı deyil o çox baha 3 dəfə", None, None),
        ("a", 0, 3, "Bu yaxşı deyil o çox baha 3 dəfə", None, None),
        ("a", 0, 4, "...", None, None),
        ("a", 0, 5, None, None, None),
    ])
    lines = corpus_lines(rows)
    twice = "domgeneral bu yaxşı deyil o_neg çox_neg baha_neg <num> dəfə"
    want = ["domreviews qiymət gəldi getdi",
            "domreviews bu məhsul çox yaxşı <num> ulduz <num> azn", twice, twice]
    assert [r.value for r in lines.orderBy("row_ord").collect()] == want
    assert of_domain(lines, "reviews").count() == 2
    assert write_corpus(lines, str(tmp_path / "o"), ordered=True) == 4
    assert [r.value for r in spark.read.text(str(tmp_path / "o")).collect()] == want
    assert write_corpus(lines, str(tmp_path / "d"), by_domain=True) == 4
    assert spark.read.text(str(tmp_path / "d")).filter("domain = 'reviews'").count() == 2
    meant = corpus_lines(rows, INTENDED).filter("row_ord < 2").orderBy("row_ord", "sent_ord")
    assert [r.value for r in meant.collect()] == [
        "domreviews qiymət", "domreviews gəldi", "domreviews getdi",
        "domreviews bu məhsul <RATING_POS> <STARS_5>", "domreviews <PRICE>"]


def test_head_is_ingest_order(spark):
    rows = canonical(spark, [("b", 1, i, f"b{i}", "1", 1.0) for i in range(3)]
                     + [("a", 0, i, f"a{i}", "1", 1.0) for i in range(3)])
    assert sorted(r.text for r in R.head(rows, 4).collect()) == ["a0", "a1", "a2", "b0"]
    assert R.head(rows, 0).isEmpty() and R.head(rows, 99).count() == 6


def test_head_at_any_order(spark):
    orders = [0, -(1 << 63), (1 << 63) - 1, 5, -7, 1 << 62, 6, 1 << 40]
    rows = spark.createDataFrame([(s, o) for s in (1, 0) for o in orders], "source_ord int, row_ord long")
    ordered = sorted((r.source_ord, r.row_ord) for r in rows.collect())
    for n in (1, 3, 8, 9, 15, 16):
        assert sorted(tuple(r) for r in R.head(rows, n).collect()) == ordered[:n]


def test_dedup_at_any_order(spark):
    rows = canonical(spark, [("a", 0, (1 << 61) + 5, "x", "1", 1.0), ("a", 0, 7, "x", "0", 0.0),
                             ("a", 0, -(1 << 62), "y", "?", None), ("a", 0, 3, "y", "1", 1.0)])
    assert sorted((r.text, r.row_ord, r.sentiment_value) for r in R.first_labelled(rows).collect()) == [
        ("x", 7, 0.0), ("y", -(1 << 62), None)]


def test_spelling_changes(spark):
    df = spark.createDataFrame([("s", "general", "cox cox tmm alma 5")],
                               "source string, domain string, text string")
    assert spelling_changes(df).collect() == [Row(source="s", domain="general", tokens=5, changed=3)]


def test_params_and_models(spark, tmp_path):
    path = str(tmp_path / "best")
    assert load_params(spark, path, WORD2VEC_DEFAULTS) == WORD2VEC_DEFAULTS
    save_params(spark, path, {"vector_size": 400, "sample": 0.0006})
    got = load_params(spark, path, WORD2VEC_DEFAULTS)
    assert (got["vector_size"], got["sample"], got["window"]) == (400, 0.0006, 5)
    assert load_vectors(spark, str(tmp_path / "none")) is None
    vectors = spark.createDataFrame([("a", [1.0, 2.0], 3)], "word string, vector array<float>, cnt long")
    save_vectors(vectors, str(tmp_path / "m"))
    assert load_vectors(spark, str(tmp_path / "m")).collect() == vectors.collect()


def test_stream_gives_the_batch_result(spark, tmp_path):
    path = str(tmp_path / "in")
    texts = ["Yaxsi idi #ok", "Salam 5 manat", "...", "  ", "<b>yox</b> cox pis"]
    spark.createDataFrame([(t,) for t in texts], "text string").write.json(path)
    stream = spark.readStream.schema("text string").json(path)
    query = (clean_stream(stream).select("domain", "cleaned_text").writeStream.format("memory")
             .queryName("cleaned_rows").start())
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    batch = clean_stream(spark.read.schema("text string").json(path)).select("domain", "cleaned_text")
    got = sorted(map(tuple, spark.table("cleaned_rows").collect()))
    assert got == sorted(map(tuple, batch.collect())) and len(got) == 3
