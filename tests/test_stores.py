"""Sinks by source and domain, bucketed models, checked parameters, rows that can't be read."""

import json

import pytest
from pyspark.sql import functions as F

from sozmill.operators import similarity as S
from sozmill.operators.coverage import coverage
from sozmill.sources.models import load_bucketed, save_bucketed
from sozmill.sources.params import (
    SCHEMA, SUBWORD_DEFAULTS, WORD2VEC_DEFAULTS, check_params, load_params, params_report, save_params,
)
from sozmill.sources.sinks import write_corpus, write_sources, write_two_column
from sozmill.sources.tables import SourceSpec, bad_records, read_cleaned, read_corpus, read_sources

CLEAN = "source string, cleaned_text string, sentiment_value double"


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_runs_replace_their_own_sources(spark, tmp_path):
    def rows(*triples):
        return spark.createDataFrame(list(triples), CLEAN)

    path = tmp_path / "clean"
    first = rows(("a", "bir", 1.0), ("a", "iki", 0.0), ("b", "üç", 0.5), ("c/d =", "dörd", 1.0))
    assert write_sources(first, str(path), ["a", "b", "c/d ="], bare=True) == {"a": 2, "b": 1, "c/d =": 1}
    kept = {k: v for k, v in files(path).items() if not k.startswith("source=a")}
    for _ in range(2):  # the same run again changes nothing
        assert write_two_column(rows(("a", "beş", 1.0)), str(path), bare=True) == 1
        back = {(r.source, r.cleaned_text) for r in spark.read.parquet(str(path)).collect()}
        assert back == {("a", "beş"), ("b", "üç"), ("c/d =", "dörd")}
    assert {k: v for k, v in files(path).items() if not k.startswith("source=a")} == kept
    # A source of the run that has no row any more is emptied, others stay.
    assert write_sources(rows(("b", "altı", 0.0)), str(path), ["b", "c/d ="], bare=True) == {"b": 1, "c/d =": 0}
    back = {(r.source, r.cleaned_text) for r in spark.read.parquet(str(path)).collect()}
    assert back == {("a", "beş"), ("b", "altı")}
    with pytest.raises(Exception, match="isn't in the run"):
        write_sources(rows(("x", "yeddi", 0.0)), str(path), ["b"], bare=True)
    assert {(r.source, r.cleaned_text) for r in spark.read.parquet(str(path)).collect()} == back
    assert write_sources(first.limit(0), str(path), [], bare=True) == {}


def test_only_what_is_used_is_read(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0, i, "general", f"söz {i}", 1.0) for i in range(9)],
                                 "source string, source_ord int, row_ord long, domain string, cleaned_text string, sentiment_value double")
    path = str(tmp_path / "clean")
    write_two_column(rows, path)
    read = read_cleaned(spark, path).select("cleaned_text")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<cleaned_text:string>" in plan and read.count() == 9
    assert "sentiment_value" not in read_cleaned(spark, path).columns


def test_one_domain_reads_one_folder(spark, tmp_path):
    lines = spark.createDataFrame(
        [(f"dom{d} söz {i}", d) for i in range(20) for d in ("news", "reviews", "general")], "value string, domain string")
    path = str(tmp_path / "corpus")
    assert write_corpus(lines, path, by_domain=True) == 60
    read = read_corpus(spark, path, "reviews")
    assert read.count() == 20 and {r.domain for r in read.collect()} == {"reviews"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(domain" in plan
    folders = {f.split("domain=")[1].split("/")[0] for f in read.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert folders == {"reviews"}
    flat = str(tmp_path / "flat")
    write_corpus(lines, flat)
    assert read_corpus(spark, flat, "reviews").count() == 20 and read_corpus(spark, flat).count() == 60


def test_bucketed_model_joins_without_a_shuffle_of_it(spark, tmp_path):
    rows = [(f"w{i}", [float(i % 7), float(i % 3), 1.0], i) for i in range(200)]
    vectors = spark.createDataFrame(rows, "word string, vector array<float>, cnt long")
    path = str(tmp_path / "it's a model")
    assert load_bucketed(spark, path) is None
    save_bucketed(vectors, path, 4)
    save_bucketed(vectors, path, 4)  # again
    model = load_bucketed(spark, path)
    assert sorted(model.collect()) == sorted(vectors.collect())
    pairs = spark.createDataFrame([("syn", "w1", "w2"), ("ant", "w3", "none")], "kind string, a string, b string")
    counts = vectors.select(F.lit("s").alias("source"), F.col("word").alias("token"), "cnt")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for key, value in zip(old, ("-1", "false")):
            spark.conf.set(key, value)
        for df, exchanges in ((S.pair_similarities(model, pairs), 2), (coverage(counts, model), 2)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == exchanges  # of the pairs, twice; of the counts and their sums
            assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert S.pair_similarities(model, pairs).count() == 1
        assert coverage(counts, model).first().coverage == 1.0
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_parameters_have_types(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text('{\n "vector_size": 200,\n "window": "wide", "sample": 0.5, "colour": {"a": 1}, "min_count": null\n}')
    got = load_params(spark, str(path), WORD2VEC_DEFAULTS)
    assert got == {**WORD2VEC_DEFAULTS, "vector_size": 200, "sample": 0.5}
    report = {r.key: (r.given, r.status) for r in params_report(spark, str(path)).collect()}
    assert report["vector_size"] == ("200", "read") and report["window"] == ("wide", "wrong type")
    assert report["min_count"] == (None, "missing") and report["epochs"] == (None, "missing")
    assert report["colour"] == ('{"a":1}', "unknown") and set(report) == {*SCHEMA.names, "colour"}
    assert params_report(spark, str(tmp_path / "none")) is None
    for defaults in (WORD2VEC_DEFAULTS, SUBWORD_DEFAULTS):
        save_params(spark, str(tmp_path / "saved"), defaults)
        assert load_params(spark, str(tmp_path / "saved"), {}) == {k: v for k, v in defaults.items() if v is not None}
    with pytest.raises(ValueError, match="colour"):
        save_params(spark, str(tmp_path / "saved"), {"colour": 1})
    lists = spark.createDataFrame([(1, "[]"), (2, "{}"), (3, None), (4, '{"sg": 1.5}')], "n int, value string")
    found = {(r.n, r.key): r.status for r in check_params(lists).collect()}
    assert found[1, None] == found[3, None] == "no object"
    assert found[2, "sg"] == "missing" and found[4, "sg"] == "wrong type" and (2, None) not in found


def test_no_row_vanishes_unreported(spark, tmp_path):
    csv, js = tmp_path / "c.csv", tmp_path / "j.json"
    csv.write_text('text,label\nbir,1\n"iki, və",0\nüç\ndörd,1,2\n\nbeş,x\n', encoding="utf-8")
    js.write_text('{"text": "bir", "label": "pos"}\n{"text": "iki", \n[1]\n{"label": "neg"}\n', encoding="utf-8")
    specs = [
        SourceSpec("c", str(csv), fmt="csv", options={"header": True}),
        SourceSpec("j", str(js), scheme="tri", fmt="json"),
        SourceSpec("gone", str(tmp_path / "gone.csv"), fmt="csv", options={"schema": "text string, label string"}),
    ]
    rows, status = read_sources(spark, specs)
    assert {(r.source, r.status, r.bad_rows) for r in status.collect()} == {
        ("c", "read", 2), ("j", "read", 2), ("gone", "missing", 0)}
    got = {(r.source, r.text, r.sentiment_value) for r in rows.collect()}
    assert got == {("c", "bir", 1.0), ("c", "iki, və", 0.0), ("c", "beş", None), ("j", "bir", 1.0), ("j", None, 0.0)}
    assert {(r.source, r.record) for r in bad_records(spark, specs).collect()} == {
        ("c", "üç"), ("c", "dörd,1,2"), ("j", '{"text": "iki", '), ("j", "[1]")}
    assert json.loads(status.filter("source = 'gone'").toJSON().first())["detail"].startswith("nothing at")
