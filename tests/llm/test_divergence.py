import numpy as np
from pyspark.sql import functions as F

import brute
from sozmill.llm import divergence


def test_base_counts(documents, odd):
    more = odd.sparkSession.createDataFrame(
        [(100, "a b c d e f a b c d e x y\nline\nline\n line\n\n \n", "en", "s", 1),
         (101, "x " * 30, "xx", "s", 1), (102, "#a <b> | * $ % & c\x1cd\x0be " * 5, None, "s", 1)], odd.schema)
    docs = documents.unionByName(odd).unionByName(more).withColumn("kept", F.lit("clash"))
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    rows = divergence.verdicts(docs, divergence.references(docs)).select(
        "doc_id", *divergence.BASE, "base_failed", "kept").collect()
    assert sorted((r[0] is None, r[0] or 0, *r[1:7]) for r in rows) == sorted(
        (i is None, i or 0, *brute.base_counts(t)) for i, t in texts)
    assert not any(r.kept and r.base_failed for r in rows)


def test_distance(session):
    def expected(p, q):
        p, q = np.array(p) / sum(p), np.array(q) / sum(q)
        m = (p + q) / 2

        def part(x):
            return sum(a * np.log2(a / b) for a, b in zip(x, m) if a)
        return np.sqrt((part(p) + part(q)) / 2)

    pairs = [([1.0, 2.0, 3.0], [3.0, 2.0, 1.0]), ([1.0, 0.0], [0.0, 5.0]), ([4.0, 4.0], [1.0, 1.0])]
    rows = session.createDataFrame([(*p, float(expected(*p))) for p in pairs], "p array<double>, q array<double>, d double")
    for row in rows.select("d", divergence.distance(F.col("p"), F.col("q")).alias("got")).collect():
        assert abs(row.d - row.got) < 1e-9
    empty = session.createDataFrame([([0.0], [1.0])], "p array<double>, q array<double>")
    assert empty.select(divergence.distance(F.col("p"), F.col("q")).alias("d")).first().d is None


def test_verdicts_follow_labels(session):
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = divergence.verdicts(docs, divergence.references(docs)).join(labels, "doc_id").filter("n_words >= 100").cache()
    good, bad = judged.filter("quality = 1 and not base_failed"), judged.filter("quality = 0")
    assert good.filter("not kept").count() == 0
    assert bad.filter("kept").count() <= 0.1 * bad.count()


def test_rare_and_unknown_languages(session):
    """A clean document's verdict doesn't turn with its language's share of the table."""
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kind = F.pmod(F.xxhash64("doc_id"), F.lit(3))
    few = F.concat(F.lit("few"), F.pmod(F.xxhash64("doc_id"), F.lit(40)).cast("string"))
    docs = docs.withColumn("lang", F.when(F.col("lang") != "fr", F.col("lang")).when(kind == 0, "fr").when(kind == 1, few))
    found = divergence.verdicts(docs, divergence.references(docs)).select(
        "doc_id", "lang", "n_words", "base_failed", "kept", "class_distance", "word_distance").toPandas()
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    found = found[found.doc_id.isin(good) & (found.n_words >= 60) & ~found.base_failed]
    assert found.kept.all()
    assert found.word_distance[found.lang == "fr"].notna().all()
    rare = found[found.lang.isna() | found.lang.fillna("").str.startswith("few")]
    assert len(rare) > 10 and rare.word_distance[rare.lang.isna()].isna().all() and rare.class_distance.notna().any()
    assert rare.word_distance[rare.lang.notna()].notna().all()


def test_a_smaller_table_gives_the_same_verdicts(session):
    """Clean documents are kept, and bad ones rejected, by references of all documents, of a tenth and of a fiftieth."""
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    clean = docs.join(labels.filter("quality = 1"), "doc_id", "left_semi").cache()
    for share in (1, 10, 50):
        part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
        judged = divergence.verdicts(clean, divergence.references(part)).filter("not base_failed")
        assert judged.filter("not kept").count() == 0
        # Every language of the part has a reference, however small.
        langs = {r.lang for r in part.filter("lang is not null").select("lang").distinct().collect()}
        found = judged.filter(F.col("lang").isin(list(langs)) & (F.col("n_words") >= divergence.GUARD_WORDS))
        assert found.filter("word_distance is null").count() == 0


def test_names_that_clash(documents):
    clash = documents
    names = ("ref_lang", "ref_classes", "ref_words", "ref_counts", "rank", "hash", "n", "c", "common", "word")
    for name in names:
        clash = clash.withColumn(name, F.lit("x"))
    reference = divergence.references(clash)
    got = divergence.verdicts(clash, reference)
    assert [c for c in clash.columns if c in got.columns] == clash.columns
    want = divergence.verdicts(documents, divergence.references(documents))
    columns = ["doc_id", *divergence.BASE, "kept", "class_distance", "word_distance"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    assert divergence.passing(clash, reference).columns == clash.columns


def test_long_words_can_be_common(session):
    text = "alphabetical " * 30 + " ".join(f"w{i}" for i in range(60))
    docs = session.createDataFrame([(i, text, "xx") for i in range(5)], "doc_id long, text string, lang string")
    row = divergence.references(docs).filter("ref_lang = 'xx'").first()
    assert row.ref_counts[0] == 150.0 and sum(row.ref_counts) == 450.0


def test_more_references_than_are_broadcast(session, monkeypatch):
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "lang", F.when(F.col("doc_id") % 10 > 0, F.col("lang")))
    reference = divergence.references(docs)
    assert reference.count() == 5

    def judged():
        rows = divergence.verdicts(docs, reference).select(
            "doc_id", "kept", "class_distance", "word_distance").collect()
        return sorted(tuple((x is None, x or 0) for x in r) for r in rows)
    want = judged()
    monkeypatch.setattr(divergence, "BROADCAST", 1)
    assert judged() == want


def test_empty_table_and_passing(documents):
    none = documents.limit(0)
    assert divergence.verdicts(none, divergence.references(none)).count() == 0
    reference = divergence.references(documents)
    kept = {r.doc_id for r in divergence.verdicts(documents, reference).filter("kept").select("doc_id").collect()}
    passed = divergence.passing(documents, reference)
    assert passed.columns == documents.columns
    assert {r.doc_id for r in passed.collect()} == kept


def test_only_dataframe_functions(documents):
    plan = divergence.verdicts(documents, divergence.references(documents))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
