from pyspark.sql import functions as F

from sozmill.llm import language
from sozmill.llm.queries import op6_language_id


def test_held_out_accuracy(session):
    sf = "/root/testdata/sf0.01"
    docs = session.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op6_language_id(session, sf).join(docs, "doc_id").filter("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_kernel_counts_presence(session):
    import numpy as np
    import pyarrow as pa

    texts = ["abcabc", "ABC", "", "xyz"]
    seen = language.presence(pa.array([t.encode() for t in texts], pa.large_binary()))
    grams = [{t.lower()[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    assert seen.sum(axis=1).tolist() == [len(g) for g in grams]
    both = seen[:2].astype(int) @ seen[:2].astype(int).T
    assert both[0, 1] == len(grams[0] & grams[1])
    value = language.kernel(seen[:1], seen[1:2].T.astype(np.float32))[0, 0]
    assert abs(value - both[0, 1] / np.sqrt(len(grams[0]) * len(grams[1]))) < 1e-6


def test_odd_rows(documents, odd):
    model = language.fit(documents)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(odd.withColumn("score", F.lit("x")), model).collect()}
    for i in range(4):
        assert got[i] == ("und", 0.0)
    assert got[4][0] in model.languages
    assert language.predict(odd.limit(0), model).count() == 0
    assert language.fit(documents.limit(0)) is None
    assert {r.lang_pred for r in language.predict(odd, None).collect()} == {"und"}


def test_repeated_rows_count_once(documents):
    row = documents.filter("lang is not null and length(text) > 100").limit(1)
    many = row
    for _ in range(6):
        many = many.unionByName(many)
    assert language.labelled_sample(many, "text", "lang", "doc_id").count() == 1
    assert language.fit(many).languages == [row.first().lang]
