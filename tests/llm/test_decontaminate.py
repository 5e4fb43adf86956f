from pyspark.sql import functions as F

import brute
from sozmill.llm import decontaminate

ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "tiny item"), (3, None), (4, ""),
         (5, "one two three four five six seven eight nine ten eleven twelve"), (6, "solo"), (7, "a b a b a b a b a b a b a b")]
DOCS = [
    (1, "x ONE, two three four five six seven eight nine ten y"), (2, "one two three four five six seven eight nine"),
    (3, "this tiny-item is here, tiny item"), (4, None), (5, ""), (6, "Solo solo"), (7, "a b " * 40), (8, "tiny"),
    (9, "two three four five six seven eight nine ten eleven"), (9, "two three four five six seven eight nine ten eleven"),
]


def compare(docs, items):
    want = [tuple(r) for r in items.collect()]
    rows = decontaminate.contamination(docs.withColumn("given", F.col("text")), items).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert (row.n_words, row.n_hit, row["items"]) == brute.hits(row.given, want), row


def test_against_brute_force(session, odd):
    items = session.createDataFrame(ITEMS, "item_id long, text string")
    compare(session.createDataFrame(DOCS, "doc_id long, text string").withColumn("n_words", F.lit("clash")), items)
    compare(odd.select("doc_id", "text"), items)


def test_documents(session, documents):
    compare(documents.select("doc_id", "text"), session.read.parquet("/root/testdata/sf0.001/benchmark.parquet"))


def test_empty_tables(session, documents):
    items = session.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(documents.limit(0), items).count() == 0
    assert decontaminate.contamination(documents, items.limit(0)).filter("n_hit > 0").count() == 0


def test_clean(session):
    docs = session.createDataFrame(DOCS, "doc_id long, text string")
    items = session.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 8]
