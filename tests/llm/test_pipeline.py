"""The pipeline's stages against brute force on their own input, with planted cases."""

import random

import pytest

import brute
import corpus_pipeline
from sozmill.llm.common import stored

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def inputs(session):
    """Input of each stage, and the result: the documents and planted copies, near copies and leaks."""
    docs = session.read.parquet(f"{SF}/documents.parquet")
    good = docs.join(session.read.parquet(f"{SF}/labels.parquet").filter("quality = 1 and toxic = 0"), "doc_id") \
        .filter("n_chars between 1500 and 4000").orderBy("doc_id").limit(3).collect()
    item = session.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    draw = random.Random(7)
    planted = []
    for i, row in enumerate(good):
        words = row.text.split(" ")
        near = list(words)
        near[draw.randrange(len(near))] = "changed"
        leak = words[: len(words) // 2] + item.split(" ") + words[len(words) // 2:]
        for k, text in enumerate((row.text, " ".join(near), " ".join(leak))):
            planted.append((10_000 + 10 * i + k, text, row.lang, row.source, len(text)))
    docs = docs.unionByName(session.createDataFrame(planted, docs.schema))
    out = [stored(docs)]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(session, out[-1], SF)))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_and_subsets(inputs):
    for before, after in zip(inputs[:4], inputs[1:5]):
        assert after.columns == inputs[0].columns
        assert set(ids(after)) <= set(ids(before)) and len(ids(after)) == len(set(ids(after)))
        texts = dict(before.select("doc_id", "text").collect())
        assert all(texts[r.doc_id] == r.text for r in after.select("doc_id", "text").collect())
    assert ids(inputs[5]) == ids(inputs[4])


def test_rules_and_classifier_keep_good_documents(inputs, session):
    labels = session.read.parquet(f"{SF}/labels.parquet")
    judged = {r.doc_id: brute.base_counts(r.text)[-1] for r in inputs[0].select("doc_id", "text").collect()}
    good = {r.doc_id for r in labels.filter("quality = 1").collect() if not judged[r.doc_id]}
    bad = {r.doc_id for r in labels.filter("quality = 0").collect()}
    left = set(ids(inputs[2]))
    assert good <= left
    assert len(bad & left) <= 0.05 * len(bad)
    assert not any(judged[i] for i in ids(inputs[1]))


def test_one_of_each_group(inputs):
    rows = [tuple(r) for r in inputs[2].select("doc_id", "text").collect()]
    want = sorted({group for group, _, _ in brute.near_groups(rows).values()})
    assert ids(inputs[3]) == want
    assert not {i for i in ids(inputs[3]) if i >= 10_000 and i % 10 < 2}  # copies and near copies


def test_no_benchmark_left(inputs, session):
    items = [tuple(r) for r in session.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r.doc_id for r in inputs[3].select("doc_id", "text").collect() if not brute.hits(r.text, items)[1]]
    assert ids(inputs[4]) == sorted(clean)
    assert not {i for i in ids(inputs[4]) if i >= 10_000}


def test_run_is_the_stages_in_turn(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(session, docs, SF))
    assert sorted(corpus_pipeline.run(session, SF).collect()) == sorted(docs.collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_duplicates", "decontamination", "byte_bpe"]


def test_odd_rows(session, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(session, docs, SF))
    assert docs.count() <= odd.count()
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(session, empty, SF))
    assert empty.count() == 0
