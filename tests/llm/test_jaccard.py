import random

import pytest
from pyspark.sql import functions as F

import brute
from sozmill.llm import common, jaccard


def variants(seed=1):
    """Copies, near copies with a chain of changes, and texts that share a passage."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(draw.choice([3, 5, 12, 60, 200]))]
        for _ in range(draw.randint(1, 12)):
            if draw.random() < 0.7 and len(base) > 5:
                base = list(base)
                base[draw.randrange(len(base))] = word()
            rows.append(" ".join(base))
    passage = " ".join(word() for _ in range(40))
    rows += [f"{passage} {' '.join(word() for _ in range(n))}" for n in (5, 10, 40, 400)]
    return [(i, t) for i, t in enumerate(rows)]


def test_band_plan():
    bands, rows = jaccard.band_plan()
    assert bands * rows <= jaccard.HASHES
    assert 1 - (1 - 0.8 ** rows) ** bands >= jaccard.RECALL
    assert 1 - (1 - 0.8 ** (rows + 1)) ** (jaccard.HASHES // (rows + 1)) < jaccard.RECALL
    with pytest.raises(ValueError):
        jaccard.band_plan(0.2, 0.9999, 4)


@pytest.mark.parametrize("chunk", [1024, 3])
def test_against_brute_force(session, chunk, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_MEMBERS", chunk)
    rows = variants()
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in jaccard.join(docs).collect()}
    assert got == brute.near_groups(rows)


def test_documents(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in jaccard.join(documents).collect()}
    assert got == brute.near_groups(rows)


def test_odd_rows(odd, session):
    rows = jaccard.join(odd.withColumn("n", F.lit(1)).withColumn("cls", F.lit("x"))).collect()
    assert len(rows) == odd.count()
    empty = [r for r in rows if r.doc_id in (0, 1)]
    assert {r.class_id for r in empty} == {0}  # null is an empty text
    assert jaccard.join(odd.limit(0)).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 2, 3, 4, 5, 6, 7, 8] and None not in ids


def test_one_of_each(session):
    rows = variants(2)
    docs = session.createDataFrame(rows + rows[:3], "doc_id long, text string")
    want = {group for group, _, _ in brute.near_groups(rows).values()}
    assert sorted(r.doc_id for r in jaccard.one_of_each(docs).collect()) == sorted(want)


def test_copies_that_pass_the_filter(session, monkeypatch):
    """Copies whose keys are false positives of the filter don't hide the document that stands for them."""
    monkeypatch.setattr(common, "FILTER_BITS", 6)
    draw = random.Random(3)
    texts = []
    for _ in range(30):
        base = [f"w{draw.randrange(10 ** 6)}" for _ in range(60)]
        texts += [" ".join(base), " ".join([*base[:-1], "other"])]
    rows = [(i, texts[i % len(texts)]) for i in range(3000)]
    draw.shuffle(rows)

    # Workers import the default, so the filter's test goes along with the function.
    def in_filter(bits, values):
        at = values.astype("int64") & 63
        return (bits[at >> 6] >> (at & 63)) & 1 == 1
    monkeypatch.setattr(jaccard, "in_filter", in_filter)
    docs = session.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies, r.keeper) for r in jaccard.join(docs).collect()}
    assert got == {i: (i % 60 // 2 * 2, 1, 50, i < 60 and i % 2 == 0) for i, _ in rows}


def test_chunks_without_members(session, monkeypatch):
    """Chunks far smaller than a set: many have no members, and no link counts twice."""
    monkeypatch.setattr(jaccard, "CHUNK_NGRAMS", 20)
    rows = [(i, " ".join([*(f"g{g}w{j}" for j in range(99)), f"x{i}"])) for g in range(8)
            for i in range(g * 10, g * 10 + 2 + g % 2)]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in jaccard.join(docs).collect()}
    assert got == brute.near_groups(rows)
    assert {n for _, n, _ in got.values()} == {1, 2}


def test_components(session):
    chain = [(bytes([i]), bytes([i + 1])) for i in range(40)] + [(b"x", b"y"), (b"z", b"y"), (b"q", b"q")]
    got = {bytes(r.node): bytes(r.root) for r in jaccard.components(
        session.createDataFrame(chain, "a binary, b binary")).collect()}
    assert {got[bytes([i])] for i in range(41)} == {bytes([0])}
    assert got[b"z"] == got[b"y"] == b"x" and b"q" not in got


def test_components_of_large_stars(session, monkeypatch):
    """Nodes of many edges are dealt out; the groups are those of a plain union of sets."""
    monkeypatch.setattr(jaccard, "HUB", 5)
    draw = random.Random(4)
    edges = [(0, i) for i in range(1, 200)] + [(500, i) for i in range(300, 420)] + [(420, 501), (501, 502)]
    edges += [(draw.randrange(1000, 1300), draw.randrange(1000, 1300)) for _ in range(160)]
    name = lambda i: b"%04d" % i
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    frame = session.createDataFrame([(name(a), name(b)) for a, b in edges], "a binary, b binary")
    got = {bytes(r.node): bytes(r.root) for r in jaccard.components(frame).collect()}
    assert got == {name(x): name(root(x)) for x in parent}
