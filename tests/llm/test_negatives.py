import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sozmill.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor, positives=5, negatives=3):
    """Sorted result rows by scoring all pairs with Python integers."""
    kept = []
    for r in rows:
        v = r["embedding"]
        if r["vec_id"] is None or r["label"] is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((r["vec_id"], r["label"], [int(np.floor(256 * float(x))) for x in v]))
    out = []
    for i, (a, label, x) in enumerate(kept):
        if not anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), id, same == label)
                        for j, (id, same, y) in enumerate(kept) if j != i)
        for score, positive, _ in [s for s in scored if s[2]][:positives]:
            fits = [(s, id) for s, id, same in scored if not same and 50 * -score <= 100 * -s <= 95 * -score]
            out += [(a, positive, k, id, -score, -s) for k, (s, id) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def found(df, anchor):
    rows = negatives.mine(df, anchor).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                  for r in rows)


@pytest.fixture(scope="module")
def embeddings(session):
    return session.read.parquet("/root/testdata/sf0.001/embeddings.parquet")


@pytest.mark.parametrize("dense", [0.0, 0.1, 2.0])
def test_equals_brute_force(embeddings, monkeypatch, dense):
    """Bounds for all pairs, for pairs that are left, or both, in blocks far smaller than the table."""
    for name, value in dict(DENSE=dense, VECTORS_PER_BLOCK=64, ANCHORS_PER_BLOCK=16, ANCHORS_AT_ONCE=5,
                            PAIRS_AT_ONCE=100).items():
        monkeypatch.setattr(negatives, name, value)
    rows = [r.asDict() for r in embeddings.collect()]
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and found(embeddings, F.col("id") % 10 == 0) == want


def test_odd_rows(session, embeddings):
    base = [(r.vec_id, list(r.embedding), r.label) for r in embeddings.limit(80).collect()]
    odd = [
        (None, base[0][1], 1), (1000, None, 1), (1001, base[0][1], None), (1002, [None] + base[0][1][1:], 1),
        (1003, [float("nan")] + base[0][1][1:], 1), (1004, [float("inf")] + base[0][1][1:], 1),
        (1005, [], 2), (1006, base[3][1][:7], 1), base[0], base[0], base[7],  # short, empty, repeated
        *[(2000 + i, base[5][1], i % 2) for i in range(60)],  # ties
        (1007, [0.0] * 64, 3), (1010, [-x for x in base[0][1]], base[0][2]),
    ]
    df = session.createDataFrame(base + odd, SCHEMA)
    rows = [r.asDict() for r in df.collect()]
    want = brute(rows, lambda i: i % 5 == 0)
    assert found(df, F.col("id") % 5 == 0) == want
    for name in ("row", "parts", "id", "block", "size", "share", "limits", "score"):
        df = df.withColumn(name, F.lit("x"))
    assert found(df, F.col("id") % 5 == 0) == want
    assert found(df.limit(0), F.col("id") % 5 == 0) == []
    assert found(df, F.lit(False)) == []


def test_large_components(session):
    """Products beyond double precision stay exact."""
    rows = [(i, [40000.0 + i, 3.0 * i, -float(i)], i % 2) for i in range(40)]
    df = session.createDataFrame(rows, SCHEMA)
    given_rows = [r.asDict() for r in df.collect()]
    assert found(df, F.col("id") % 5 == 0) == brute(given_rows, lambda i: i % 5 == 0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-4000, 4000), min_size=16, max_size=16), min_size=2, max_size=12))
def test_bounds_hold_and_narrow(vectors):
    parts = np.array(vectors, np.int32)
    means, deviations = negatives.summaries(parts, negatives.LEVELS[-1])
    n = len(parts)
    packed = {c: np.arange(n, dtype=np.int64).tobytes() for c in ("id", "row", "label")} | {
        "parts": parts.tobytes(), "means": means.tobytes(), "deviations": deviations.tobytes()}
    block = negatives.Block(packed, 16)
    exact = parts.astype(np.int64) @ parts.astype(np.int64).T
    widths = []
    for level, segments in enumerate(negatives.LEVELS):
        direct = negatives.summaries(parts, segments)
        assert np.allclose(block.deviations[level], direct[1], atol=1e-6)
        low, high = negatives.bounds(block, np.arange(n), block, None, level)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).max())
    assert widths == sorted(widths, reverse=True) or max(widths) < 1


def test_bounds_spare_work(embeddings):
    """Of clustered vectors most pairs are dropped before they are scored."""
    rng = np.random.default_rng(3)
    centres = np.repeat(rng.normal(0, 60, (20, 16)), 4, axis=1)
    parts = np.floor(np.repeat(centres, 50, axis=0) + rng.normal(0, 6, (1000, 64))).astype(np.int32)
    means, deviations = negatives.summaries(parts, negatives.LEVELS[-1])
    packed = {c: np.arange(1000, dtype=np.int64).tobytes() for c in ("id", "row", "label")} | {
        "parts": parts.tobytes(), "means": means.tobytes(), "deviations": deviations.tobytes()}
    block, rows = negatives.Block(packed, 64), np.arange(20) * 50
    exact = parts[rows].astype(np.int64) @ parts.astype(np.int64).T
    fifth = np.sort(exact, axis=1)[:, -5].astype(float)
    left = np.ones((20, 1000), bool)
    for level in range(len(negatives.LEVELS)):
        low, high = negatives.bounds(block, rows, block, None, level)
        left &= high >= fifth[:, None]
    assert left.mean() < 0.1
