import numpy as np
from pyspark.sql import functions as F

from sozmill.llm import cotraining
from sozmill.llm.queries import op1_cotrained_quality

SF = "/root/testdata/sf0.1"


def test_quality_of_labelled_documents(session):
    labels = session.read.parquet(f"{SF}/labels.parquet")
    rows = op1_cotrained_quality(session, SF).join(labels, "doc_id").collect()
    good, bad = ([r for r in rows if r.quality == k] for k in (1, 0))
    assert sum(r.kept for r in good) >= 0.995 * len(good)
    assert sum(r.kept for r in bad) <= 0.05 * len(bad)
    assert all(0 <= r.score <= 1 for r in rows)


def test_views_exchange(session, monkeypatch):
    """Sure verdicts of one view become examples of the other, all of them."""
    given = []
    real = cotraining._sure_counts
    monkeypatch.setattr(cotraining, "_sure_counts", lambda *a: given.append(real(*a)) or given[-1])
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cotraining.fit(docs, session.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    assert len(given) == cotraining.ROUNDS
    assert max(counts.max() for counts in given) > 0


def plain_fit(x, weight, y, ridge=1.0):
    """Logistic regression in memory, by steps that can't overshoot: a quarter bounds the curvature."""
    w = np.zeros(x.shape[1])
    penalty = np.r_[np.full(x.shape[1] - 1, ridge), 1e-6]
    inverse = np.linalg.inv((x.T * weight) @ x / 4 + np.diag(penalty))
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = inverse @ (x.T @ (weight * (y - p)) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    return w


def test_equals_co_training_in_memory(session, monkeypatch):
    """The same rounds on plain matrices, where each view gets every verdict the other is sure of."""
    monkeypatch.setattr(cotraining, "STEPS", 30)
    monkeypatch.setattr(cotraining, "EXCHANGED", 40)
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = cotraining.fit(docs, labels)
    key = F.xxhash64("doc_id")
    rows = cotraining.views(docs, key, "text", ["lang", "source", "n_chars"]).toArrow().sort_by("key")
    keys = rows["key"].to_numpy()
    x = [np.frombuffer(b"".join(rows[c].to_pylist()), np.float16).reshape(len(keys), -1).astype(np.float64)
         for c in ("text_view", "metadata_view")]
    truth = {r.k: r.quality for r in labels.select(key.alias("k"), "quality").collect()}
    labelled = np.array([k in truth for k in keys.tolist()])
    y = np.array([truth.get(k, 0) for k in keys.tolist()], float)
    held = labelled & (cotraining.mix(keys.astype(np.uint64)) % np.uint64(cotraining.CALIBRATION) == 0)
    own = labelled & ~held
    z = []
    for v in x:
        middle, spread = v.mean(axis=0), v.std(axis=0)
        z.append(np.c_[(v - middle) / np.where(spread < 1e-6, np.inf, spread), np.ones(len(v))])
    w = [plain_fit(v[own], np.ones(own.sum()), y[own]) for v in z]

    def calibrated():
        out = []
        for v, u in zip(z, w):
            logit = v @ u
            middle, spread = logit[held].mean(), logit[held].std()
            scaled = np.c_[(logit - middle) / spread, np.ones(len(v))]
            out.append(scaled @ plain_fit(scaled[held], np.ones(held.sum()), y[held]))
        return out

    for _ in range(cotraining.ROUNDS):
        p = [1 / (1 + np.exp(-c)) for c in calibrated()]
        new = []
        for view in (0, 1):
            other = p[1 - view]
            sure = ~labelled & ((other >= cotraining.SURE) | (other <= 1 - cotraining.SURE))
            verdict = (other[sure] >= 0.5).astype(float)
            counts = np.bincount(verdict.astype(int), minlength=2)
            each = np.minimum(1, 40 / np.maximum(counts, 1))[verdict.astype(int)]
            new.append(plain_fit(np.r_[z[view][own], z[view][sure]], np.r_[np.ones(own.sum()), each], np.r_[y[own], verdict]))
        w = new
    want = calibrated()
    for view in (0, 1):
        got = model.calibrated(view, x[view].astype(np.float32))
        assert np.abs(1 / (1 + np.exp(-got)) - 1 / (1 + np.exp(-want[view]))).max() < 0.01


def test_labels_are_drawn_by_kind_from_documents(session, monkeypatch):
    """A rare label, and many labels of ids without a document, leave enough of both to fit on."""
    monkeypatch.setattr(cotraining, "LABELLED", 100)
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    strangers = session.range(50_000).select((F.col("id") + 10**9).alias("doc_id"), F.lit(1).alias("quality"))
    known = cotraining.views(docs, F.xxhash64("doc_id"), "text", ["lang"])
    key, kind, weight = cotraining._labelled(known, labels.unionByName(strangers), "doc_id", "quality")
    bad = labels.filter("quality = 0").count()
    assert (kind == 0).sum() >= min(30, bad) and 20 < (kind == 1).sum() < 90
    assert abs(weight.sum() - len(key)) < 1e-6
    assert abs(weight[kind == 0].sum() / weight.sum() - bad / labels.count()) < 1e-6


def test_without_labels(session, documents, odd):
    labels = session.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert cotraining.fit(documents, labels) is None
    assert cotraining.fit(documents, labels.limit(0)) is None
    rows = cotraining.score(odd.withColumn("score", F.lit("clash")), None).collect()
    assert len(rows) == odd.count() and all(r.kept and r.score is None for r in rows)


def test_odd_rows(session, odd):
    docs = session.read.parquet("/root/testdata/sf0.01/documents.parquet").unionByName(odd)
    labels = session.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    labels = labels.unionByName(labels.limit(20).withColumn("quality", F.lit(None).cast("int"))).unionByName(labels.limit(9))
    model = cotraining.fit(docs, labels)
    kept = cotraining.score(odd, model, keep_text=True)
    assert kept.columns == [*odd.columns, "text_score", "metadata_score", "score", "kept"]
    assert kept.count() == odd.count()
    assert cotraining.score(odd.limit(0), model).count() == 0


def test_text_view(session):
    import pyarrow as pa

    texts = ["", "ab AB 12", "x x x x x x x x x x", "one two three four five six"]
    view = cotraining.text_view(pa.array([t.encode() for t in texts], pa.large_binary()))
    assert view.shape == (4, cotraining.TEXT_SIZE) and np.isfinite(view).all()
    distinct, again, grams = view[:, -4], view[:, -3], view[:, -2]
    assert distinct[2] == np.float32(0.1) and distinct[3] == 1
    assert again[2] == np.float32(0.9) and grams[3] == 1 and grams[2] == np.float32(1 / 6)
    alone = cotraining.text_view(pa.array([texts[1].encode()], pa.large_binary()))
    assert np.allclose(alone[0], view[1])
