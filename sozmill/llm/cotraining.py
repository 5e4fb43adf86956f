"""Quality classifier by co-training on two views of a document.

One view is the text, the other the page's metadata. A classifier on each is
fitted on labelled documents; in rounds, each scores all documents and gives the other
those it is sure of, as pseudo-labels. Both are then calibrated on labelled documents that neither has
seen, and a last small model joins the two.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from .common import as_bytes, lean, slices, stored, with_fields
from .logistic import Climb, Linear, Standard, fit_logistic, probability, solve_logistic, sums
from .words import find_words, mix, row_shingles

#: Bound of the labelled rows that are fitted on, half of it for each label, on average over hashes of the ids.
LABELLED = 12_000
#: All pseudo-labels of a kind that a view gives in a round weigh as much as so many labels, together, or one each.
EXCHANGED = 1_500
ROUNDS = 3
#: Steps of Newton's method in a round, each a pass over all documents. A round begins where the one before ended.
STEPS = 5
#: A view is sure beyond this calibrated probability.
SURE = 0.97
#: One labelled document in so many is kept for the calibration.
CALIBRATION = 4
KEEP = 0.5

#: Fewer labels of a kind than this, in what is fitted or what is calibrated on, make no model.
LEAST = 5

HASHED_WORDS, HASHED_METADATA = 128, 32
_LENGTH_BINS = 8
# Classes of bytes for the text view: lower, upper, digit, blank, line end, point, symbol, other.
_POINTS = b".,;:?!'\"()-"
_CLASS = np.array([
    7 if i >= 128 else 0 if 97 <= i <= 122 else 1 if 65 <= i <= 90 else 2 if 48 <= i <= 57 else
    4 if i == 10 else 3 if i <= 32 else 5 if i in _POINTS else 6 for i in range(256)], dtype=np.int64)
_KINDS = 8
TEXT_SIZE = _KINDS * _KINDS + HASHED_WORDS + 5


def text_view(column: pa.Array) -> np.ndarray:
    """Features of whole texts: shares of byte class pairs and hashed words, and repetition."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    row = np.repeat(np.arange(n), np.diff(offsets))
    kind = _CLASS[raw]
    same = row[1:] == row[:-1]
    code = (row[1:] * _KINDS + kind[:-1]) * _KINDS + kind[1:]
    pairs = np.bincount(code[same], minlength=n * _KINDS * _KINDS).reshape(n, -1)
    words = find_words(column)
    counts, hashes = words.counts(), words.hashes()
    of = np.repeat(np.arange(n), counts)
    buckets = np.bincount(of * HASHED_WORDS + (hashes % np.uint64(HASHED_WORDS)).astype(np.int64),
                          minlength=n * HASHED_WORDS).reshape(n, -1)

    def distinct(values, rows):
        """Distinct values of each row."""
        order = np.argsort(values ^ mix(rows.astype(np.uint64) + np.uint64(1)), kind="stable")
        values, rows = values[order], rows[order]
        new = np.ones(len(values), dtype=bool)
        new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
        return np.bincount(rows[new], minlength=n)

    grams, at = row_shingles(words, hashes, 5)
    again = np.zeros(n)
    if len(hashes) > 1:
        again += np.bincount(of[1:][(hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])], minlength=n)
    some = np.maximum(counts, 1)
    gram_rows = of[at]
    rest = np.stack([
        np.log1p(counts) / 5, distinct(hashes, of) / some, again / some,
        distinct(grams, gram_rows) / np.maximum(np.bincount(gram_rows, minlength=n), 1),
        np.bincount(of, weights=words.end - words.start, minlength=n) / some / 10], axis=1)
    return np.concatenate([
        np.sqrt(pairs / np.maximum(pairs.sum(axis=1), 1)[:, None]),
        np.sqrt(buckets / some[:, None]), rest], axis=1).astype(np.float32)


def metadata_view(columns: list[pa.Array]) -> np.ndarray:
    """Features of metadata: one hashed value a text column, one length bin a number column; null is none."""
    parts = []
    for column in columns:
        number = pa.types.is_integer(column.type) or pa.types.is_floating(column.type)
        size = _LENGTH_BINS if number else HASHED_METADATA
        out = np.zeros((len(column), size), dtype=np.float32)
        if number:
            values = pc.cast(column, pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
            known = np.flatnonzero(np.isfinite(values))
            bins = np.log10(np.maximum(values[known], 1)) * _LENGTH_BINS / 6
            out[known, np.minimum(bins, _LENGTH_BINS - 1).astype(int)] = 1
        else:
            for i, value in enumerate(column.to_pylist()):
                if value is not None:
                    out[i, xxhash.xxh32_intdigest(str(value)) % size] = 1
        parts.append(out)
    return np.concatenate(parts, axis=1) if parts else np.zeros((0, 0), dtype=np.float32)


@dataclass
class CoModel:
    """A calibrated classifier on each view and the model that joins them."""

    views: tuple[Linear, Linear]
    scales: tuple[Linear, Linear]
    joined: Linear

    def calibrated(self, view: int, features: np.ndarray) -> np.ndarray:
        """Calibrated logits of one view."""
        return self.scales[view].logits(self.views[view].logits(features)[:, None])

    def scores(self, text: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        logits = np.stack([self.calibrated(0, text), self.calibrated(1, metadata)], axis=1)
        return probability(logits[:, 0]), probability(logits[:, 1]), probability(self.joined.logits(logits))


def views(docs: DataFrame, key: Column, text: str, metadata: list[str]) -> DataFrame:
    """``key, text_view, metadata_view`` of all documents; the views as packed floats."""
    def run(batches):
        for batch in batches:
            column = as_bytes(batch.column(1))
            for a, b in slices(column):
                part = batch.slice(a, b - a)
                first = text_view(column.slice(a, b - a)).astype(np.float16)
                second = metadata_view([part.column(i) for i in range(2, part.num_columns)]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), *[pa.array([x.tobytes() for x in v], pa.binary()) for v in (first, second)]],
                    ["key", "text_view", "metadata_view"])

    return docs.select(key.alias("key"), text, *metadata).mapInArrow(
        lean(run), "key long, text_view binary, metadata_view binary")


def _matrix(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.float16).reshape(len(values), -1).astype(np.float32)


def _hash_share(rows: DataFrame, counts: dict[int, int], bound: int) -> DataFrame:
    """About ``bound`` rows of each ``kind``, by a hash of the key."""
    share = F.lit(0)
    for kind, count in counts.items():
        share = F.when(F.col("kind") == kind, int(min(1.0, bound / count) * (1 << 30))).otherwise(share)
    return rows.filter(F.pmod(F.xxhash64("key", F.lit("share")), F.lit(1 << 30)) < share)


def _of_keys(known: DataFrame, keys: np.ndarray) -> DataFrame:
    """Rows whose key is in a bounded array."""
    shared = known.sparkSession.sparkContext.broadcast(keys)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(np.isin(batch.column(0).to_numpy(), shared.value)))

    return known.mapInArrow(lean(run), known.schema)


def _sure(known: DataFrame, model: CoModel, labelled: np.ndarray, run_batch, end, schema: str) -> DataFrame:
    """Runs ``run_batch(task, view, features of the other view, verdicts)`` on the rows of which a view is sure.

    Rows with ``labelled`` keys are left out. ``end(task)`` gives what a task adds to the result.
    """
    shared = known.sparkSession.sparkContext.broadcast((model, labelled))

    def run(batches):
        fitted, keys = shared.value
        task: dict = {}
        for batch in batches:
            batch = batch.filter(pa.array(~np.isin(batch.column(0).to_numpy(), keys)))
            if not batch.num_rows:
                continue
            features = [_matrix(batch.column(1)), _matrix(batch.column(2))]
            for view in (0, 1):
                p = probability(fitted.calibrated(view, features[view]))
                mask = (p >= SURE) | (p <= 1 - SURE)
                if mask.any():
                    run_batch(task, view, features[1 - view][mask], (p[mask] >= 0.5).astype(np.int64))
        yield from end(task)

    return known.mapInArrow(lean(run), schema)


def _sure_counts(known: DataFrame, model: CoModel, labelled: np.ndarray) -> np.ndarray:
    """Rows of which a view is sure, by view and verdict."""
    def run_batch(task, view, _, verdict):
        task[view] = task.get(view, 0) + np.bincount(verdict, minlength=2)

    def end(task):
        rows = [(view, kind, int(n)) for view, counts in task.items() for kind, n in enumerate(counts)]
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("view", "verdict", "n"), r)) for r in rows], pa.schema(
                [("view", pa.int32()), ("verdict", pa.int32()), ("n", pa.int64())]))

    found = _sure(known, model, labelled, run_batch, end, "view int, verdict int, n long")
    out = np.zeros((2, 2))
    for r in found.groupBy("view", "verdict").agg(F.sum("n").alias("n")).collect():
        out[r.view, r.verdict] = r.n
    return out


def _rows_added(found: DataFrame) -> dict[int, np.ndarray]:
    """By view, the sum of matrices that tasks gave row by row, as ``view, place, row``."""
    added = found.groupBy("view", "place").agg(
        vector_to_array(Summarizer.sum(array_to_vector("row"))).alias("row")).orderBy("view", "place").collect()
    out: dict[int, list] = {}
    for r in added:
        out.setdefault(r.view, []).append(r.row)
    return {view: np.array(rows) for view, rows in out.items()}


def _as_rows(view: int, matrix: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([view] * len(matrix), pa.int32()), pa.array(range(len(matrix)), pa.int32()),
         pa.array(matrix.tolist(), pa.list_(pa.float64()))], ["view", "place", "row"])


_ROWS = "view int, place int, row array<double>"


def _standards(known: DataFrame) -> list[Standard]:
    """Means and deviations of each view's features over all documents."""
    def run(batches):
        total: dict = {}
        for batch in batches:
            for view in (0, 1):
                x = _matrix(batch.column(1 + view)).astype(np.float64) if batch.num_rows else None
                if x is not None:
                    total[view] = total.get(view, 0.0) + np.stack([x.sum(axis=0), (x * x).sum(axis=0), np.full(x.shape[1], len(x))])
        for view, matrix in total.items():
            yield _as_rows(view, matrix)

    out = []
    for _, (total, squares, n) in sorted(_rows_added(known.mapInArrow(lean(run), _ROWS)).items()):
        middle = total / n
        out.append(Standard.of_moments(middle, np.sqrt(np.maximum(0.0, squares / n - middle ** 2))))
    return out


def _sure_sums(known: DataFrame, model: CoModel, labelled: np.ndarray, weight: np.ndarray,
               standards: list[Standard], at: list[np.ndarray]) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """For each view: log likelihood, gradient and curvature of all pseudo-labels that it is given.

    A task adds its rows up; the tasks' matrices are added in an aggregation, so that
    what reaches the driver has the size of one.
    """
    def run_batch(task, view, features, verdict):
        given = 1 - view
        value, gradient, curvature = sums(standards[given](features), verdict, weight[view][verdict], at[given])
        first = np.zeros(len(gradient))
        first[0] = value
        task[given] = task.get(given, 0.0) + np.concatenate([[first, gradient], curvature])

    def end(task):
        for view, matrix in task.items():
            yield _as_rows(view, matrix)

    added = _rows_added(_sure(known, model, labelled, run_batch, end, _ROWS))
    return [(float(m[0, 0]), m[1], m[2:]) for m in (
        added.get(view, np.zeros((len(w) + 2, len(w)))) for view, w in enumerate(at))]


def _labelled(known: DataFrame, labels: DataFrame, id: str, label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, labels and weights of a bounded draw, by label, from the documents that have one.

    The weights give each label its share of all labelled documents again.
    """
    truth = labels.groupBy(F.xxhash64(id).alias("key")).agg(F.avg(label).alias("label")).filter("label is not null")
    kind = (F.col("label") >= 0.5).cast("int").alias("kind")
    own = stored(truth.join(known.select("key").distinct(), "key", "left_semi").select("key", kind))
    counts = {r.kind: r.n for r in own.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = _hash_share(own, counts, LABELLED // 2).toArrow().sort_by("key")
    key, kinds = (sample.column(c).to_numpy() for c in ("key", "kind"))
    weight = np.ones(len(key))
    for k, n in counts.items():
        drawn = int((kinds == k).sum())
        weight[kinds == k] = n / max(1, drawn) * len(key) / sum(counts.values())
    return key, kinds.astype(float), weight


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
        metadata: tuple[str, ...] = ("lang", "source", "n_chars"), label: str = "quality") -> CoModel | None:
    """The model of ``docs`` that have a ``label`` of 0 or 1 in ``labels``.

    None where there are fewer than ``LEAST`` of either label: nothing can be told apart then. Several labels
    of an id are averaged, null ones left out; ids without a document do nothing. About
    ``LABELLED`` labelled rows are fitted on, drawn by label. All documents are scored in each round, and all
    of which a view is sure take part in the other's fit.
    """
    known = stored(views(docs.filter(F.col(id).isNotNull()), F.xxhash64(id), text, list(metadata)))
    key, y, weight = _labelled(known, labels, id, label)
    rows = _of_keys(known, key).dropDuplicates(["key"]).toArrow().sort_by("key")
    if not len(key):
        return None
    x = [_matrix(rows.column(name)) for name in ("text_view", "metadata_view")]
    held = mix(key.astype(np.uint64)) % np.uint64(CALIBRATION) == 0
    if min((y[part] == kind).sum() for part in (held, ~held) for kind in (0, 1)) < LEAST:
        return None
    standards = _standards(known)
    own = [standard(v[~held]) for standard, v in zip(standards, x)]
    at = [solve_logistic(v, y[~held], weight[~held]) for v in own]

    def model() -> CoModel:
        fitted = tuple(standard.linear(w) for standard, w in zip(standards, at))
        scales = tuple(fit_logistic(f.logits(v[held])[:, None], y[held], weight=weight[held]) for f, v in zip(fitted, x))
        return CoModel(fitted, scales, Linear(np.ones(2, dtype=np.float32), 0.0))

    for _ in range(ROUNDS):
        giver = model()
        counts = _sure_counts(known, giver, key)
        if not counts.any():
            break
        each = np.minimum(1.0, EXCHANGED / np.maximum(counts, 1))
        climbs = [Climb(w) for w in at]
        for _ in range(STEPS):
            given = _sure_sums(known, giver, key, each, standards, [c.at for c in climbs])
            moved = [
                climb.update(*(a + b for a, b in zip(sums(mine, y[~held], weight[~held], climb.at), more)))
                for climb, mine, more in zip(climbs, own, given)]
            if max(moved) < 1e-3:
                break
        at = [climb.best for climb in climbs]
    out = model()
    logits = np.stack([out.calibrated(view, x[view][held]) for view in (0, 1)], axis=1)
    out.joined = fit_logistic(logits, y[held], weight=weight[held])
    return out


def score(docs: DataFrame, model: CoModel | None, text: str = "text",
          metadata: tuple[str, ...] = ("lang", "source", "n_chars"), keep_text: bool = False) -> DataFrame:
    """``docs`` with ``text_score, metadata_score, score, kept``; the text only where wished.

    Scores are calibrated probabilities that the document is good; ``kept`` from
    ``KEEP`` on. Without a model the scores are null and all is kept. Null texts
    are empty texts, null metadata is none. Columns of these names are replaced.
    """
    added = ("text_score", "metadata_score", "score", "kept")
    docs = docs.drop(*added)
    others = [c for c in docs.columns if c != text]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    used = [f"__m{i}" for i in range(len(metadata))]

    def run(batches):
        for batch in batches:
            column = as_bytes(batch.column(text))
            for a, b in slices(column):
                part = batch.slice(a, b - a)
                if shared.value is None:
                    found = [pa.nulls(b - a, pa.float64())] * 3
                    kept = pa.array([True] * (b - a))
                else:
                    found = [pa.array(p) for p in shared.value.scores(
                        text_view(column.slice(a, b - a)).astype(np.float16).astype(np.float32),
                        metadata_view([part.column(c) for c in used]))]
                    kept = pa.array(found[2].to_numpy() >= KEEP)
                part = part.drop_columns(used if keep_text else [*used, text])
                for name, values in zip(added, [*found, kept]):
                    part = part.append_column(name, values)
                yield part

    out = docs if keep_text else docs.select(*others)
    columns = docs.columns if keep_text else [*others, text]
    return docs.select(*columns, *[F.col(c).alias(u) for c, u in zip(metadata, used)]).mapInArrow(
        lean(run), with_fields(out, "text_score double, metadata_score double, score double, kept boolean"))
