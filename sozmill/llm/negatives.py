"""Hard negatives of anchors by exact inner products, with bounds from segment summaries.

A vector is cut into segments; of each its mean and its deviation (the length of
what the mean leaves) are stored. Two vectors' inner product lies within the sum
over segments of ``width * mean * mean``, plus or minus the product of their
deviations. The bounds are computed from few segments first; pairs that can still
matter are refined with more segments, and the rest is scored exactly.

Vectors are packed into blocks once. Each block of anchors meets each block of
vectors; blocks, not pairs, are Spark's rows. What a task keeps for an anchor is
a bounded list of its best, which also raises the bound that later blocks must
reach. One pass finds the positives, a second one the negatives between their
limits.

Rows without id, label or vector, or with a null or non-finite component, take no
part, nor do rows of which a scaled component reaches ``2 ** 28``, as their products
pass 64 bits. Missing components of shorter vectors count as 0. Repeated rows are
rows of their own: each is an anchor, and one may be the other's positive. Ties go to the smaller
id. An empty table gives no row. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import lean, stored

#: Numbers of segments, coarse to fine; the finest is stored, the others follow from it.
LEVELS = (1, 4, 16)
VECTORS_PER_BLOCK, ANCHORS_PER_BLOCK = 4096, 1024
#: Anchors of a block that are bounded at once, and pairs that are refined at once.
ANCHORS_AT_ONCE, PAIRS_AT_ONCE = 256, 1 << 17
#: Above this share of pairs left, a level is computed for all of them by a matrix product.
DENSE = 0.1
#: Components below this add up exactly in double precision.
_EXACT, _LARGEST = 1 << 23, 1 << 28
_PACKED = "block long, size long, id binary, row binary, label binary, parts binary, means binary, deviations binary"


def eligible(vectors: DataFrame, id: str, vector: str, label: Column, scale: int) -> DataFrame:
    """``id, row, label, parts``: integer components of the rows that take part, stored.

    ``row`` is a unique number. ``label`` may be any type; equal values are one label.
    """
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    fine = F.forall(vector, lambda x: F.coalesce(
        x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < _LARGEST), F.lit(False)))
    rows = vectors.filter(F.col(id).isNotNull() & F.col(vector).isNotNull() & fine)
    return stored(rows.select(
        F.col(id).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
        F.when(label.isNotNull(), F.xxhash64(label)).alias("label"),
        scaled.cast("array<int>").alias("parts")).filter("label is not null"))


def summaries(parts: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the segments of each row."""
    cut = parts.reshape(len(parts), segments, -1).astype(np.float64)
    means = cut.mean(axis=2)
    return means, np.sqrt(((cut - means[:, :, None]) ** 2).sum(axis=2))


def coarser(means: np.ndarray, deviations: np.ndarray, width: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of fewer segments from those of more, which have ``width`` components."""
    rows = len(means)
    fine, spread = means.reshape(rows, segments, -1), deviations.reshape(rows, segments, -1)
    wide = fine.mean(axis=2)
    inside = (spread ** 2).sum(axis=2) + width * ((fine - wide[:, :, None]) ** 2).sum(axis=2)
    return wide, np.sqrt(inside)


class Block:
    """Some vectors with their summaries at every level, ready for matrix products."""

    def __init__(self, packed: dict, dimension: int):
        self.id, self.row, self.label = (np.frombuffer(packed[c], np.int64) for c in ("id", "row", "label"))
        self.parts = np.frombuffer(packed["parts"], np.int32).reshape(-1, dimension)
        self.large = self.parts.size and max(-int(self.parts.min()), int(self.parts.max())) >= _EXACT
        self.exact = self.parts.astype(np.int64 if self.large else np.float64)
        means, deviations = (np.frombuffer(packed[c], np.float64).reshape(-1, LEVELS[-1])
                             for c in ("means", "deviations"))
        width = dimension // LEVELS[-1]
        self.means, self.deviations = [], []
        for segments in LEVELS:
            m, d = coarser(means, deviations, width, segments)
            # Products of these are the terms of the bound.
            self.means.append(m * math.sqrt(dimension // segments))
            self.deviations.append(d)


def bounds(a: Block, rows: np.ndarray, b: Block, columns: np.ndarray | None, level: int):
    """Lower and upper bounds of inner products: of all pairs, or of the given ones, with room for rounding."""
    am, ad = a.means[level][rows], a.deviations[level][rows]
    if columns is None:
        middle, reach = am @ b.means[level].T, ad @ b.deviations[level].T
    else:
        middle = np.einsum("ij,ij->i", am, b.means[level][columns])
        reach = np.einsum("ij,ij->i", ad, b.deviations[level][columns])
    reach = reach + 1e-9 * (np.abs(middle) + reach) + 1e-6
    return middle - reach, middle + reach


def products(a: Block, rows: np.ndarray, b: Block, columns: np.ndarray | None) -> np.ndarray:
    """Exact integer inner products, as 64-bit integers."""
    if a.large or b.large:
        x, y = a.parts[rows].astype(np.int64), b.parts.astype(np.int64)
    else:
        x, y = a.exact[rows], b.exact
    out = x @ y.T if columns is None else np.einsum("ij,ij->i", x, y[columns])
    return out.astype(np.int64)


def surviving(a: Block, rows: np.ndarray, b: Block, allowed: np.ndarray, least: np.ndarray,
              most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Allowed pairs of ``rows`` of ``a`` and of ``b`` whose product is in ``least..most`` of the row.

    Gives places in ``rows``, places in ``b`` and products, a bounded number at a time.
    """
    mask, level = allowed, 0
    while level < len(LEVELS) and (mask.mean() > DENSE or not level):
        low, high = bounds(a, rows, b, None, level)
        mask = mask & (high >= least[:, None]) & (low <= most[:, None])
        level += 1
    if level == len(LEVELS) and mask.mean() > DENSE:
        score = products(a, rows, b, None)
        i, j = np.nonzero(mask & (score >= least[:, None]) & (score <= most[:, None]))
        yield i, j, score[i, j]
        return
    i, j = np.nonzero(mask)
    for start in range(0, len(i), PAIRS_AT_ONCE):
        x, y = i[start:start + PAIRS_AT_ONCE], j[start:start + PAIRS_AT_ONCE]
        for finer in range(level, len(LEVELS)):
            low, high = bounds(a, rows[x], b, y, finer)
            left = (high >= least[x]) & (low <= most[x])
            x, y = x[left], y[left]
        score = products(a, rows[x], b, y)
        left = (score >= least[x]) & (score <= most[x])
        yield x[left], y[left], score[left]


class Best:
    """The best ``k`` of each of some lists by score, ties by the smaller id."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.score = np.full((lists, k), np.iinfo(np.int64).min)
        self.id = np.full((lists, k), np.iinfo(np.int64).max)
        self.used = np.zeros(lists, np.int64)

    def least(self) -> np.ndarray:
        """Scores below these can't enter their list any more."""
        return np.where(self.used == self.k, self.score[:, -1], np.iinfo(np.int64).min).astype(np.float64)

    def add(self, lists: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(lists):
            return
        touched = np.unique(lists)
        known = np.repeat(touched, self.used[touched])
        slots = np.concatenate([np.arange(n) for n in self.used[touched]] or [np.empty(0, np.int64)]).astype(np.int64)
        lists = np.concatenate([lists, known])
        ids = np.concatenate([ids, self.id[known, slots]])
        scores = np.concatenate([scores, self.score[known, slots]])
        order = np.lexsort((ids, -scores, lists))
        lists, ids, scores = lists[order], ids[order], scores[order]
        first = np.flatnonzero(np.r_[True, lists[1:] != lists[:-1]])
        place = np.arange(len(lists)) - np.repeat(first, np.diff(np.r_[first, len(lists)]))
        kept = place < self.k
        self.id[lists[kept], place[kept]] = ids[kept]
        self.score[lists[kept], place[kept]] = scores[kept]
        self.used[touched] = np.minimum(np.bincount(lists, minlength=len(self.used))[touched], self.k)


def _pack(rows: DataFrame, dimension: int, size: int, extra: int = 0) -> DataFrame:
    """Blocks of at most ``size`` rows of one partition, with summaries; ``extra`` limits a row go along."""
    names = ["id", "row", "label"]

    def block(parts: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        vectors = np.zeros((table.num_rows, dimension), np.int32)
        lists = table["parts"].combine_chunks()
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.repeat(np.arange(len(lengths)), lengths)
        starts = np.cumsum(lengths) - lengths
        vectors[at, np.arange(lengths.sum()) - np.repeat(starts, lengths)] = lists.flatten().to_numpy()
        means, deviations = summaries(vectors, LEVELS[-1])
        columns = [table[c].to_numpy().astype(np.int64).tobytes() for c in names]
        columns += [vectors.tobytes(), means.tobytes(), deviations.tobytes()]
        if extra:
            columns.append(np.array(table["limits"].to_pylist(), np.int64).tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([table.num_rows])] + [pa.array([c], pa.binary()) for c in columns],
            names=["block", "size", *names, "parts", "means", "deviations"] + ["limits"] * bool(extra))

    def run(batches):
        held, count, number = [], 0, 0
        for batch in batches:
            while batch.num_rows:
                take = min(size - count, batch.num_rows)
                held.append(batch.slice(0, take))
                batch, count = batch.slice(take), count + take
                if count == size:
                    yield block(held, number)
                    held, count, number = [], 0, number + 1
        if count:
            yield block(held, number)

    return rows.mapInArrow(lean(run), _PACKED + (", limits binary" if extra else ""))


def _meet(anchors: DataFrame, blocks: DataFrame, dimension: int, run) -> DataFrame:
    """``run(anchors, blocks)`` in a task for each block of anchors and a share of the blocks of vectors.

    ``run`` gets one block of anchors and the blocks of the share one after the
    other; it gives a record batch of ``row, id, slot, best_id, score``. There are about as many
    tasks as shuffle partitions; beyond that many blocks of anchors each has one share.
    """
    spark = anchors.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = anchors.count()
    shares = max(1, -(-2 * tasks // max(1, n)))
    limits = "limits" in anchors.columns
    none = F.lit(None).cast("binary").alias("limits")
    columns = [c for c in blocks.columns if c not in ("block", "limits")]
    # One number for each block of anchors: a few bytes for a thousand of them.
    places = anchors.select("__place", (F.row_number().over(Window.orderBy("__place")) - 1).alias("at"))
    numbered = anchors.join(places, "__place")
    left = numbered.select("at", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"), F.lit(0).alias("kind"),
                           *columns, F.col("limits") if limits else none)
    right = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("at"),
                          F.pmod(F.xxhash64("__place"), F.lit(shares)).cast("int").alias("share"), F.lit(1).alias("kind"),
                          *columns, none) if n else blocks.limit(0).select(
        F.lit(0).alias("at"), F.lit(0).alias("share"), F.lit(1).alias("kind"), *columns, none)
    dealt = left.unionByName(right).repartition(tasks, "at", "share").sortWithinPartitions("at", "share", "kind")

    def task(batches):
        def rows():
            for batch in batches:
                for i in range(batch.num_rows):
                    yield batch.slice(i, 1).to_pylist()[0]

        stream = rows()
        row = next(stream, None)
        while row is not None:
            key, own = (row["at"], row["share"]), row
            row = next(stream, None)

            def mine():
                nonlocal row
                while row is not None and (row["at"], row["share"]) == key:
                    yield Block(row, dimension)
                    row = next(stream, None)

            if own["kind"]:  # a share without anchors
                for _ in mine():
                    pass
                continue
            yield run(Block(own, dimension), own["limits"], mine())

    return dealt.mapInArrow(lean(task), "row long, id long, slot int, best_id long, score long")


def _result(a: Block, best: Best, each: int) -> pa.RecordBatch:
    lists = np.repeat(np.arange(len(best.used)), best.used)
    places = (np.concatenate([np.arange(n) for n in best.used] or [np.empty(0)])).astype(np.int64)
    anchor = lists // each
    return pa.RecordBatch.from_arrays(
        [pa.array(a.row[anchor]), pa.array(a.id[anchor]), pa.array((lists % each).astype(np.int32)),
         pa.array(best.id[lists, places]), pa.array(best.score[lists, places])],
        ["row", "id", "slot", "best_id", "score"])


def _positives(k: int):
    def run(a: Block, _, blocks):
        best = Best(len(a.id), k)
        for b in blocks:
            for start in range(0, len(a.id), ANCHORS_AT_ONCE):
                rows = np.arange(start, min(start + ANCHORS_AT_ONCE, len(a.id)))
                allowed = (a.label[rows][:, None] == b.label) & (a.row[rows][:, None] != b.row)
                most = np.full(len(rows), np.inf)
                for i, j, score in surviving(a, rows, b, allowed, best.least()[rows], most):
                    best.add(rows[i], b.id[j], score)
        return _result(a, best, 1)

    return run


def _negatives(k: int, each: int):
    def run(a: Block, limits: bytes, blocks):
        ranges = np.frombuffer(limits, np.int64).reshape(len(a.id), each, 2)
        best = Best(len(a.id) * each, k)
        for b in blocks:
            for start in range(0, len(a.id), ANCHORS_AT_ONCE):
                rows = np.arange(start, min(start + ANCHORS_AT_ONCE, len(a.id)))
                own = ranges[rows]
                none = own[:, :, 0] > own[:, :, 1]
                # A score counts for a positive between its limits, and only while it can enter the list.
                least = np.maximum(own[:, :, 0], best.least().reshape(-1, each)[rows])
                least, most = np.where(none, np.inf, least), np.where(none, -np.inf, own[:, :, 1])
                allowed = a.label[rows][:, None] != b.label
                for i, j, score in surviving(a, rows, b, allowed, least.min(axis=1), most.max(axis=1)):
                    for s in range(each):
                        fits = (score >= own[i, s, 0]) & (score <= own[i, s, 1])
                        best.add(rows[i[fits]] * each + s, b.id[j[fits]], score[fits])
        return _result(a, best, each)

    return run


def _ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The best ``k`` over all tasks, ranked from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "best_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: Column, id: str = "vec_id", vector: str = "embedding", label: Column | None = None,
    positives: int = 5, negatives: int = 3, least_percent: int = 50, most_percent: int = 95, scale: int = 256,
) -> DataFrame:
    """``anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``id`` of the rows to start from. Components are
    ``floor(scale * x)``. A positive is one of the best rows of the anchor's
    label; a negative has another label and a score from ``least_percent`` to
    ``most_percent`` of the positive's. Positives without a negative give no row.
    """
    label = F.col("label") if label is None else label
    rows = eligible(vectors, id, vector, label, scale)
    chosen = rows.filter(anchors)
    longest, total = rows.agg(F.max(F.size("parts")), F.count(F.lit(1))).first()
    dimension = max(1, -(-(longest or 0) // LEVELS[-1])) * LEVELS[-1]
    many = max(1, -(-chosen.count() // ANCHORS_PER_BLOCK))

    def packed(df: DataFrame, parts: int, size: int, extra: int = 0) -> DataFrame:
        place = F.monotonically_increasing_id().alias("__place")
        return stored(_pack(df.repartition(parts), dimension, size, extra).select("*", place))

    blocks = packed(rows, max(1, -(-total // VECTORS_PER_BLOCK)), VECTORS_PER_BLOCK)
    asking = packed(chosen, many, ANCHORS_PER_BLOCK)
    found = stored(_ranked(_meet(asking, blocks, dimension, _positives(positives)), positives, "row").select(
        "row", F.col("best_id").alias("positive_id"), F.col("rank").alias("positive_rank"),
        F.col("score").alias("positive_score")))

    low = F.ceil(F.col("positive_score") * F.lit(least_percent).cast("decimal(20,0)") / 100).cast("long")
    high = F.floor(F.col("positive_score") * F.lit(most_percent).cast("decimal(20,0)") / 100).cast("long")
    lists = found.groupBy("row").agg(F.sort_array(F.collect_list(
        F.struct("positive_rank", low.alias("low"), high.alias("high")))).alias("l"))
    none = F.array(F.lit(1).cast("long"), F.lit(0).cast("long"))  # an empty range
    limits = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.when(
        i < F.size("l"), F.array(F.get("l", i)["low"], F.get("l", i)["high"])).otherwise(none)))
    asked = chosen.join(lists, "row").select(*chosen.columns, limits.alias("limits"))
    asking = packed(asked, many, ANCHORS_PER_BLOCK, positives)
    hard = _ranked(_meet(asking, blocks, dimension, _negatives(negatives, positives)), negatives, "row", "slot")
    return hard.withColumn("positive_rank", F.col("slot") + 1).join(found, ["row", "positive_rank"]).select(
        F.col("id").alias("anchor_id"), "positive_id", "positive_rank", "rank", F.col("best_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
