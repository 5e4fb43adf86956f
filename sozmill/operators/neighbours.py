"""Exact nearest neighbours with pivots and triangle bounds.

On vectors of length one the distance ``sqrt(2 - 2 cosine)`` is a metric. A batch of
vectors is grouped by the nearest of a few pivots, sorted by the distance to it and cut
into runs. Only those can be nearer to a seed than the best found so far whose distance to
the pivot differs from the seed's by no more; runs without such vectors are passed over.
A run is scored with all seeds that need it by one product in single precision. Pairs that
its rounding leaves in question are scored again in double, which decides. A task keeps
``k`` words a seed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Pivots: vectors taken by the hash of their word. Seeds that go to all tasks, if there are no more.
PIVOTS = 32
SEEDS_AT_ONCE = 1000
#: Bytes of seeds, as doubles, that a task holds otherwise.
HELD = 16 << 20
#: Rows of a run, how far apart their distances to the pivot may be, seeds scored with it at once, pairs scored again at once.
RUN, WIDTH, SEEDS_A_RUN, PAIRS = 512, 0.125, 1024, 1 << 15
#: Room for rounding in the bounds; scores themselves decide.
SLACK = 1e-7
FOUND = "seed string, word string, cosine double"


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of ``size`` components; another length gives zeros, which have no direction."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    fits = np.nan_to_num(lengths.astype(float)) == size
    out = np.zeros((len(column), size))
    if fits.any():
        values = column.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        out[fits] = values.reshape(-1, size)
    return out


def unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one, and which rows have a direction at all."""
    length = np.sqrt((rows * rows).sum(axis=1))
    fine = np.isfinite(length) & (length > 0)
    return np.where(fine[:, None], rows / np.where(fine, length, 1.0)[:, None], 0.0), fine


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class Search:
    """The best ``k`` words of some seeds over batches of vectors."""

    def __init__(self, seeds: list[str], vectors: np.ndarray, pivots: np.ndarray, k: int):
        self.seeds, self.k = seeds, k
        self.vectors, self.fine = unit(vectors)
        self.rough = self.vectors.astype(np.float32)
        # Twice what rounding to single precision and the sum of so many products can change.
        self.slack = (vectors.shape[1] + 4) * 2.0**-23
        self.pivots = pivots
        self.to_pivots = _distance(pivots, self.vectors)
        self.places: dict[str, list[int]] = {}
        for i, seed in enumerate(seeds):
            self.places.setdefault(seed, []).append(i)
        self.best: list[list[tuple[float, str]]] = [[] for _ in seeds]
        #: Score of the last word of a full list, and its distance.
        self.least = np.full(len(seeds), -np.inf)
        self.reach = np.where(self.fine, np.inf, -np.inf)
        self.pairs = self.scored = 0

    def _add(self, seed: int, words: np.ndarray, ranks: np.ndarray, scores: np.ndarray) -> None:
        if len(scores) > self.k:
            first = np.lexsort((ranks, -scores))[: self.k]
            words, scores = words[first], scores[first]
        best = self.best[seed] + [(-float(s), str(w)) for s, w in zip(scores, words)]
        # Words sort by UTF-8 bytes, as in Spark.
        best = self.best[seed] = sorted(best, key=lambda b: (b[0], b[1].encode()))[: self.k]
        if len(best) == self.k:
            self.least[seed] = -best[-1][0]
            self.reach[seed] = np.sqrt(max(0.0, 2.0 + 2.0 * best[-1][0])) + SLACK

    def feed(self, words: np.ndarray, vectors: np.ndarray) -> None:
        rows, fine = unit(vectors)
        words, rows = words[fine], rows[fine]
        if not len(words) or not self.fine.any():
            return
        self.pairs += int(self.fine.sum()) * len(rows)
        distance = _distance(rows, self.pivots)
        nearest = distance.argmin(axis=1)
        own = distance[np.arange(len(rows)), nearest]
        order = np.lexsort((own, nearest))
        words, rows, own, nearest = words[order], rows[order], own[order], nearest[order]
        ranks = np.empty(len(words), np.int64)
        ranks[np.argsort(words, kind="stable")] = np.arange(len(words))
        same = [(j, i) for j, word in enumerate(words) for i in self.places.get(word, ())]
        same = np.array(same, np.int64).reshape(-1, 2)
        batch = words, ranks, rows, rows.astype(np.float32), same

        bands = (own / WIDTH).astype(int)
        cuts = np.flatnonzero((nearest[1:] != nearest[:-1]) | (bands[1:] != bands[:-1])) + 1
        runs = [(start, min(start + RUN, stop)) for first, stop in zip(np.r_[0, cuts], np.r_[cuts, len(rows)])
                for start in range(first, stop, RUN)]
        # The group of a seed's nearest pivot goes first, as it shortens the reach for the others.
        groups = np.unique(nearest)
        home = groups[self.to_pivots[groups].argmin(axis=0)]
        members = {g: np.flatnonzero(home == g) for g in groups}
        for start, stop in runs:
            near = members[nearest[start]]
            for i in range(0, len(near), SEEDS_A_RUN):
                self._score(near[i:i + SEEDS_A_RUN], nearest[start], own, start, stop, batch)
        for start, stop in runs:
            for i in range(0, len(home), SEEDS_A_RUN):
                others = i + np.flatnonzero(home[i:i + SEEDS_A_RUN] != nearest[start])
                self._score(others, nearest[start], own, start, stop, batch)

    def _score(self, asked: np.ndarray, group: int, own: np.ndarray, start: int, stop: int, batch: tuple) -> None:
        """Score the rows from ``start`` to ``stop``, a run of ``group``, with those seeds of ``asked`` that they may be near to."""
        centre = self.to_pivots[group, asked]
        gap = np.maximum(0.0, np.maximum(own[start] - centre, centre - own[stop - 1]))
        asked = asked[gap <= self.reach[asked]]
        if not len(asked):
            return
        words, ranks, rows, rough_rows, same = batch
        self.scored += len(asked) * (stop - start)
        rough = self.rough[asked] @ rough_rows[start:stop].T
        # No word is its own neighbour.
        low, high = np.searchsorted(same[:, 0], (start, stop))
        if low < high:
            row, seed = same[low:high, 0] - start, same[low:high, 1]
            place = np.minimum(np.searchsorted(asked, seed), len(asked) - 1)
            met = asked[place] == seed
            rough[place[met], row[met]] = -np.inf
        top = rough.max(axis=1)
        some = np.flatnonzero((top >= self.least[asked] - self.slack) & (top > -np.inf))
        if not len(some):
            return
        asked, rough = asked[some], rough[some]
        floor = self.least[asked] - self.slack
        if rough.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(rough, -self.k, axis=1)[:, -self.k] - 2 * self.slack)
        at, row = np.nonzero((rough >= floor[:, None]) & (rough > -np.inf))
        scores = np.empty(len(at))
        for i in range(0, len(at), PAIRS):
            part = slice(i, i + PAIRS)
            scores[part] = (rows[start + row[part]] * self.vectors[asked[at[part]]]).sum(axis=1)
        row += start
        ends = np.searchsorted(at, np.arange(len(asked) + 1))
        for i, seed in enumerate(asked):
            found = row[ends[i]:ends[i + 1]]
            self._add(seed, words[found], ranks[found], scores[ends[i]:ends[i + 1]])

    def result(self) -> pa.RecordBatch:
        """The lists, and a row without a word for the pairs met and one for those scored."""
        rows = [(s, w, -score) for s, best in zip(self.seeds, self.best) for score, w in best]
        rows += [("pairs", None, float(self.pairs)), ("scored", None, float(self.scored))]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64()))],
            ["seed", "word", "cosine"])


def _words(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=object)


def search(vectors: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """``seed, word, cosine``: of each task and seed the best ``k`` other words, and the work done.

    ``vectors`` and ``seeds`` have ``word`` and ``vector``. Up to ``SEEDS_AT_ONCE`` seeds go to
    all tasks, and vectors stay where they are. More seeds are cut into blocks of up to ``HELD`` bytes and
    vectors into shares, both by hash, and each block meets each share in a partition of its own. There are
    at least as many as shuffle partitions, cut so that the fewest rows are sent.
    Rows without a word give the pairs a task met and how many it scored.
    """
    spark = vectors.sparkSession
    # Floats are sent as they are, all else as doubles.
    floats = all(df.schema["vector"].dataType == T.ArrayType(T.FloatType(), df.schema["vector"].dataType.containsNull)
                 for df in (vectors, seeds))
    value = F.col("vector").cast("array<float>" if floats else "array<double>").alias("vector")
    table = vectors.select("word", value).filter(F.col("word").isNotNull() & F.col("vector").isNotNull())
    chosen = table.orderBy(F.xxhash64("word"), "word").limit(PIVOTS).collect()
    if not chosen:
        return spark.createDataFrame([], FOUND)
    lengths = Counter(len(r.vector) for r in chosen)
    size = max(lengths, key=lambda n: (lengths[n], n))  # a model has one; others have no direction
    given = np.array([r.vector if len(r.vector) == size else [0.0] * size for r in chosen], np.float64)
    pivots, fine = unit(np.nan_to_num(given))
    pivots = pivots[fine] if fine.any() else np.eye(1, size)
    asked = seeds.select("word", value)
    rows = asked.limit(SEEDS_AT_ONCE + 1).collect()
    if len(rows) <= SEEDS_AT_ONCE:
        shared = spark.sparkContext.broadcast((pivots, [r.word for r in rows], np.array(
            [r.vector if r.vector and len(r.vector) == size else [0.0] * size for r in rows], np.float64).reshape(-1, size)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            near, names, wanted = shared.value
            found = Search(names, wanted, near, k)
            for batch in batches:
                found.feed(_words(batch.column(0)), _matrix(batch.column(1), size))
            yield found.result()

        return table.mapInArrow(run, FOUND)

    parts, n_seeds = int(spark.conf.get("spark.sql.shuffle.partitions")), asked.count()
    # Seeds are sent to each share and vectors to each block.
    blocks = max(-(-n_seeds * 8 * max(size, 1) // HELD), round(math.sqrt(parts * n_seeds / table.count())), 1)
    shares = max(1, -(-parts // blocks))
    shared = spark.sparkContext.broadcast(pivots)

    def cell(block: Column, share: Column) -> Column:
        return (block * shares + share).cast("int").alias("cell")

    def dealt_by(seed: int, n: int) -> Column:
        return F.pmod(F.xxhash64("word", F.lit(seed)), F.lit(n))

    def every(n: int) -> Column:
        return F.sequence(F.lit(0), F.lit(n - 1))

    left = asked.withColumn("share", F.explode(every(shares))).select(
        cell(dealt_by(0, blocks), F.col("share")), F.lit(0).alias("kind"), "word", "vector")
    right = table.withColumn("block", F.explode(every(blocks))).select(
        cell(F.col("block"), dealt_by(1, shares)), F.lit(1).alias("kind"), "word", "vector")
    dealt = left.unionByName(right).repartitionById(blocks * shares, F.col("cell")).sortWithinPartitions("cell", "kind")

    def run_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, held, found = None, [], [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
            starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
            for start, stop in zip(starts, np.r_[starts[1:], len(keys)]):
                here, kind = keys[start]
                part = batch.slice(start, stop - start)
                words, matrix = _words(part.column(2)), _matrix(part.column(3), size)
                if key != here:
                    if found is not None:
                        yield found.result()
                    key, names, held, found = here, [], [], None
                if kind == 0:
                    names += list(words)
                    held.append(matrix)
                    continue
                if found is None:
                    found = Search(names, np.concatenate(held) if held else np.zeros((0, size)), shared.value, k)
                found.feed(words, matrix)
        if found is not None:
            yield found.result()

    return dealt.mapInArrow(run_blocks, FOUND)


def work(found: DataFrame) -> DataFrame:
    """One row: ``pairs`` of seeds and vectors, and how many were ``scored``; ``found`` comes from ``search``."""
    def total(name: str):
        return F.coalesce(F.sum(F.when(F.col("word").isNull() & (F.col("seed") == name), F.col("cosine"))), F.lit(0.0))

    return found.agg(*[total(n).cast("long").alias(n) for n in ("pairs", "scored")])
