"""Contiguous shards of least maximal size over ordered atomic groups.

Groups are equal texts, ordered by a 64-bit hash. The smallest shard capacity
is found by binary search, where a greedy pass checks a capacity. The driver
never sees the groups: it keeps sums over ranges of the key. Cutting ranges
anywhere gives a lower bound of the capacity, leaving them whole an upper one;
only the ranges at these cuts, two for each shard at most, are split further, by
one small aggregation for each level, until the bounds meet.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import stored

FIRST_BITS, MORE_BITS = 12, 6
ROWS_PER_BUCKET = 100_000
_HIGH = (1 << 63) - 1


class Ranges:
    """Ordered key ranges that have rows: first key, last key, size."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        self.rows = sorted(rows)
        self.low = [r[0] for r in self.rows]
        self.sums = np.concatenate([[0], np.cumsum([r[2] for r in self.rows], dtype=np.int64)])
        self.open = np.array([a < b for a, b, _ in self.rows], dtype=bool)  # more than one group

    @property
    def largest_group(self) -> int:
        """The largest range of a single group; no capacity is below it."""
        return max((r[2] for r, more in zip(self.rows, self.open) if not more), default=0)

    @property
    def total(self) -> int:
        return int(self.sums[-1])

    def at(self, position: int) -> int:
        """The range that holds a position of the running size."""
        return int(np.searchsorted(self.sums, position, "right")) - 1

    def cuts(self, capacity: int, n: int, fluid: bool) -> list[int] | None:
        """Greedy cut positions for a capacity, None if ``n`` shards are too few.

        ``fluid`` lets open ranges be cut anywhere, which gives a lower bound;
        else they stay whole, which gives an upper one.
        """
        position, out = 0, []
        for _ in range(n):
            goal = position + capacity
            if goal >= self.total:
                return out + [self.total] * (n - len(out))
            i = self.at(goal)
            goal = goal if fluid and self.open[i] else int(self.sums[i])
            if goal <= position:
                return None
            position = goal
            out.append(position)
        return None

    def least(self, n: int, fluid: bool) -> int:
        """Smallest feasible capacity, by binary search."""
        low, high = max(1, -(-self.total // n)), self.total
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.cuts(middle, n, fluid) else (middle + 1, high)
        return low

    def even_cuts(self, capacity: int, n: int) -> tuple[list[int], set[int]]:
        """Cuts as even as the least capacity allows, and open ranges that they would split.

        A shard takes its equal share of what is left, rounded to a group,
        never more than the capacity, never so little that the rest no longer fits.
        """
        latest = [self.total] * (n + 1)
        for k in range(n - 1, 0, -1):
            latest[k] = int(self.sums[np.searchsorted(self.sums, latest[k + 1] - capacity, "left")])
        position, out, wanted = 0, [], set()
        for k in range(1, n):
            goal = position + (self.total - position) / (n - k + 1)
            i = min(self.at(int(goal)), len(self.rows) - 1)
            if self.open[i]:
                wanted.add(i)
            near = min((int(self.sums[i]), int(self.sums[i + 1])), key=lambda s: abs(s - goal))
            last = int(self.sums[np.searchsorted(self.sums, position + capacity, "right") - 1])
            position = max(position, latest[k], min(near, last))
            out.append(position)
        return out, wanted


def _summed(cells: DataFrame, *by) -> list[tuple[int, int, int]]:
    rows = cells.groupBy(*by).agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.sum("size").alias("size"))
    return [tuple(r) for r in rows.select("low", "high", "size").collect()]


def _first(groups: DataFrame) -> list[tuple[int, int, int]]:
    """Sizes of the first cells, which share their upper ``FIRST_BITS`` bits."""
    return _summed(groups, F.shiftright("key", 64 - FIRST_BITS))


def _split(groups: DataFrame, ranges: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Sizes of the parts of some key ranges: each is cut into ``2 ** MORE_BITS`` at most.

    A range lies inside one first cell, which is the key of the join with the
    few ranges, at most two for each cut between shards.
    """
    rows = [(low >> (64 - FIRST_BITS), low, high, max(0, (high - low).bit_length() - MORE_BITS))
            for low, high in ranges]
    wanted = groups.sparkSession.createDataFrame(rows, "cell long, first long, last long, bits int")
    inside = groups.withColumn("cell", F.shiftright("key", 64 - FIRST_BITS)).join(
        F.broadcast(wanted), "cell").filter(F.col("key").between(F.col("first"), F.col("last")))
    return _summed(inside, "first", F.expr("shiftright(key, bits)"))


def _undecided(found: Ranges, n: int, low: int, high: int) -> set[int]:
    """Open ranges that are cut by the greedy passes for the two bounds.

    At least one is: cuts for the lower bound that split no range would make it the least capacity.
    """
    cuts = [*found.cuts(low, n, True), *found.cuts(high, n, False)]
    last = len(found.rows) - 1
    return {i for i in (min(found.at(c), last) for c in cuts) if found.open[i]}


def minimax_cuts(groups: DataFrame, n: int) -> list[int]:
    """Keys at which shards 1 to ``n - 1`` begin, for rows of ``key, size``.

    Rows of one key are one group. An empty table has no cuts, all in shard 0.
    """
    rows = _first(groups)
    while rows:
        found = Ranges(rows)
        low, high = max(found.least(n, True), found.largest_group), found.least(n, False)
        if low < high:
            wanted = _undecided(found, n, low, high)
        else:
            cuts, wanted = found.even_cuts(high, n)
        if not wanted:
            return [found.low[i] if i < len(found.rows) else _HIGH
                    for i in (int(np.searchsorted(found.sums, c, "left")) for c in cuts)]
        part = _split(groups, [found.rows[i][:2] for i in sorted(wanted)])
        rows = [r for i, r in enumerate(found.rows) if i not in wanted] + part
    return []


def numbered(rows: DataFrame, group: str, row: str, slot: str) -> DataFrame:
    """Gapless numbers from 0 inside each ``group``, in no stated order.

    Rows are dealt into buckets of bounded size by the unique ``row``; a bucket
    starts where those before it end, so no group is numbered in one task.
    """
    total = rows.count()
    buckets = max(1, -(-total // ROWS_PER_BUCKET))
    dealt = rows.withColumn("__bucket", F.pmod(F.xxhash64(row), F.lit(buckets)))
    counts = dealt.groupBy(group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(group).orderBy("__bucket")) - F.col("__n")
    starts = counts.select(group, "__bucket", before.alias("__start"))
    inside = F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(row))
    return dealt.withColumn("__in", inside).join(starts, [group, "__bucket"]).withColumn(
        slot, (F.col("__start") + F.col("__in") - 1).cast("long")).drop(
        "__bucket", "__in", "__start")


def shard(docs: DataFrame, n: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``id, size, text_crc32, shard, slot``; equal texts stay together.

    A row weighs the UTF-8 bytes of its text and one more; null weighs one and
    goes with the empty text. Repeated rows are as many rows. Texts are read
    once and never shuffled: a row is a few numbers from then on. A group
    larger than an equal share sets the capacity, and its shard is larger.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = stored(docs.select(
        F.col(id), (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"), F.xxhash64(content).alias("key"),
        F.monotonically_increasing_id().alias("__row")))
    cuts = minimax_cuts(narrow.select("key", "size"), n)
    number = sum(((F.col("key") >= c).cast("int") for c in cuts), F.lit(0))
    placed = narrow.withColumn("shard", number.cast("int"))
    return numbered(placed, "shard", "__row", "slot").select(id, "size", "text_crc32", "shard", "slot")
