"""Merkle manifest of a table: a tree for each group of rows, and a tree over the groups.

Every node carries the interval ``[low, high)`` of the leaf ranks it covers.
The levels are built ``BITS`` at a time: the nodes whose intervals share an
ancestor that many levels up form a block of at most ``2 ** BITS``, which is one
small row. Blocks meet the rows of their ancestors in a join on that bucket and
containment of the intervals, from the top down, so a leaf is joined once and no
key of a join has more than one block. What an interval leaves of its parent's
names the sibling.

The leaves of a group are the rows in ascending order (null first; rows of equal
order follow by digest). Nodes are paired two by two and a last node without a
partner is hashed alone, until one is left; a lone leaf is itself the root of its
group. Rows of a null group are a group, ahead of all others. Repeated rows are
as many leaves. An empty table has no node and gives no row. Only the named
columns are read, so names of other columns can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

#: Levels in a block: it holds at most 256 nodes of its lowest level.
BITS = 8


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[encoded(v) for v in values])


def _bucket(low: Column, bits: int) -> Column:
    return F.shiftright(low, bits)


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``low``, the rank in its ``tree`` from 0, ``high`` and ``n``, the rows of the tree.

    Rows are sorted by ranges; counts by range and tree, of which there are few,
    give where each begins. Ties beyond ``order`` are broken by the place in the
    stored table, so equal rows are spread, too.
    """
    by = ["tree", *order, "__place"]
    kept = stored(rows.withColumn("__place", F.monotonically_increasing_id()))
    placed = stored(kept.repartitionByRange(*by).sortWithinPartitions(*by).drop("__place").select(
        "*", F.monotonically_increasing_id().alias("__at")))
    # The upper bits of such an id are its partition.
    part = _bucket(F.col("__at"), 33).alias("__part")
    counts = placed.groupBy("tree", part).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    tree = Window.partitionBy("tree")
    starts = counts.select(
        "tree", "__part", "__first",
        (F.sum("__rows").over(tree.orderBy("__part")) - F.col("__rows")).alias("__start"),
        F.sum("__rows").over(tree).alias("n"))
    low = F.col("__start") + F.col("__at") - F.col("__first")
    return placed.withColumn("__part", part).join(starts, ["tree", "__part"]).select(
        *rows.columns, low.alias("low"), (low + 1).alias("high"), "n")


def _parents(nodes: Column) -> Column:
    """The level above some nodes: two by two, the last maybe alone."""
    def parent(i: Column) -> Column:
        left, right = F.get(nodes, 2 * i), F.get(nodes, 2 * i + 1)
        return F.struct(
            left["low"].alias("low"), F.coalesce(right["high"], left["high"]).alias("high"),
            digest(left["digest"], F.coalesce(right["digest"], F.lit(""))).alias("digest"))

    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int")), parent)


def _blocks(nodes: DataFrame, unit: int, *payload: str) -> DataFrame:
    """Blocks of ``nodes``, which are ``unit`` levels above the leaves, with all their levels.

    Columns: ``tree, block, n, members, levels`` and ``height``: how many levels
    the block has above its members. It is ``BITS`` unless the tree ends in it.
    """
    grouped = nodes.groupBy("tree", _bucket(F.col("low"), unit + BITS).alias("block")).agg(
        F.first("n").alias("n"),
        F.sort_array(F.collect_list(F.struct("low", "high", "digest", *payload))).alias("members"))
    # ceil(log2(n)), BITS at most.
    height = sum(((F.col("n") > (1 << k)).cast("int") for k in range(BITS)), F.lit(0))
    lowest = F.transform("members", lambda m: F.struct(
        m["low"].alias("low"), m["high"].alias("high"), m["digest"].alias("digest")))
    levels = F.aggregate(
        F.slice(F.array(*[F.lit(k) for k in range(BITS)]), 1, F.col("height")), F.array("lowest"),
        lambda built, _: F.concat(built, F.array(_parents(F.element_at(built, -1)))))
    return grouped.withColumn("height", height).withColumn("lowest", lowest).withColumn(
        "levels", levels).drop("lowest")


def _path(low: Column, unit: int) -> Column:
    """Siblings of the member at ``low`` up to the top of its block, as ``side, digest``.

    ``side`` is -1 for a sibling to the left, 1 to the right, 0 for none. What the
    interval of a node leaves of its parent's is the sibling's interval.
    """
    base = F.element_at(F.element_at("levels", 1), 1)["low"]

    def node(level: Column, place: Column) -> Column:
        bucket = F.call_function("shiftright", place - base, level + unit).cast("int")
        return F.get(F.get(F.col("levels"), level), bucket)

    def sibling(level: Column) -> Column:
        own, parent = node(level, low), node(level + 1, low)
        return (
            F.when(parent["low"] < own["low"], F.struct(
                F.lit(-1).alias("side"), node(level, parent["low"])["digest"].alias("digest")))
            .when(own["high"] < parent["high"], F.struct(
                F.lit(1).alias("side"), node(level, own["high"])["digest"].alias("digest")))
            .otherwise(F.struct(F.lit(0).alias("side"), F.lit(None).cast("string").alias("digest"))))

    return F.transform(F.slice(F.array(*[F.lit(k) for k in range(BITS)]), 1, F.col("height")), sibling)


@dataclass
class Trees:
    """The trees of some leaves: nodes and tops of blocks for each step of ``BITS`` levels.

    ``steps[t]`` holds the nodes that are ``BITS * t`` levels above the leaves, for
    trees that go that far; ``tops[t]`` the top node of each block of them.
    """

    steps: list[DataFrame]
    tops: list[DataFrame]
    payload: tuple[str, ...]

    @property
    def roots(self) -> DataFrame:
        """``tree, digest, n`` of the top node of each tree."""
        out = None
        for tops in self.tops:
            ended = tops.filter("n = 1").select("tree", "digest", (F.col("high") - F.col("low")).alias("n"))
            out = ended if out is None else out.unionByName(ended)
        return out

    def nodes(self) -> DataFrame:
        """Every node as ``tree, level, low, high, digest``, the leaves on level 0."""
        out = None
        for t, step in enumerate(self.steps):
            level = F.posexplode("levels").alias("__level", "__nodes")
            found = _blocks(step, BITS * t).select("tree", "height", "n", level)
            # The top of a block that isn't its tree's is a member of the next step.
            found = found.filter((F.col("__level") < BITS) | (F.col("n") <= 1 << BITS))
            found = found.select("tree", (F.col("__level") + BITS * t).alias("level"), F.inline("__nodes"))
            out = found if out is None else out.unionByName(found)
        return out

    def paths(self, ends: DataFrame) -> DataFrame:
        """Each leaf with its payload and ``path``, all siblings up to the top of its tree and beyond.

        ``ends`` has one row for each tree: ``path`` is what follows beyond its
        top; other columns are handed down to its leaves.
        """
        more = [c for c in ends.columns if c not in ("tree", "path")]
        above = None
        for t in range(len(self.steps) - 1, -1, -1):
            over = self.tops[t].filter("n = 1").select("tree", "low", "high").join(ends, "tree")
            over = over if above is None else over.unionByName(above)
            over = over.select("tree", _bucket(F.col("low"), BITS * (t + 1)).alias("block"), F.col("low").alias("__low"),
                               F.col("high").alias("__high"), F.col("path").alias("__path"), *more)
            payload = self.payload if t == 0 else ()
            blocks = _blocks(self.steps[t], BITS * t, *payload)
            inside = F.element_at("members", 1)["low"].between(F.col("__low"), F.col("__high") - 1)
            member = F.explode(F.transform("members", lambda m: F.struct(
                m.alias("node"), _path(m["low"], BITS * t).alias("own")))).alias("m")
            found = blocks.join(over, ["tree", "block"]).filter(inside).select("tree", "__path", *more, member)
            found = found.select(
                "tree", "m.node.*", F.concat("m.own", "__path").alias("path"), *more)
            above = found if t == 0 else stored(found.select("tree", "low", "high", "path", *more))
        return above


def build(leaves: DataFrame, *payload: str) -> Trees:
    """Trees over ``leaves``: ``tree, low, high, n, digest`` and columns to keep.

    A step reads the nodes below it and stores the tops of their blocks, one for
    every ``2 ** BITS``; there are as many steps as the largest tree needs.
    """
    steps, tops, step = [], [], leaves
    while True:
        t = len(steps)
        top = F.get(F.element_at("levels", -1), F.lit(0))
        found = stored(_blocks(step, BITS * t).select(
            "tree", top["low"].alias("low"), top["high"].alias("high"), top["digest"].alias("digest"),
            F.ceil(F.col("n") / F.lit(float(1 << BITS))).cast("long").alias("n")))
        steps.append(step)
        tops.append(found)
        step = found.filter("n > 1")
        if step.isEmpty():
            return Trees(steps, tops, payload)


def folded(start: Column, path: Column) -> Column:
    """The root that follows from a leaf's digest and its siblings."""
    return F.aggregate(path, start, lambda own, s: (
        F.when(s["side"] < 0, digest(s["digest"], own))
        .when(s["side"] > 0, digest(own, s["digest"])).otherwise(digest(own))))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, from the leaf's to the last below the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: s["digest"]), "").cast("binary"), 256)


@dataclass
class Manifest:
    """The trees of all groups, and the tree whose leaves are their roots."""

    groups: Trees
    whole: Trees

    def nodes(self) -> DataFrame:
        """All nodes of the groups' trees; the tree of the groups is ``null``."""
        over = self.whole.nodes().withColumn("tree", F.lit(None).cast("string"))
        return self.groups.nodes().unionByName(over)

    def proofs(self) -> DataFrame:
        """Each leaf: payload, ``leaf``, ``subroot``, ``root`` and its ``path`` to the root."""
        root = self.whole.roots.select("tree", F.col("digest").alias("root"), F.array().cast(
            "array<struct<side:int,digest:string>>").alias("path"))
        ends = stored(self.whole.paths(root).select(
            F.col("group").alias("tree"), F.col("digest").alias("subroot"), "root", "path"))
        return self.groups.paths(ends).withColumnRenamed("digest", "leaf").drop("low", "high")


def manifest(rows: DataFrame, group: str, order: str, leaf_digest: Column, **payload: Column) -> Manifest:
    """Manifest of ``rows``; the columns of ``payload`` go with the leaves.

    The text is read once for the digest and goes no further.
    """
    tree = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("+"), F.col(group).cast("string")))
    narrow = rows.select(tree.alias("tree"), F.col(order).alias("__order"), leaf_digest.alias("digest"),
                         *[value.alias(name) for name, value in payload.items()])
    groups = build(stored(ranked(narrow, "__order", "digest").drop("__order")), *payload)
    roots = groups.roots.select(
        F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    return Manifest(groups, build(stored(ranked(roots, "group")), "group"))
