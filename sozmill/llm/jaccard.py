"""N-gram Jaccard self-join by MinHash banding.

Documents with the same set of word five-grams are one class, and only classes
are joined. Bands and rows are chosen for a target recall at the threshold. Classes
that share a band hash form a bucket; a bucket is verified in blocks of bounded
size on the full n-gram sets. Out of a block come a number of links and one
neighbour for each member, never pairs, so copies and near copies by the
thousand cost rows in proportion.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, filter_bits, in_bits, in_filter, lean, slices, stored, with_fields, without
from .words import find_words, mix, shingles

NGRAM, THRESHOLD, RECALL, HASHES = 5, 0.8, 0.9995, 64
#: A block has two chunks; a chunk holds about so many n-grams and members.
CHUNK_NGRAMS, CHUNK_MEMBERS = 1 << 18, 1024
#: A node of more edges than this has them dealt to several tasks.
HUB = 1024
#: Up to so many pairs a member are compared one by one, more by a matrix product.
SPARSE = 4
_COLUMNS = 4096
_MULTIPLIERS, _OFFSETS = (
    mix(np.arange(1, 4097, dtype=np.uint64) * np.uint64(salt)) for salt in (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D))


def band_plan(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows for which ``hashes`` reach the recall at the threshold."""
    best = None
    for rows in range(1, hashes + 1):
        miss = 1 - threshold ** rows
        bands = 1 if miss <= 0 else max(1, math.ceil(math.log(1 - recall) / math.log(miss)))
        if bands * rows <= hashes:
            best = bands, rows
    if best is None:
        raise ValueError(f"{hashes} hashes can't reach a recall of {recall} at {threshold}")
    return best


def ngram_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each value, one after the other, and where each begins.

    A value of fewer words, but not none, is one n-gram of all its words.
    """
    words = find_words(column)
    counts, first = words.counts(), words.first
    hashes = words.hashes()
    found = shingles(hashes, NGRAM)
    row = np.repeat(np.arange(len(counts)), counts)
    full = np.arange(len(found)) + NGRAM <= np.repeat(first[1:], counts)[: len(found)]
    short = np.flatnonzero((counts > 0) & (counts < NGRAM))
    values, rows = [found[full]], [row[: len(found)][full]]
    for size in range(1, NGRAM):
        of = short[counts[short] == size]
        if len(of):
            values.append(shingles(hashes, size)[first[of]])
            rows.append(of)
    values, rows = np.concatenate(values), np.concatenate(rows)
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return values, np.searchsorted(rows, np.arange(len(counts) + 1))


def band_hashes(values: np.ndarray, starts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """MinHash band hashes of non-empty sets: one row a set, one column a band."""
    out = np.zeros((len(starts) - 1, bands), dtype=np.uint64)
    some = np.diff(starts) > 0
    at = starts[:-1][some]
    for k in range(bands * rows if len(at) else 0):
        least = np.minimum.reduceat(values * (_MULTIPLIERS[k] | np.uint64(1)) + _OFFSETS[k], at)
        out[some, k // rows] = mix(out[some, k // rows] * np.uint64(31) + least + np.uint64(k // rows + 1))
    return out.astype(np.int64)


def _class_keys(column: pa.Array, values: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """128 bits that name a set of n-grams; a text without words goes by its own bytes."""
    return [xxhash.xxh3_128_digest(values[a:b].tobytes() if b > a else b"text:" + text.as_py())
            for text, a, b in zip(column, starts[:-1].tolist(), starts[1:].tolist())]


def signatures(docs: DataFrame, text: str, bands: int, rows: int) -> DataFrame:
    """``docs`` without ``text``, with ``cls, n, bands`` of its set of n-grams."""
    others = [c for c in docs.columns if c != text]

    def run(batches):
        for batch in batches:
            column, rest = as_bytes(batch.column(text)), batch.drop_columns([text])
            for a, b in slices(column):
                part = column.slice(a, b - a)
                values, starts = ngram_sets(part)
                hashes = band_hashes(values, starts, bands, rows)
                flat = pa.array(hashes.reshape(-1))
                ends = pa.array(np.arange(0, hashes.size + 1, bands, dtype=np.int32))
                out = rest.slice(a, b - a)
                out = out.append_column("cls", pa.array(_class_keys(part, values, starts), pa.binary()))
                out = out.append_column("n", pa.array(np.diff(starts), pa.int32()))
                yield out.append_column("bands", pa.ListArray.from_arrays(ends, flat))

    return docs.select(*others, text).mapInArrow(lean(run), with_fields(
        docs.select(*others), "cls binary, n int, bands array<long>"))


def wanted_sets(docs: DataFrame, key: str, text: str, bits: np.ndarray) -> DataFrame:
    """``key, cls, ngrams`` of the rows whose key passes the filter; once a task for repeated rows.

    Copies with other keys are not repeated rows: the filter has false positives, and one of
    those must not stand in for the row that is wanted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        seen = set()
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(shared.value, batch.column(0).to_numpy())))
            column = as_bytes(batch.column(1))
            for a, b in slices(column):
                part = column.slice(a, b - a)
                values, starts = ngram_sets(part)
                found = []
                for key, cls, i, j in zip(batch.column(0).slice(a, b - a).to_pylist(),
                                          _class_keys(part, values, starts), starts[:-1], starts[1:]):
                    if (key, cls) not in seen:
                        seen.add((key, cls))
                        found.append((key, cls, values[i:j].astype(np.int64)))
                if found:
                    keys, classes, sets = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(classes, pa.binary()),
                         pa.array(sets, pa.list_(pa.int64()))], ["key", "cls", "ngrams"])

    return docs.select(F.col(key).alias("key"), text).mapInArrow(
        lean(run), "key long, cls binary, ngrams array<long>")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets have in common, by matrix products in column blocks."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    codes, code, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[code] > 1
    owner, code = owner[shared], code[shared]
    _, code = np.unique(code, return_inverse=True)
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, _COLUMNS):
        a, b = np.searchsorted(code, [low, low + _COLUMNS])
        block = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        block[owner[a:b], code[a:b] - low] = 1
        out += block @ block.T
    return out


def verify(band: int, bands: np.ndarray, chunk: np.ndarray, sets: list[np.ndarray],
           threshold: float, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links and a neighbour for each member of a block, from pairs that first meet in ``band``.

    Pairs lie inside the one chunk, or across the two, of which one may have no members. A pair that shares an
    earlier band hash was counted there. The neighbour is the first member of what
    hangs together, the member itself if it has no link.
    """
    m = len(sets)
    pair = np.triu(np.ones((m, m), dtype=bool), 1)
    if not inside:
        pair &= chunk[:, None] != chunk
    for k in range(band):
        pair &= bands[:, k][:, None] != bands[:, k]
    size = np.array([len(s) for s in sets])
    shorter, longer = np.minimum(size[:, None], size), np.maximum(size[:, None], size)
    pair &= shorter >= threshold * longer - 1e-9
    left, right = np.nonzero(pair)
    if len(left) > SPARSE * m:
        both = shared_counts(sets)[left, right].astype(np.int64)
    else:
        both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                         for i, j in zip(left, right)], dtype=np.int64)
    linked = both >= threshold * (size[left] + size[right] - both) - 1e-9
    left, right = left[linked], right[linked]
    links = np.bincount(left, minlength=m) + np.bincount(right, minlength=m)
    root = np.arange(m)
    while True:
        least = root.copy()
        np.minimum.at(least, left, root[right])
        np.minimum.at(least, right, root[left])
        least = np.minimum(least, least[least])
        if (least == root).all():
            return links, root
        root = least


def verified(members: DataFrame, threshold: float) -> DataFrame:
    """``cls, links, other`` from ``block, inside, band, chunk, cls, bands, ngrams`` sorted by block."""
    def run(batches):
        def close(rows):
            if len(rows) < 2:
                return None
            chunk, inside = np.array([r["chunk"] for r in rows]), rows[0]["inside"]
            if not inside and chunk.min() == chunk.max():
                return None
            bands = np.array([r["bands"] for r in rows])
            sets = [np.asarray(r["ngrams"], dtype=np.int64) for r in rows]
            links, root = verify(rows[0]["band"], bands, chunk, sets, threshold, inside)
            has = np.flatnonzero(links)
            return pa.RecordBatch.from_arrays(
                [pa.array([rows[i]["cls"] for i in has], pa.binary()), pa.array(links[has], pa.int64()),
                 pa.array([rows[root[i]]["cls"] for i in has], pa.binary())], ["cls", "links", "other"])

        block, rows = None, []
        for batch in batches:
            blocks = batch.column("block").to_pylist()
            ngrams = batch.column("ngrams")
            rest = batch.select(["inside", "band", "chunk", "cls", "bands"]).to_pylist()
            for i, (of, row) in enumerate(zip(blocks, rest)):
                if of != block:
                    if (out := close(rows)) is not None:
                        yield out
                    block, rows = of, []
                row["ngrams"] = ngrams[i].values.to_numpy()
                rows.append(row)
        if (out := close(rows)) is not None:
            yield out

    return members.mapInArrow(lean(run), "cls binary, links long, other binary")


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` of ``a, b`` with the ``m`` of their ``a``.

    The edges of a node with more than ``HUB`` of them are dealt into parts of about that many, which meet as many
    copies of its row, so the middle of a large star isn't one task's. A filter of fixed size finds them.
    """
    top = least.agg(F.max("degree")).first()[0] or 0
    row = least.select("a", "m")
    if top <= HUB:
        return edges.join(row, "a")
    hubs = stored(least.filter(F.col("degree") > HUB).select("a", "m", F.xxhash64("a").alias("key")))
    parts = -(-top // HUB)
    copies = hubs.select("a", "m", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    maybe = in_bits(hubs, "key")
    keyed = edges.withColumn("key", F.xxhash64("a"))
    dealt = stored(keyed.filter(maybe("key")).withColumn("part", F.pmod(F.xxhash64("b"), F.lit(parts)).cast("int"))
                   .join(copies, ["a", "part"], "left").select("a", "b", "m"))
    others = keyed.filter(~maybe("key")).select("a", "b").unionByName(dealt.filter("m is null").select("a", "b"))
    return others.join(row, "a").unionByName(dealt.filter("m is not null"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``a, b``, the root being the least node that hangs together.

    Alternates large and small stars on stored edge tables until nothing
    changes; what reaches the driver is a count and a checksum.
    """
    def stars(edges, small):
        both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
        joined = _with_least(both, least.withColumn("m", F.least("a", "m")))
        if small:  # every neighbour of a is smaller than a
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                least.select("a", F.col("m").alias("b")))
        else:
            moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.filter("a != b").distinct()

    def state(edges):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a != b").distinct())
    before = state(edges)
    while before[0]:
        edges = stored(stars(stars(edges, False), True))
        now = state(edges)
        if now == before:
            break
        before = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def join(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
         recall: float = RECALL) -> DataFrame:
    """One row for each of ``docs``: ``id, text_hash, class_id, n_links, n_copies, keeper``.

    ``class_id`` is the least id of all documents that hang together by links
    of the threshold; ``n_links`` the number of other classes, that is other sets of
    n-grams, to which the document is linked; ``n_copies`` the documents of
    its own class. ``keeper`` marks the document of each group with the least id (null
    ids last, then by text hash); rows that repeat it are keepers too. A document
    without words has links to none; null is an empty text. An empty table
    gives no rows. Ids need not be unique.
    """
    bands, rows = band_plan(threshold, recall)
    known = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    signed = stored(signatures(known, "text", bands, rows))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    classes = stored(signed.groupBy("cls").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("n").alias("n"),
        F.any_value("bands").alias("bands")))
    edges = stored(linked(known, classes, threshold))
    links = edges.groupBy("cls").agg(F.sum("links").alias("n_links"))
    roots = components(edges.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    rooted = classes.select("cls", "first", "copies").join(roots.withColumnRenamed("node", "cls"), "cls", "left") \
        .join(links, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("group"))
    by_class = stored(rooted.join(groups, "root").select(
        "cls", "group", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return signed.join(by_class, "cls").select(
        F.col("id").alias(id), "text_hash", F.col("group.id").alias("class_id"), "n_links",
        F.col("copies").alias("n_copies"), (F.col("group") == order).alias("keeper"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group that hangs together: the one with the least id.

    Rows that repeat id and text are one document.
    """
    found = join(docs, id, text, **options).select(F.xxhash64(id, "text_hash").alias("key"), "keeper")
    counts = found.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bool_or("keeper").alias("keeper"))
    marked = stored(counts.filter("n > 1 or not keeper"))
    return without(docs, F.xxhash64(id, F.xxhash64(text)), marked.filter("not keeper"), marked.filter("keeper"))


def linked(known: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Links among classes: ``cls, links, other``, in parts that add up."""
    rep = F.xxhash64("first.id", "first.text_hash")
    with_words = classes.filter("n > 0").select("cls", "n", rep.alias("key"), "bands")
    banded = with_words.select("cls", "n", "key", F.posexplode("bands").alias("band", "hash"))
    buckets = banded.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("members"), F.sum("n").alias("ngrams"),
        F.sum(F.xxhash64("cls").cast("decimal(20,0)")).alias("sum")).filter("members > 1")
    # Buckets of the same members are verified once, in the earliest band.
    distinct = buckets.groupBy("members", "ngrams", "sum").agg(F.min(F.struct("band", "hash")).alias("b"))
    chunks = F.ceil(F.greatest(F.col("ngrams") / CHUNK_NGRAMS, F.col("members") / CHUNK_MEMBERS)).cast("int")
    kept = distinct.select("b.band", "b.hash", chunks.alias("chunks"))
    chunk = F.pmod(F.xxhash64("cls", F.lit("chunk")), F.col("chunks")).cast("int")
    placed = stored(banded.select("cls", "key", "band", "hash").join(kept, ["band", "hash"]).select(
        "cls", "key", "band", "hash", chunk.alias("chunk"), "chunks"))
    bits = filter_bits(placed.select("key").distinct(), "key")
    sets = wanted_sets(known.withColumn("key", F.xxhash64("id", "text_hash")), "key", "text", bits)
    once = sets.join(placed.select("cls", "key").distinct(), ["cls", "key"], "left_semi").dropDuplicates(["cls"])
    full = once.select("cls", "ngrams").join(classes.select("cls", "bands"), "cls")
    blocks = placed.select("cls", "band", "hash", "chunk", F.explode(
        F.sequence(F.lit(0), F.col("chunks") - 1)).alias("__with"))
    low, high = F.least("chunk", "__with"), F.greatest("chunk", "__with")
    block = F.xxhash64("band", "hash", low, high)
    members = blocks.select(
        "cls", "band", "chunk", block.alias("block"), (low == high).alias("inside")).join(full, "cls")
    return verified(members.repartition("block").sortWithinPartitions("block", "cls"), threshold)
