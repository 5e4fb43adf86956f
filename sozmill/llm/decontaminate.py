"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ten consecutive words. A window is a set
of word shingles; it can only lie in a document that holds all of them, so for a
containment of 1 its prefix, the one shingle that is rarest in the documents, is
enough to find every candidate. Windows whose rarest shingle occurs nowhere are
done with that. Candidates then pass the bounds on position and length, and the
words are compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_bytes, filter_bits, in_filter, lean, slices, stored, with_fields, without
from .words import find_words, row_shingles, shingles

WINDOW = 10
SHINGLE = 3
KINDS = range(1, SHINGLE + 1)  # short items have shorter shingles


def item_windows(items: DataFrame, id: str, text: str, window: int = WINDOW) -> DataFrame:
    """Windows of whole items: ``item, words, n, shingles``.

    An item of fewer words than a window is one window; none has none.
    ``shingles`` holds the hashes by their first word.
    """
    def run(batches):
        for batch in batches:
            column, ids = as_bytes(batch.column(1)), batch.column(0)
            for a, b in slices(column):
                words = find_words(column.slice(a, b - a))
                hashes = words.hashes()
                rows = []
                for row in range(b - a):
                    start, stop = int(words.first[row]), int(words.first[row + 1])
                    n = min(window, stop - start)
                    for at in range(start, stop - n + 1) if n else ():
                        size = min(SHINGLE, n)
                        found = shingles(hashes[at:at + n], size).astype(np.int64)
                        rows.append((ids[a + row].as_py(), words.text(at, at + n), n, found.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                        (pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64())))],
                    ["item", "words", "n", "shingles"])

    return items.select(F.col(id).cast("string"), text).mapInArrow(
        lean(run), "item string, words string, n int, shingles array<long>")


def _found(words, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all sizes that pass the filter: hashes, first words, sizes."""
    hashes = words.hashes()
    out = []
    for size in KINDS:
        found, at = row_shingles(words, hashes, size)
        hit = in_filter(bits, found)
        out.append((found[hit].astype(np.int64), at[hit], np.full(int(hit.sum()), size)))
    return tuple(np.concatenate(x) for x in zip(*out))


def shingle_counts(docs: DataFrame, text: str, bits: np.ndarray) -> DataFrame:
    """How often the shingles that pass the filter occur in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            column = as_bytes(batch.column(0))
            for a, b in slices(column):
                found, _, _ = _found(find_words(column.slice(a, b - a)), shared.value)
                values, counts = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], ["shingle", "cnt"])

    seen = docs.select(text).mapInArrow(lean(run), "shingle long, cnt long")
    return seen.groupBy("shingle").agg(F.sum("cnt").alias("cnt"))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct windows with their rarest shingle: ``words, n, shingle, place``.

    Ties take the smaller hash, then the smaller place. Windows with a shingle that no document has are
    left out.
    """
    each = windows.select("words", "n", F.posexplode("shingles").alias("place", "shingle")).distinct()
    counted = each.join(counts, "shingle", "left")
    order = F.struct(F.coalesce("cnt", F.lit(0)).alias("cnt"), "shingle", "place")
    rarest = counted.groupBy("words", "n").agg(F.min(order).alias("first"))
    return rarest.filter("first.cnt > 0").select("words", "n", "first.shingle", "first.place")


def candidates(docs: DataFrame, text: str, bits: np.ndarray, window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words`` and, in ``found``, each place of a prefix shingle.

    A place has the shingle, its first word, its size and the words around it
    that a window through it may have.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    others = [c for c in docs.columns if c != text]
    kind = pa.list_(pa.struct([("shingle", pa.int64()), ("at", pa.int32()), ("first", pa.int32()),
                               ("around", pa.string())]))

    def run(batches):
        for batch in batches:
            column = as_bytes(batch.column(text))
            rest = batch.drop_columns([text])
            for a, b in slices(column):
                words = find_words(column.slice(a, b - a))
                found, at, sizes = _found(words, shared.value)
                places = [[] for _ in range(b - a)]
                rows = np.searchsorted(words.first, at, "right") - 1
                for shingle, i, size, row in zip(found.tolist(), at.tolist(), sizes.tolist(), rows.tolist()):
                    start, stop = int(words.first[row]), int(words.first[row + 1])
                    low, high = max(start, i - window + size), min(stop, i + window)
                    places[row].append({"shingle": shingle, "at": i - start, "first": low - start,
                                        "around": words.text(low, high)})
                out = rest.slice(a, b - a)
                out = out.append_column("n_words", pa.array(words.counts(), pa.int64()))
                yield out.append_column("found", pa.array(places, kind))

    return docs.select(*others, text).mapInArrow(lean(run), with_fields(
        docs.select(*others),
        "n_words long, found array<struct<shingle:long,at:int,first:int,around:string>>"))


def hit_windows(found: DataFrame, key: str, prefix: DataFrame) -> DataFrame:
    """Verified places: ``key, words, start, stop`` of each window in each document."""
    place = found.select(key, "n_words", F.explode("found").alias("p")).select(
        key, "n_words", "p.shingle", "p.at", "p.first", "p.around")
    start = F.col("at") - F.col("place")
    joined = place.join(prefix, "shingle").filter(
        (start >= F.col("first")) & (start + F.col("n") <= F.col("n_words")))
    same = F.array_join(
        F.slice(F.split("around", " "), start - F.col("first") + 1, F.col("n")), " ") == F.col("words")
    return joined.filter(same).select(key, "words", start.alias("start"), (start + F.col("n")).alias("stop"))


def covered(spans: F.Column) -> F.Column:
    """Words covered by sorted ``(start, stop)`` spans."""
    return F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("end")),
        lambda acc, x: F.struct(
            (acc["sum"] + F.greatest(F.lit(0), x["stop"] - F.greatest(acc["end"], x["start"]))).alias("sum"),
            F.greatest(acc["end"], x["stop"]).alias("end")),
        lambda acc: acc["sum"])


def contamination(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``docs`` without ``text``, with ``n_words, n_hit, items, spans`` for every row.

    ``spans`` are the places of windows as ``(start, stop)`` words, ``items``
    the sorted ids as strings. Null has no words; rows without a hit have 0 and
    empty lists; repeated rows and repeated items count as what they are; an
    empty table of either kind gives no hits. Columns of these names are replaced.

    Documents are read twice, as numpy arrays in the tasks; all that is shuffled
    are shingle counts and the places of prefix shingles.
    """
    added = ("n_words", "found", "n_hit", "items", "spans", "__row")
    docs = docs.drop(*added)
    windows = stored(item_windows(items, item_id, item_text, window))
    each = windows.select(F.explode("shingles").alias("shingle")).distinct()
    counts = shingle_counts(docs, text, filter_bits(each, "shingle"))
    prefix = stored(prefixes(windows, counts))
    bits = filter_bits(prefix.select("shingle").distinct(), "shingle")
    found = stored(candidates(
        docs.withColumn("__row", F.monotonically_increasing_id()), text, bits, window))
    hits = hit_windows(found, "__row", prefix)
    spans = hits.groupBy("__row").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    named = hits.select("__row", "words").distinct().join(
        windows.select("words", "item").distinct(), "words")
    ids = named.groupBy("__row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    by_row = spans.join(ids, "__row")
    return found.drop("found").join(by_row, "__row", "left").drop("__row").select(
        "*", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit")
    ).withColumns({
        "spans": F.coalesce("spans", F.expr("cast(array() as array<struct<start:int,stop:int>>)")),
        "items": F.coalesce("items", F.expr("cast(array() as array<string>)")),
    })


def clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` in which no word is hit; the others go as a whole."""
    key = F.xxhash64(id, text)
    found = contamination(docs.select(key.alias("key"), text), items, text, **options)
    return without(docs, key, stored(found.filter("n_hit > 0").select("key").distinct()))
