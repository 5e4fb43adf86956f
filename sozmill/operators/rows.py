"""Row filters, first-wins dedup and the ordered head."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rules import SPACE


def has_text(text: Column) -> Column:
    """Anything but white space is left."""
    return text.rlike(f"[^{SPACE}]")


def keep_nonempty(df: DataFrame, column: str) -> DataFrame:
    """Rows where the string ``column`` is not empty.

    Written with a generator because Spark would push a plain filter below the
    projections that compute the column, and so compute it twice.
    """
    value = F.col(column)
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.when(value != "", F.array(value))).alias(column))


def drop_missing(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows with a text and a label."""
    return df.filter(F.col(text).isNotNull() & F.col("has_label"))


#: Sentiment values that a label may have; null is one of them.
_VALUES = (None, 0.0, 0.5, 1.0)


def first_labelled(df: DataFrame) -> DataFrame:
    """First row for each text of a source, with that row's sentiment value.

    One ``min(row_ord)`` for each sentiment value: four longs in a hash
    aggregate that combines on the map side, for any order, negative ones
    included. However often a text is copied, each map task sends it once, and
    the texts cross the network a single time. Rows of equal order and different
    values take null before 0 before 0.5 before 1.
    """
    value = F.col("sentiment_value")
    firsts = [F.min(F.when(value.isNull() if v is None else value == v, F.col("row_ord"))).alias(f"__{i}")
              for i, v in enumerate(_VALUES)]
    found = df.groupBy("source", "source_ord", "text").agg(*firsts)
    first = F.least(*[f"__{i}" for i in range(len(_VALUES))])
    chosen = F.when(F.col("__0") == first, F.lit(None).cast("double"))
    for i, v in enumerate(_VALUES[1:], 1):
        chosen = chosen.when(F.col(f"__{i}") == first, F.lit(v))
    return found.select(
        "source", "source_ord", first.alias("row_ord"), "text", chosen.alias("sentiment_value"))


def first_rows(df: DataFrame, keys, order: str, within=()) -> DataFrame:
    """First row for each value of ``keys`` by ``order``, all columns kept.

    ``order`` must be unique inside ``within``. Only a digest of the keys and
    the order are aggregated; the rows are then picked by a semi join on the
    order, which spreads evenly even when one key holds most rows.
    """
    within = list(within)
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    lengths = [F.coalesce(F.length(F.col(k).cast("string")), F.lit(-1)).cast("string") for k in keys]
    digest = F.sha2(F.concat_ws(":", *lengths, *parts), 256)
    first = (
        df.select(*within, digest.alias("__key"), order)
        .groupBy(*within, "__key")
        .agg(F.min(order).alias(order))
        .drop("__key")
    )
    return df.join(first, [*within, order], "left_semi")


#: A range of an order column is counted in so many parts at a time.
HEAD_PARTS = 4096


def head(df: DataFrame, n: int, order=("source_ord", "row_ord")) -> DataFrame:
    """The first ``n`` rows in ingest order, in no particular order.

    The place of the cut is found by counts over ranges of the order columns,
    which must be integers without nulls and unique together, as ``source_ord,
    row_ord`` is. A count has ``HEAD_PARTS`` rows at most, however large ``n``
    and the table are; nothing is sorted, and the rows stay where they are.
    """
    if n <= 0:
        return df.limit(0)
    rest, inside, kept = df.select(*order), n, None
    same = F.lit(True)
    for column in order:
        found = _cut(rest, column, inside)
        if found is None:  # fewer rows than n
            return df
        value, before = found
        part = same & (F.col(column) < value)
        kept = part if kept is None else kept | part
        same = same & (F.col(column) == value)
        rest, inside = rest.filter(F.col(column) == value), inside - before
    return df.filter(kept | same)


def _cut(df: DataFrame, column: str, n: int) -> tuple[int, int] | None:
    """The value that holds the ``n``-th row, and how many rows lie before it."""
    low, high, total = df.agg(F.min(column), F.max(column), F.count(F.lit(1))).first()
    if total < n:
        return None
    before = 0
    while low < high:
        width = -(-(high - low + 1) // HEAD_PARTS)
        # Wide ranges pass the longs, so the distance is taken as a decimal.
        place = F.expr(f"(cast(`{column}` as decimal(20,0)) - {low}) div {width}")
        counts = dict(df.filter(F.col(column).between(low, high)).groupBy(place.alias("p"))
                      .agg(F.count(F.lit(1))).collect())
        for part in sorted(counts):
            if before + counts[part] >= n:
                break
            before += counts[part]
        low, high = low + int(part) * width, min(high, low + (int(part) + 1) * width - 1)
    return low, before
