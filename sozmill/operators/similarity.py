"""Pair similarity, separation and nearest neighbours over a vector table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.vectors import cosine
from .neighbours import search

# Probe pairs and seed words of the evaluation.
SYNONYMS = (
    ("yaxşı", "əla"), ("bahalı", "qiymətli"), ("ucuz", "sərfəli"), ("pis", "bərbad"),
    ("gözəl", "qəşəng"),
)
ANTONYMS = (
    ("yaxşı", "pis"), ("bahalı", "ucuz"), ("gözəl", "çirkin"), ("sevirəm", "nifrət"),
)
SHORT_SYNONYMS = (("yaxşı", "əla"), ("bahalı", "qiymətli"), ("ucuz", "sərfəli"))
SHORT_ANTONYMS = (("yaxşı", "pis"), ("bahalı", "ucuz"))
SEED_WORDS = (
    "yaxşı", "pis", "çox", "bahalı", "ucuz", "mükəmməl", "dəhşət", "<PRICE>", "<RATING_POS>",
    "gözəl", "yox",
)
SHORT_SEED_WORDS = SEED_WORDS[:9]


def probe_pairs(spark: SparkSession, synonyms=SYNONYMS, antonyms=ANTONYMS) -> DataFrame:
    rows = [("syn", a, b) for a, b in synonyms] + [("ant", a, b) for a, b in antonyms]
    return spark.createDataFrame(rows, "kind string, a string, b string")


def pair_similarities(vectors: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cosine of each pair whose two words both have a vector.

    Two equi-joins without hints: Spark broadcasts a short pair list and
    shuffles a long one.
    """
    left = vectors.select(F.col("word").alias("a"), F.col("vector").alias("__a"))
    right = vectors.select(F.col("word").alias("b"), F.col("vector").alias("__b"))
    found = pairs.join(left, "a").join(right, "b")
    return found.withColumn("cosine", cosine(F.col("__a"), F.col("__b"))).drop("__a", "__b")


def pair_means(similarities: DataFrame, *by: str) -> DataFrame:
    """``syn_mean`` and ``ant_mean`` (NaN without a pair) and ``separation``."""
    def mean(kind):
        value = F.avg(F.when(F.col("kind") == kind, F.col("cosine")))
        return F.coalesce(value, F.lit(float("nan")))

    means = similarities.groupBy(*by).agg(
        mean("syn").alias("syn_mean"), mean("ant").alias("ant_mean")
    )
    undefined = F.isnan("syn_mean") | F.isnan("ant_mean")
    return means.withColumn(
        "separation",
        F.when(undefined, -1.0).otherwise(F.col("syn_mean") - F.col("ant_mean")),
    )


def nearest_neighbours(
    vectors: DataFrame, seeds: DataFrame, k: int = 5, query_vectors: DataFrame | None = None
) -> DataFrame:
    """The ``k`` most similar other words of each seed, as ``seed, rank, word, cosine``.

    ``seeds`` is a table with a ``word`` column. Each task finds its best ``k`` of a seed by pivots and
    triangle bounds, without scoring or sorting all pairs; the window sees only those. Ties go to
    the word that sorts first. Seeds without a vector give no row, vectors without a length are no one's
    neighbour. ``query_vectors`` supplies seed vectors from another table, as for words known only through their parts.
    """
    source = vectors if query_vectors is None else query_vectors
    wanted = source.join(seeds.select("word").distinct(), "word", "left_semi")
    found = search(vectors, wanted, k).filter("word is not null")
    best = Window.partitionBy("seed").orderBy(F.desc("cosine"), "word")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "seed", "rank", "word", "cosine")


def list_overlap(one: DataFrame, other: DataFrame, k: int) -> DataFrame:
    """How alike the neighbour lists of two models are, as ``seed, shared, overlap``.

    ``shared`` counts the words in both lists. ``overlap`` is the mean, over the depths 1 to ``k``, of the
    share of words that both lists have in common so far; so the first places weigh most, and 1 means
    the same words in the same order. A seed without neighbours in either list has 0.
    """
    lists = [df.groupBy("seed").agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias(name))
             for df, name in ((one, "__a"), (other, "__b"))]
    none = F.array().cast("array<string>")
    both = lists[0].join(lists[1], "seed", "full").select(
        "seed", *[F.coalesce(F.col(f"{n}.word"), none).alias(n) for n in ("__a", "__b")])

    def common(depth: Column) -> Column:
        return F.size(F.array_intersect(F.slice("__a", 1, depth), F.slice("__b", 1, depth)))

    total = F.aggregate(F.sequence(F.lit(1), F.lit(k)), F.lit(0.0),
                        lambda t, depth: t + common(depth).cast("double") / depth)
    return both.select("seed", common(F.lit(k)).cast("long").alias("shared"), (total / k).alias("overlap"))


def neighbour_lists(neighbours: DataFrame, seeds: DataFrame) -> DataFrame:
    """One row for each seed; unknown seeds keep an empty list."""
    lists = neighbours.groupBy("seed").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("__found")
    )
    joined = seeds.select(F.col("word").alias("seed")).join(lists, "seed", "left")
    words = F.coalesce(F.col("__found.word"), F.array().cast("array<string>"))
    return joined.select("seed", words.alias("neighbours"))
