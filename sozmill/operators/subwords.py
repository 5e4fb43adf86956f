"""Vectors for character n-grams, and through them for unknown words.

This is not a trainer: n-gram vectors are derived from given word vectors.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F


def ngrams(word: Column, min_n: int = 3, max_n: int = 6) -> Column:
    """Distinct n-grams of ``<word>``, the two brackets included."""
    if not 1 <= min_n <= max_n:
        raise ValueError("need 1 <= min_n <= max_n")
    framed = F.concat(F.lit("<"), word, F.lit(">"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(framed) - (n - 1))
        grams = F.transform(starts, lambda i: F.substr(framed, i, F.lit(n)))
        return F.when(F.length(framed) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(*[of_length(n) for n in range(min_n, max_n + 1)]))


def explode_ngrams(words: DataFrame, min_n: int = 3, max_n: int = 6) -> DataFrame:
    return words.select("*", F.explode(ngrams(F.col("word"), min_n, max_n)).alias("ngram"))


def _mean(weight: Column | None = None) -> Column:
    vector = array_to_vector(F.col("vector").cast("array<double>"))
    mean = Summarizer.mean(vector) if weight is None else Summarizer.mean(vector, weight)
    return vector_to_array(mean)


def ngram_vectors(vectors: DataFrame, min_n: int = 3, max_n: int = 6) -> DataFrame:
    """Mean vector of the words that hold an n-gram, weighted by their counts.

    Sums are combined on the map side, so a common n-gram is no hot key.
    """
    grams = explode_ngrams(vectors.select("word", "vector", "cnt"), min_n, max_n)
    return grams.groupBy("ngram").agg(
        F.count(F.lit(1)).alias("words"), _mean(F.col("cnt").cast("double")).alias("vector")
    )


def word_vectors_from(grams: DataFrame, words: DataFrame, min_n: int = 3, max_n: int = 6) -> DataFrame:
    """Mean of the known n-grams of each word; words without any are left out.

    A common n-gram can be on very many of ``words``. Its row of ``grams`` is
    one, so AQE splits such a join partition without copying much.
    """
    parts = explode_ngrams(words.select("word").distinct(), min_n, max_n)
    return parts.join(grams.select("ngram", "vector"), "ngram").groupBy("word").agg(
        F.count(F.lit(1)).alias("ngrams"), _mean().alias("vector")
    )


#: Slots of a table of hashed n-grams, as many as is usual for subword models.
BUCKETS = 2_000_000


def bucket(ngram: Column, buckets: int) -> Column:
    """The slot of an n-gram: CRC-32 of its UTF-8 bytes, modulo the number of slots."""
    return (F.crc32(ngram.cast("binary")) % buckets).cast("int")


def _bucketed(words: DataFrame, buckets: int, min_n: int, max_n: int) -> DataFrame:
    return explode_ngrams(words, min_n, max_n).withColumn("bucket", bucket(F.col("ngram"), buckets)).drop("ngram")


def bucket_vectors(
    vectors: DataFrame, buckets: int = BUCKETS, min_n: int = 3, max_n: int = 6
) -> DataFrame:
    """``bucket, words, vector``: as ``ngram_vectors``, with the n-grams hashed into ``buckets`` slots.

    The table has at most that many rows, however many words and n-grams there are. N-grams that share
    a slot share a vector; an n-gram of a word counts once, two in a slot count twice.
    """
    return _bucketed(vectors.select("word", "vector", "cnt"), buckets, min_n, max_n).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("words"), _mean(F.col("cnt").cast("double")).alias("vector"))


def word_vectors_from_buckets(
    table: DataFrame, words: DataFrame, buckets: int = BUCKETS, min_n: int = 3, max_n: int = 6
) -> DataFrame:
    """Mean of the slots of each word's n-grams; words without a filled slot are left out."""
    parts = _bucketed(words.select("word").distinct(), buckets, min_n, max_n)
    return parts.join(table.select("bucket", "vector"), "bucket").groupBy("word").agg(
        F.count(F.lit(1)).alias("ngrams"), _mean().alias("vector"))


def membership(composed: DataFrame, words: DataFrame) -> DataFrame:
    """``word, in_vocab, has_vector`` for each of ``words``; ``composed`` comes from ``subword_vectors``.

    A subword model answers for every word with a vector, but only its own words count as covered.
    """
    found = composed.select("word", "in_vocab", F.lit(True).alias("has_vector"))
    return words.select("word").distinct().join(found, "word", "left").fillna(False, ["in_vocab", "has_vector"])


def subword_vectors(
    vectors: DataFrame, words: DataFrame, min_n: int = 3, max_n: int = 6, buckets: int | None = None
) -> DataFrame:
    """A vector for each of ``words``: its own if known, else from n-grams.

    With ``buckets`` the n-grams are hashed into so many slots.
    """
    known = vectors.join(words.select("word").distinct(), "word", "left_semi")
    unknown = words.select("word").distinct().join(vectors.select("word"), "word", "left_anti")
    if buckets is None:
        built = word_vectors_from(ngram_vectors(vectors, min_n, max_n), unknown, min_n, max_n)
    else:
        table = bucket_vectors(vectors, buckets, min_n, max_n)
        built = word_vectors_from_buckets(table, unknown, buckets, min_n, max_n)
    return known.select(
        "word", F.col("vector").cast("array<double>").alias("vector"), F.lit(True).alias("in_vocab")
    ).unionByName(built.select("word", "vector", F.lit(False).alias("in_vocab")))
