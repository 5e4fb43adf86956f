"""Comparison of two models: metrics by source, probe pairs and neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.similarity import (
    SHORT_ANTONYMS, SHORT_SEED_WORDS, SHORT_SYNONYMS, nearest_neighbours, neighbour_lists, probe_pairs,
)
from ..operators.subwords import subword_vectors
from .evaluate import compare_models, evaluate, model_metrics, source_metrics


def short_seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in SHORT_SEED_WORDS], "word string")


def metric_report(plain: DataFrame, subword: DataFrame, counts: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Coverage of each source and the probe means of both models side by side.

    Coverage is that of the vocabulary, which composing vectors does not widen.
    """
    pairs = probe_pairs(plain.sparkSession, SHORT_SYNONYMS, SHORT_ANTONYMS) if pairs is None else pairs
    words = pairs.select(F.col("a").alias("word")).union(pairs.select("b")).distinct()
    composed = subword_vectors(subword, words)
    metrics = []
    for name, model, vocab in (("plain", plain, plain), ("subword", composed, subword)):
        metrics.append(model_metrics(name, evaluate(model, counts, pairs, vocab)))
        metrics.append(source_metrics(name, counts, vocab))
    return compare_models(metrics, ["plain", "subword"])


def neighbour_report(plain: DataFrame, subword: DataFrame, seeds: DataFrame | None = None, k: int = 5) -> DataFrame:
    """``model, seed, neighbours`` of each seed in both models.

    The subword model also answers for words it has no vector of: their vector
    is composed, the neighbours are words of the vocabulary.
    """
    seeds = short_seeds(plain.sparkSession) if seeds is None else seeds
    queries = subword_vectors(subword, seeds)
    lists = {
        "plain": nearest_neighbours(plain, seeds, k),
        "subword": nearest_neighbours(subword, seeds, k, query_vectors=queries),
    }
    parts = [neighbour_lists(found, seeds).select(F.lit(name).alias("model"), "seed", "neighbours")
             for name, found in lists.items()]
    return parts[0].unionByName(parts[1])
