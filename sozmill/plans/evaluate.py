"""One evaluation for tuning and for reporting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.coverage import coverage, macro_coverage, with_all_groups
from ..operators.similarity import pair_means, pair_similarities
from ..operators.subwords import subword_vectors

# Fixed value: weight of coverage in the tuning score.
COVERAGE_WEIGHT = 0.2


def evaluate(
    vectors: DataFrame,
    counts: DataFrame,
    pairs: DataFrame,
    vocab: DataFrame | None = None,
    groups: DataFrame | None = None,
) -> DataFrame:
    """One row: ``syn_mean, ant_mean, separation, coverage``.

    ``groups`` lists all sources; those without a token then count as 0.

    ``vocab`` is the exact vocabulary for coverage where ``vectors`` also holds
    composed words.
    """
    means = pair_means(pair_similarities(vectors, pairs))
    covered = coverage(counts, vectors if vocab is None else vocab)
    if groups is not None:
        covered = with_all_groups(covered, groups)
    covered = macro_coverage(covered)
    return means.withColumn("coverage", covered.scalar())


def evaluate_subwords(
    vectors: DataFrame, counts: DataFrame, pairs: DataFrame, min_n: int = 3, max_n: int = 6,
    buckets: int | None = None,
) -> DataFrame:
    """As ``evaluate``, but every probe word has a vector through its n-grams, hashed or not."""
    words = pairs.select(F.col("a").alias("word")).union(pairs.select("b")).distinct()
    composed = subword_vectors(vectors, words, min_n, max_n, buckets)
    return evaluate(composed, counts, pairs, vocab=vectors)


def score(separation: Column, covered: Column) -> Column:
    return separation + COVERAGE_WEIGHT * covered


def best_trial(trials: DataFrame, *params: str) -> DataFrame:
    """The row of the highest score; the earlier trial wins a tie."""
    best = F.max_by(
        F.struct("trial", *params, "score"), F.struct(F.col("score"), -F.col("trial"))
    )
    return trials.agg(best.alias("best")).select("best.*")


def source_metrics(model: str, counts: DataFrame, vocab: DataFrame, by: str = "source") -> DataFrame:
    """Coverage of each source in long form."""
    return coverage(counts, vocab, (by,)).select(
        F.lit(model).alias("model"),
        F.col(by),
        F.lit("coverage").alias("metric"),
        F.col("coverage").alias("value"),
    )


def model_metrics(model: str, record: DataFrame) -> DataFrame:
    """An evaluation row in long form, under a null source."""
    names = ["syn_mean", "ant_mean", "separation", "coverage"]
    pairs = F.explode(
        F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in names])
    )
    return record.select(F.lit(model).alias("model"), pairs.alias("m")).select(
        "model", F.lit(None).cast("string").alias("source"), "m.metric", "m.value"
    )


def compare_models(metrics: list[DataFrame], models: list[str]) -> DataFrame:
    """Models side by side; needs at least two of them."""
    if len(models) < 2:
        raise ValueError("a comparison needs two models")
    stacked = reduce(DataFrame.unionByName, metrics)
    return stacked.groupBy("source", "metric").pivot("model", models).agg(F.first("value"))
