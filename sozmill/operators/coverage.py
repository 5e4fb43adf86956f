"""How much of a corpus a vocabulary covers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def coverage(counts: DataFrame, vocab: DataFrame, by=("source",)) -> DataFrame:
    """Tokens, hits and their ratio for each group.

    ``counts`` has one row for each group and token, so no token can be a hot
    key of the join however frequent it is. The join is not hinted: Spark
    broadcasts a vocabulary only if it is small.
    """
    words = vocab.select(F.col("word").alias("token"), F.lit(True).alias("__hit"))
    looked_up = counts.join(words, "token", "left")
    hits = F.sum(F.when(F.col("__hit"), F.col("cnt")).otherwise(F.lit(0)))
    return looked_up.groupBy(*by).agg(
        F.sum("cnt").alias("tokens"), hits.alias("hits")
    ).withColumn("coverage", F.col("hits") / F.greatest(F.lit(1), F.col("tokens")))


def with_all_groups(covered: DataFrame, groups: DataFrame, by=("source",)) -> DataFrame:
    """Also give groups without any token, with coverage 0."""
    return groups.join(covered, list(by), "left").fillna(0)


def macro_coverage(covered: DataFrame) -> DataFrame:
    """Plain mean of the group coverages; 0 if there is no group."""
    return covered.agg(F.coalesce(F.avg("coverage"), F.lit(0.0)).alias("coverage"))
