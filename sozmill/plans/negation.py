"""What marking negation does to a model: two fits on the same texts, and how their neighbours differ."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from ..functions.rules import NEGATION_SUFFIX, OBSERVED, RulePack
from ..operators.normalize import clean_text
from ..operators.similarity import list_overlap, nearest_neighbours
from ..operators.tokens import token_counts
from ..operators.training import train_word2vec
from ..sources.tables import materialize


def both_cleanings(texts: DataFrame, text: str = "text", rules: RulePack = OBSERVED) -> DataFrame:
    """``texts`` with ``cleaned_text`` as the rules give it, and ``plain_text`` without negation marks.

    A mark is a suffix of a token, so the text is cleaned once. Marked one-letter words, which only the mark
    kept, are dropped from the plain text, as they are where nothing is marked.
    """
    marked = clean_text(texts, text, rules=replace(rules, negation=True))
    tokens = F.split("cleaned_text", " ", -1)
    bare = F.transform(tokens, lambda t: F.regexp_replace(t, f"{NEGATION_SUFFIX}$", ""))
    short = list(rules.kept_short_tokens)
    kept = F.filter(bare, lambda t: (F.length(t) != 1) | t.isin(short))
    return marked.withColumn("plain_text", F.array_join(kept, " "))


def negation_models(cleaned: DataFrame, params: dict | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """Word vectors of the marked and of the plain text of ``both_cleanings``."""
    kept = materialize(cleaned.select("cleaned_text", "plain_text"))
    return tuple(
        train_word2vec(kept, params, token_counts(kept, (), column), text=column, **options)
        for column in ("cleaned_text", "plain_text"))


def negation_overlap(marked: DataFrame, plain: DataFrame, seeds: DataFrame, k: int = 5) -> DataFrame:
    """For each seed how alike its neighbours are with and without negation marks.

    A seed that one of the models doesn't know has no neighbour in common.
    """
    found = list_overlap(nearest_neighbours(marked, seeds, k), nearest_neighbours(plain, seeds, k), k)
    return seeds.select(F.col("word").alias("seed")).distinct().join(found, "seed", "left").fillna(
        0, ["shared", "overlap"])
