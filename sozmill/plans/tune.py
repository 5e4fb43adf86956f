"""Parameter sweep: a fixed, seeded table of trials, one fit for each."""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.rows import head
from ..operators.tokens import token_counts
from ..operators.training import train_word2vec
from ..sources.params import SUBWORD_DEFAULTS, WORD2VEC_DEFAULTS
from ..sources.tables import require_rows
from .evaluate import best_trial, evaluate, evaluate_subwords, score

# Search spaces as (lowest, highest, step) and the tuning budget.
SPACE = dict(
    vector_size=(150, 400, 50), window=(3, 10, 1), min_count=(1, 4, 1), epochs=(5, 12, 1)
)
SUBWORD_SPACE = dict(SPACE, min_n=(3, 4, 1), max_n=(5, 6, 1))
SAMPLE_RANGE = (1e-5, 1e-3)
TRIALS = 20
# The first so many sentences are the documented budget; a caller that wants them passes it.
HEAD_SENTENCES = 200_000


def trial_table(n: int = TRIALS, model: str = "word2vec", seed: int = 42) -> list[dict]:
    """``n`` parameter sets; ``sample`` is drawn on a log scale."""
    draw = random.Random(f"{model}/{seed}")
    space = SPACE if model == "word2vec" else SUBWORD_SPACE
    trials = []
    for trial in range(n):
        params = {k: draw.randrange(lo, hi + 1, step) for k, (lo, hi, step) in space.items()}
        if model == "word2vec":
            low, high = map(math.log, SAMPLE_RANGE)
            params["sample"] = math.exp(draw.uniform(low, high))
        trials.append({"trial": trial, **params})
    return trials


def sweep(
    cleaned: DataFrame,
    pairs: DataFrame,
    trials: list[dict],
    model: str = "word2vec",
    order=("source_ord", "row_ord"),
    limit: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Fit and score every trial.

    Trains on all of ``cleaned``, or on its first ``limit`` rows if the caller asks for
    that; coverage is measured on all of it. The token counts are made once
    and shared by all trials. Only one row for each trial reaches the driver.
    """
    sentences = cleaned if limit is None else head(cleaned, limit, order)
    sentences = require_rows(sentences).cache()
    train_counts = token_counts(sentences, ()).cache()
    counts = token_counts(cleaned, ("source",)).cache()
    rows = []
    for trial in trials:
        base = WORD2VEC_DEFAULTS if model == "word2vec" else SUBWORD_DEFAULTS
        params = {k: v for k, v in {**base, **trial}.items() if k not in ("trial", "min_n", "max_n")}
        vectors = train_word2vec(
            sentences, params, counts=train_counts, num_partitions=num_partitions)
        if model == "word2vec":
            record = evaluate(vectors, counts, pairs)
        else:
            record = evaluate_subwords(vectors, counts, pairs, trial["min_n"], trial["max_n"])
        rows.append({**trial, **record.first().asDict()})
    for frame in (sentences, train_counts, counts):
        frame.unpersist()
    # Declared types: a parameter may be null in every trial.
    real = {"sample", "syn_mean", "ant_mean", "separation", "coverage"}
    names = list(dict.fromkeys(name for row in rows for name in row))
    schema = T.StructType([T.StructField(n, T.DoubleType() if n in real else T.LongType()) for n in names])
    results = cleaned.sparkSession.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)
    return results.withColumn("score", score(F.col("separation"), F.col("coverage")))


def tune(cleaned: DataFrame, pairs: DataFrame, trials: list[dict], **options) -> dict:
    """Parameters of the best trial."""
    names = [k for k in trials[0] if k != "trial"]
    best = best_trial(sweep(cleaned, pairs, trials, **options), *names).first().asDict()
    return {k: best[k] for k in names}
