"""Training corpus from raw documents: the stages and their order.

Each stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
give the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sozmill.llm import bpe, cotraining, decontaminate, divergence, jaccard
from sozmill.llm.common import ship, stored, table
from sozmill.llm.queries import RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base counts and the divergence rules."""
    return divergence.passing(docs, divergence.references(docs))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps.

    It learns from the table of documents, as the rules before have taken most
    of the bad examples out of ``docs``.
    """
    ship(spark)
    model = cotraining.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return cotraining.score(docs, model, keep_text=True).filter("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word Jaccard similarity of 0.8 or more: the least id."""
    ship(spark)
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the bytes decoded from them."""
    ship(spark)
    return bpe.round_trip(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", byte_bpe),
]

#: The classifier and the similarity join can't be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
