"""Raw tables to the two-column sentiment table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.domain import detect_domain
from ..functions.rules import OBSERVED, RulePack
from ..operators.normalize import clean_text
from ..operators.rows import drop_missing, first_labelled, has_text, keep_nonempty


def clean_rows(rows: DataFrame, rules: RulePack = OBSERVED) -> DataFrame:
    """Canonical rows to cleaned rows: filter, dedup, tag, clean, map, filter.

    One shuffle, the dedup. Texts whose first copy has a label that cannot be
    mapped are dropped after it, as the order of the steps demands; all other
    work happens on rows that survive.
    """
    kept = drop_missing(rows).filter(has_text(F.col("text")))
    first = first_labelled(kept).filter(F.col("sentiment_value").isNotNull())
    tagged = first.withColumn("domain", detect_domain(F.col("text")))
    cleaned = clean_text(tagged, rules=rules, domain="domain")
    return keep_nonempty(cleaned, "cleaned_text").select(
        "source", "source_ord", "row_ord", "domain", "cleaned_text", "sentiment_value"
    )


def two_columns(cleaned: DataFrame) -> DataFrame:
    return cleaned.select("cleaned_text", "sentiment_value")


def row_counts(cleaned: DataFrame) -> DataFrame:
    """Rows for each source, and the total under a null source."""
    return cleaned.rollup("source").agg(F.count(F.lit(1)).alias("rows"))
