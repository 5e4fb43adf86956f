"""Raw tables to domain-tagged corpus lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.domain import detect_domain
from ..functions.rules import OBSERVED, RulePack
from ..operators.normalize import clean_sentences


def corpus_lines(rows: DataFrame, rules: RulePack = OBSERVED, domain: str | None = None) -> DataFrame:
    """``value`` holds one tagged line for each sentence; copies are kept.

    Only rows without text are left out: no dedup, no label needed. There is
    no shuffle at all. With a ``domain`` only its texts are cleaned: the domain is
    known before.
    """
    texts = rows.filter(F.col("text").isNotNull()).select(
        "source", "source_ord", "row_ord", "text", detect_domain(F.col("text")).alias("domain")
    )
    if domain is not None:
        # A generator: a plain filter would go below the shuffle that spreads a small scan,
        # and the domain rules would run there, on its few tasks, and once more here.
        wanted = F.when(F.col("domain") == domain, F.array("domain"))
        texts = texts.select("source", "source_ord", "row_ord", "text", F.explode(wanted).alias("domain"))
    sentences = clean_sentences(texts, rules=rules, domain="domain")
    # Neither rule set leaves punctuation or more than single spaces, so there
    # is nothing left to strip and no line can become empty.
    body = F.col("sentence") if rules.intended else F.lower("sentence")
    line = F.concat(F.lit("dom"), F.col("domain"), F.lit(" "), body)
    return sentences.select(
        "source", "source_ord", "row_ord", "sent_ord", "domain", line.alias("value")
    )


def of_domain(lines: DataFrame, domain: str) -> DataFrame:
    """Lines of one domain, by their tag."""
    return lines.filter(F.col("value").startswith(f"dom{domain} "))
