"""The cleaning chain on a stream.

Domain, text and label rules look at one row at a time, so they run on a
streaming DataFrame as they are. First-wins dedup and all counts need the
whole input and stay batch work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.domain import detect_domain
from ..functions.rules import OBSERVED, RulePack
from ..operators.normalize import clean_text
from ..operators.rows import has_text, keep_nonempty


def clean_stream(rows: DataFrame, rules: RulePack = OBSERVED, text: str = "text") -> DataFrame:
    """Add ``domain`` and ``cleaned_text``; drop rows with nothing left."""
    tagged = rows.filter(has_text(F.col(text))).withColumn("domain", detect_domain(F.col(text)))
    return keep_nonempty(clean_text(tagged, text, rules=rules, domain="domain"), "cleaned_text")
