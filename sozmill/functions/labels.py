"""Label columns of several schemes as one sentiment value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .rules import (
    DIGIT,
    NEGATIVE_LABELS,
    NEUTRAL_LABELS,
    POSITIVE_LABELS,
    SPACE,
    decimal_digits,
)
from .text import squeeze_ends

SCHEMES = ("binary", "tri")


def binary_sentiment(label: Column, data_type: T.DataType) -> Column:
    """1.0 for the integer one, 0.0 for other integers, null for the rest."""
    if isinstance(data_type, T.BooleanType):
        return label.cast("double")
    if isinstance(data_type, T.IntegralType):
        return F.when(label == 1, 1.0).when(label.isNotNull(), 0.0)
    if isinstance(data_type, T.FractionalType):
        # Integers are cut towards zero; infinities and NaN are none.
        value = label.cast("double")
        finite = ~F.isnan(value) & (F.abs(value) != float("inf"))
        return F.when(finite & (value >= 1) & (value < 2), 1.0).when(finite, 0.0)
    text = label.cast("string")
    integer = f"^[{SPACE}]*[+-]?{DIGIT}+(?:_{DIGIT}+)*[{SPACE}]*$"
    bare = F.regexp_replace(text, f"[{SPACE}_+]", "")
    is_one = bare.rlike(f"^[{decimal_digits(0)}]*[{decimal_digits(1)}]$")
    return F.when(text.rlike(integer), F.when(is_one, 1.0).otherwise(0.0))


def tri_sentiment(label: Column, data_type: T.DataType) -> Column:
    """1.0, 0.5 or 0.0 for a known label name or whole number, else null.

    A fractional number never counts: as text it has a decimal point.
    """
    if isinstance(data_type, T.FractionalType):
        return F.lit(None).cast("double")
    text = squeeze_ends(F.lower(label.cast("string")))
    return (
        F.when(text.isin(*POSITIVE_LABELS), 1.0)
        .when(text.isin(*NEUTRAL_LABELS), 0.5)
        .when(text.isin(*NEGATIVE_LABELS), 0.0)
    )


def sentiment_value(label: Column, scheme: str, data_type: T.DataType) -> Column:
    if scheme == "binary":
        return binary_sentiment(label, data_type)
    if scheme == "tri":
        return tri_sentiment(label, data_type)
    raise ValueError(f"unknown label scheme {scheme!r}")
