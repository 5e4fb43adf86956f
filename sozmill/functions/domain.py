"""Domain detection and the rules that apply to one domain only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .rules import (
    CURRENCY_WORDS,
    DIGIT,
    NEGATIVE_RATING,
    NEWS_HINTS,
    POSITIVE_RATING,
    REVIEW_HINTS,
    SOCIAL_WORDS,
    SPACE,
    STAR_WORD,
    WORD,
    caseless,
    caseless_any,
    fixed_part,
    literal,
    whole,
)
from .text import squeeze_spaces


def _mentions(lowered: Column, words) -> Column:
    """One of ``words`` stands in the text; a plain search goes first."""
    found = F.lit(False)
    for part in sorted({fixed_part(word) for word in words}):
        found = found | lowered.contains(part)
    return found & lowered.rlike(whole(caseless_any(words)))


def detect_domain(text: Column) -> Column:
    """``news``, ``social``, ``reviews`` or ``general``, the first that fits."""
    lowered = F.lower(text)
    social = lowered.contains("@") | lowered.contains("#")
    for word in SOCIAL_WORDS:
        # The word comes before the look at what stands in front of it, which is costly.
        social = social | lowered.rlike(f"{literal(word)}(?<![{WORD}]{literal(word)})(?![{WORD}])")
    return (
        F.when(_mentions(lowered, NEWS_HINTS), "news")
        .when(social, "social")
        .when(_mentions(lowered, REVIEW_HINTS), "reviews")
        .otherwise("general")
    )


def price_pattern() -> str:
    words = caseless_any(CURRENCY_WORDS)
    return rf"(?<![{WORD}]){DIGIT}+[{SPACE}]*(?:{words})(?![{WORD}])"


def stars_pattern() -> str:
    return rf"(?<![{WORD}])([1-5])[{SPACE}]*{caseless(STAR_WORD)}(?![{WORD}])"


def tag_ratings(text: Column) -> Column:
    text = F.regexp_replace(text, whole(POSITIVE_RATING), " <RATING_POS> ")
    return F.regexp_replace(text, whole(NEGATIVE_RATING), " <RATING_NEG> ")


def normalize_review(text: Column) -> Column:
    """Prices, stars and ratings of a review as tags."""
    text = F.regexp_replace(text, "(?iu)" + price_pattern(), " <PRICE> ")
    text = F.regexp_replace(text, "(?iu)" + stars_pattern(), " <STARS_$1> ")
    return squeeze_spaces(tag_ratings(text))


def domain_normalize(text: Column, domain: Column) -> Column:
    return F.when(domain == "reviews", normalize_review(text)).otherwise(text)
