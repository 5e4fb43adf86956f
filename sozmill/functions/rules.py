"""Rule sets and character classes shared by the text functions.

``RulePack`` is the only configuration object of the cleaning chain. It is
immutable and is turned into literals when a plan is built, so nothing is
shipped to the executors besides the plan itself.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache
from types import MappingProxyType
from typing import Mapping

# Needed as they are for matching results.
EMOJI_POSITIVE = ("😊", "😄", "😍", "👍", "😁")
EMOJI_NEGATIVE = ("😞", "😠", "😟", "😢", "😡")
SPELLING = MappingProxyType(
    {"sim": "salam", "tmm": "tamam", "sagol": "sağol", "cox": "çox", "yaxsi": "yaxşı"}
)
NEGATORS = ("yox", "deyil", "heç", "qətiyyən", "yoxdur")
KEPT_SHORT_TOKENS = ("o", "e")
NEWS_HINTS = ("apa", "trend", "azertac", "reuters", "bloomberg", "dha")
SOCIAL_WORDS = ("rt",)
REVIEW_HINTS = ("azn", "manat", "qiymət", "aldım", "ulduz", "çox yaxşı", "çox pis")
CURRENCY_WORDS = ("azn", "manat")
STAR_WORD = "ulduz"
POSITIVE_RATING = "çox yaxşı"
NEGATIVE_RATING = "çox pis"
LOWER_LETTERS = "abcdefghijklmnopqrstuvwxyzəğıöüçş"
TOKEN_LETTERS = "A-Za-zəƏĞğıİÖöÜüÇçŞş"
DOMAINS = ("news", "social", "reviews", "general")
TOKEN_TAGS = ("<NUM>", "<URL>", "<EMAIL>", "<PHONE>", "<USER>", "<EMO_POS>", "<EMO_NEG>")
REVIEW_TAGS = (
    "<PRICE>", "<STARS_1>", "<STARS_2>", "<STARS_3>", "<STARS_4>", "<STARS_5>",
    "<RATING_POS>", "<RATING_NEG>",
)
NEGATION_SUFFIX = "_NEG"
POSITIVE_LABELS = ("pos", "positive", "1", "müsbət", "good", "pozitiv")
NEUTRAL_LABELS = ("neu", "neutral", "2", "neytral")
NEGATIVE_LABELS = ("neg", "negative", "0", "mənfi", "bad", "negativ")
STOPWORD_CANDIDATES = (
    "və", "amma", "lakin", "çünki", "belə", "hətta", "bütün", "əgər", "yenə", "sonra",
)

# Bodies of character classes (to be put between brackets). They are spelled
# out instead of using \w, \s and (?U) so that they mean the same in every
# engine and every Java release.
WORD = r"\p{L}\p{N}_"
SPACE = r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x85\p{Z}"
DIGIT = r"\p{Nd}"

# While a text is one string, a private-use character stands for each tag; the
# characters are swept from the input first.
_TAGS = TOKEN_TAGS + REVIEW_TAGS
TAG_CHARS = MappingProxyType({tag: chr(0xE000 + i) for i, tag in enumerate(_TAGS)})
TAG_CLASS = r"\x{E000}-\x{E00E}"
TAG_SWEPT = chr(0xE00F)
# Stands for the capital I of an all-ASCII hashtag, which lowers to a dotted i.
ASCII_CAPITAL_I = chr(0xE010)

# Lowercased text has no capitals, so Latin-1 capitals are free to stand for
# the letters beyond Latin-1, the tags and the negation suffix. Every class of
# the token rules is then a Latin-1 bit set, ten times faster in Java than a
# class with several letters beyond it.
LETTER_CODES = MappingProxyType({"ə": "À", "ğ": "Á", "ı": "Â", "ş": "Ã"})
TAG_CODES = MappingProxyType({tag: chr(0xC4 + i) for i, tag in enumerate(_TAGS)})
SUFFIX_CODE = "Þ"
CODED_LETTERS = "".join(LETTER_CODES.get(c, c) for c in LOWER_LETTERS)
CODED_TAGS = "".join(TAG_CODES.values())


def coded(word: str) -> str:
    return "".join(LETTER_CODES.get(c, c) for c in word)


def literal(text: str) -> str:
    """Quote ``text`` for a Java regular expression."""
    return re.sub(r"([\\^$.|?*+()\[\]{}\-&])", r"\\\1", text)


def any_of(words) -> str:
    """Alternation of literal words, longest first."""
    return "|".join(literal(w) for w in sorted(words, key=lambda w: (-len(w), w)))


def whole(pattern: str) -> str:
    """``pattern`` with word boundaries that know all letters and digits."""
    return rf"(?<![{WORD}])(?:{pattern})(?![{WORD}])"


# A letter and the further characters a case-insensitive match accepts for it
# once the text has been lowercased.
_CASE_TWINS = {"i": "[iı]", "ı": "[iı]", "s": "[s" + chr(0x17F) + "]"}


def caseless(word: str) -> str:
    """Pattern for ``word`` on lowercased text, with its case-fold twins."""
    return "".join(_CASE_TWINS.get(ch, literal(ch)) for ch in word)


def fixed_part(word: str) -> str:
    """Longest part of ``word`` that has only one case-insensitive spelling."""
    parts = re.split("|".join(_CASE_TWINS), word)
    return max(parts, key=len)


def caseless_any(words) -> str:
    return "|".join(caseless(w) for w in sorted(words, key=lambda w: (-len(w), w)))


@lru_cache(maxsize=None)
def decimal_digits(value: int) -> str:
    """Every character that is the decimal digit ``value`` in some script."""
    return "".join(
        ch for ch in map(chr, range(0x110000)) if unicodedata.decimal(ch, None) == value
    )


@dataclass(frozen=True)
class RulePack:
    """Everything the cleaning chain can be told.

    ``mode="observed"`` gives the results the original scripts really give;
    ``mode="intended"`` gives what their documentation promises (tags survive
    lowercasing, sentences are split, ratings count for reviews).
    """

    mode: str = "observed"
    emoji_positive: tuple = EMOJI_POSITIVE
    emoji_negative: tuple = EMOJI_NEGATIVE
    spelling: Mapping[str, str] = field(default_factory=lambda: SPELLING)
    negators: tuple = NEGATORS
    negation: bool = True
    negation_scope: int = 3
    numbers_to_token: bool = True
    kept_short_tokens: tuple = KEPT_SHORT_TOKENS

    def __post_init__(self):
        if self.mode not in ("observed", "intended"):
            raise ValueError(f"unknown rule mode {self.mode!r}")
        if self.negation_scope < 1:
            raise ValueError("negation_scope must be at least 1")

    @property
    def intended(self) -> bool:
        return self.mode == "intended"


OBSERVED = RulePack()
INTENDED = RulePack(mode="intended")
