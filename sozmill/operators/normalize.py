"""The cleaning chain on a DataFrame.

The chain is laid out as a sequence of projections over one working column.
Each costly rule stands behind a cheap test for the character it needs, so a
row pays only for the rules it can trigger. Spark keeps the projections apart
(the working column is used twice in each) yet runs them in one code-generated
stage: no shuffle, no Python worker, no array of tokens.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import domain as D, text as X
from ..functions.rules import (
    NEGATIVE_RATING,
    OBSERVED,
    POSITIVE_RATING,
    TAG_CHARS,
    TAG_CODES,
    RulePack,
    any_of,
    coded,
)
from .rows import keep_nonempty

_WORK = "__sozmill_text"
_ODD = "__sozmill_odd"
_DIGITS = "__sozmill_digits"


def _apply(df: DataFrame, test, rule) -> DataFrame:
    """Apply ``rule`` to the working column where ``test`` holds."""
    work = F.col(_WORK)
    return df.withColumn(_WORK, F.when(test(work), rule(work)).otherwise(work))


def _set(df: DataFrame, rule) -> DataFrame:
    return df.withColumn(_WORK, rule(F.col(_WORK)))


def _start(df: DataFrame, text: str) -> DataFrame:
    df = df.withColumn(_WORK, F.coalesce(F.col(text), F.lit("")))
    return df.withColumn(_ODD, X.may_need_repair(F.col(_WORK)))


def _repair(df: DataFrame) -> DataFrame:
    """Encoding repair for odd rows, NFC where a character may compose."""
    odd = F.col(_ODD)
    df = _apply(df, lambda t: odd & X.may_be_misread(t), X.read_back)
    df = _apply(df, lambda t: odd, lambda t: X.split_ligatures(X.repair_mojibake(t)))
    df = _apply(df, lambda t: odd & X.has_wide(t), X.narrow)
    return _apply(_apply(df, lambda t: odd, X.drop_control), X.may_compose, X.nfc)


def _emoji(df: DataFrame, rule, rules: RulePack) -> DataFrame:
    emoji = rules.emoji_positive + rules.emoji_negative
    other = [e for e in emoji if not any(0xE000 <= ord(c) <= 0x1FFFF for c in e)]

    def test(text: Column) -> Column:
        return F.col(_ODD) | text.rlike(any_of(other)) if other else F.col(_ODD)

    return _apply(df, test, rule)


def _markup(df: DataFrame) -> DataFrame:
    df = _apply(df, lambda t: t.contains("&"), X.settle_entities)
    df = _apply(df, lambda t: t.contains("&"), X.unescape_html)
    return _apply(df, lambda t: t.contains("<") & t.contains(">"), X.strip_tags)


def _web_items(df: DataFrame, tag) -> DataFrame:
    """URLs and e-mail addresses."""
    df = _apply(
        df,
        X.may_have_url,
        lambda t: X.tag_urls(t, tag("<URL>")),
    )
    return _apply(df, lambda t: t.contains("@"), lambda t: X.tag_emails(t, tag("<EMAIL>")))


def _people_items(df: DataFrame, tag, rules: RulePack) -> DataFrame:
    """Phone numbers, mentions, hashtags."""
    # A simple class on purpose; other digits all lie in its upper range.
    df = df.withColumn(_DIGITS, F.col(_WORK).rlike(r"[0-9\x{660}-\x{10FFFF}]"))
    df = _apply(
        df,
        lambda t: F.col(_DIGITS) & X.may_have_phone(t),
        lambda t: X.tag_phones(t, tag("<PHONE>")),
    )
    df = _apply(df, lambda t: t.contains("@"), lambda t: X.tag_mentions(t, tag("<USER>")))
    return _apply(df, lambda t: t.contains("#"), lambda t: X.open_hashtags(t, rules))


def _lower(df: DataFrame, raw: Column) -> DataFrame:
    # Only a character reference can bring in a character to compose again.
    df = _apply(df, lambda t: raw.contains("&") & X.may_compose(t), X.nfc)
    return _set(df, X.lower_turkic)


def _spaced(df: DataFrame, rules: RulePack) -> DataFrame:
    if rules.numbers_to_token:
        df = _apply(df, lambda t: F.col(_DIGITS), X.code_numbers)
    df = _set(df, lambda t: X.to_spaced_tokens(t, rules))
    if not rules.spelling:
        return df
    return _apply(df, lambda t: X.needs_respelling(t, rules), lambda t: X.respell(t, rules))


def _finish(df: DataFrame, out: str) -> DataFrame:
    return df.withColumn(out, F.col(_WORK)).drop(_WORK, _ODD, _DIGITS)


def _negate(df: DataFrame, rules: RulePack) -> DataFrame:
    if not (rules.negation and rules.negators):
        return df
    return _apply(
        df, lambda t: X.has_negator(t, rules), lambda t: X.negate_spaced(t, rules)
    )


def _observed(df: DataFrame, raw: Column, domain: Column | None, rules: RulePack) -> DataFrame:
    df = _emoji(df, lambda t: X.map_emoji(X.sweep_tag_chars(t), rules), rules)
    df = _web_items(_markup(_repair(df)), str)
    df = _lower(_people_items(df, str, rules), raw)
    df = _negate(_spaced(df, rules), rules)
    df = _set(df, lambda t: X.finish_spaced(t, rules))
    if domain is not None:
        # After the steps above only the two rating phrases can be left.
        df = _apply(
            df,
            lambda t: domain == "reviews",
            lambda t: F.trim(F.regexp_replace(D.tag_ratings(t), " {2,}", " ")),
        )
    return df


def spaced_tokens(
    df: DataFrame, text: str = "text", out: str = "tokens", rules: RulePack = OBSERVED
) -> DataFrame:
    """Add ``out``: the coded token string as it is before spelling repair."""
    df = _start(df, text)
    df = _emoji(df, lambda t: X.map_emoji(X.sweep_tag_chars(t), rules), rules)
    df = _people_items(_web_items(_markup(_repair(df)), str), str, rules)
    df = _spaced(_lower(df, F.coalesce(F.col(text), F.lit(""))), replace(rules, spelling={}))
    return _finish(df, out)


def _char(tag: str) -> str:
    return TAG_CHARS[tag]


def _chars_for_emoji(text: Column, rules: RulePack) -> Column:
    text = F.regexp_replace(text, X.symbols(rules.emoji_positive), f" {_char('<EMO_POS>')} ")
    return F.regexp_replace(text, X.symbols(rules.emoji_negative), f" {_char('<EMO_NEG>')} ")


def protect_items(df: DataFrame, text: str, rules: RulePack) -> DataFrame:
    """First half of the ``intended`` chain, up to the sentence split.

    Tags are inserted as characters that lowercasing and sentence ends cannot
    touch, which is what the documented behaviour needs.
    """
    df = _start(df, text)
    df = _apply(df, lambda t: F.col(_ODD), X.sweep_tag_chars)
    df = _emoji(_repair(_markup(df)), lambda t: _chars_for_emoji(t, rules), rules)
    return _web_items(df, _char)


def _intended_rest(df: DataFrame, domain: Column | None, rules: RulePack) -> DataFrame:
    df = _set(_people_items(df, _char, rules), X.lower_turkic)
    review = F.lit(False) if domain is None else domain == "reviews"

    def amounts(text: Column) -> Column:
        text = F.regexp_replace(text, D.price_pattern(), f" {_char('<PRICE>')} ")
        for n in "12345":
            pattern = D.stars_pattern().replace("[1-5]", n)
            text = F.regexp_replace(text, pattern, f" {_char(f'<STARS_{n}>')} ")
        return text

    def ratings(spaced: Column) -> Column:
        for phrase, tag in ((POSITIVE_RATING, "<RATING_POS>"), (NEGATIVE_RATING, "<RATING_NEG>")):
            words = " +".join(phrase.split())
            spaced = F.regexp_replace(spaced, f"(?<= ){coded(words)}(?= )", TAG_CODES[tag])
        return spaced

    df = _apply(df, lambda t: review, amounts)
    df = _spaced(df, rules)
    df = _negate(_apply(df, lambda t: review, ratings), rules)
    return _set(df, lambda t: X.finish_spaced(t, rules))


def clean_text(
    df: DataFrame,
    text: str = "text",
    out: str = "cleaned_text",
    rules: RulePack = OBSERVED,
    domain: str | None = None,
) -> DataFrame:
    """Add ``out``, the cleaned form of ``text``; null text gives ``""``.

    With ``domain`` the rules of that domain are applied too. All columns are
    kept. Works on batch and streaming DataFrames alike.
    """
    dom = F.col(domain) if domain else None
    if rules.intended:
        done = _intended_rest(protect_items(df, text, rules), dom, rules)
    else:
        done = _observed(_start(df, text), F.coalesce(F.col(text), F.lit("")), dom, rules)
    if out in df.columns and out != text:
        done = done.drop(out)
    return _finish(done, out)


def clean_sentences(
    df: DataFrame,
    text: str = "text",
    out: str = "sentence",
    rules: RulePack = OBSERVED,
    domain: str | None = None,
) -> DataFrame:
    """One row per non-empty cleaned sentence, with its place in ``sent_ord``.

    Under the ``observed`` rules the sentence marks are gone before the split,
    so each text is one sentence; under ``intended`` the text is split first.
    """
    if not rules.intended:
        cleaned = keep_nonempty(clean_text(df, text, out, rules), out)
        return cleaned.withColumn("sent_ord", F.lit(0))
    cleaned = protect_items(df, text, rules)
    parts = X.split_sentences(F.col(_WORK))
    keep = [c for c in df.columns if c not in (out, "sent_ord")]
    rows = cleaned.select(*keep, F.posexplode(parts).alias("sent_ord", _WORK))
    dom = F.col(domain) if domain else None
    rows = _finish(_intended_rest(rows, dom, rules), out)
    return keep_nonempty(rows, out)
