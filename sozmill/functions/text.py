"""Text rules as ``Column -> Column`` functions.

Every rule is a composition of built-in expressions. ``normalize`` chains
them for use inside any expression; ``sozmill.operators.normalize`` builds the
same result step by step on a DataFrame and skips the rules a row cannot need.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .encoding import high_characters, may_be_misread, read_back
from .entities import unescape_html
from .rules import (
    ASCII_CAPITAL_I,
    CODED_LETTERS,
    CODED_TAGS,
    DIGIT,
    LETTER_CODES,
    NEGATION_SUFFIX,
    OBSERVED,
    REVIEW_TAGS,
    SPACE,
    SUFFIX_CODE,
    TAG_CHARS,
    TAG_CLASS,
    TAG_CODES,
    TAG_SWEPT,
    TOKEN_LETTERS,
    TOKEN_TAGS,
    WORD,
    RulePack,
    any_of,
    coded,
)

__all__ = [
    "high_characters", "map_emoji", "may_be_misread", "read_back", "repair_encoding", "nfc", "settle_entities", "unescape_html", "strip_tags", "tag_urls",
    "tag_emails", "tag_phones", "tag_mentions", "split_hashtags", "lower_az",
    "squeeze_punctuation", "squeeze_spaces", "tag_numbers", "drop_punctuation",
    "extract_tokens", "collapse_repeats", "fix_spelling", "mark_negation",
    "drop_short_tokens", "join_tokens", "split_sentences", "corpus_line",
    "whitespace_tokens", "normalize",
]

_URL = rf"(?iu)(?:https?://|www\.)[^{SPACE}]+"
_EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
_EMAIL = rf"{_EDGE}[{WORD}.\-]++@[{WORD}.\-]+\.[{WORD}]++"
_DIAL = rf"{DIGIT}{SPACE}\-()"
# A number can only start where a run of its characters starts, so each run is
# read once however long it is.
_PHONE = rf"\+?(?<![{_DIAL}])[{_DIAL}]{{6,}}{DIGIT}"
_ASCII_TAG = r"#([A-Za-z0-9_]+)"
_ASCII_CAMEL = r"(#|\G(?!^))([A-Za-z0-9_]*?[a-z])(?=[A-Z])"
_ANY_TAG = rf"#([{WORD}{ASCII_CAPITAL_I}]+)"
_ANY_CAMEL = (
    rf"(#|\G(?!^))([{WORD}{ASCII_CAPITAL_I}]*?\p{{Ll}})(?=[\p{{Lu}}{ASCII_CAPITAL_I}])"
)
_ASCII_TAG_I = rf"(#(?=[A-Za-z0-9_]+(?![{WORD}]))|\G(?!^))([A-HJ-Za-z0-9_]*)I"


# --- T1-T3: emoji, encoding, entities --------------------------------------

def symbols(words) -> str:
    """Any of ``words``; where none starts with an ASCII character, those are passed over by one test."""
    plain = not words or any(not w or w[0] < "\x80" for w in words)
    return any_of(words) if plain else rf"(?![\x00-\x7F])(?:{any_of(words)})"


def map_emoji(text: Column, rules: RulePack = OBSERVED) -> Column:
    """Put a sentiment tag in place of each listed emoji."""
    out = F.regexp_replace(text, symbols(rules.emoji_positive), " <EMO_POS> ")
    return F.regexp_replace(out, symbols(rules.emoji_negative), " <EMO_NEG> ")


def _mojibake_pairs() -> list[tuple[str, str]]:
    """UTF-8 letters that were once decoded as Windows-1252, and their repair."""
    pairs = []
    for letter in "ÜüÖöÇçĞğıİŞşƏə":
        raw = letter.encode("utf-8")
        try:
            wrong = raw.decode("cp1252")
        except UnicodeDecodeError:
            wrong = "".join(
                bytes([b]).decode("cp1252", "ignore") or chr(b) for b in raw
            )
        pairs.append((wrong, letter))
    return pairs


_LIGATURES = (
    (chr(0xFB00), "ff"), (chr(0xFB01), "fi"), (chr(0xFB02), "fl"), (chr(0xFB03), "ffi"),
    (chr(0xFB04), "ffl"), (chr(0xFB05), chr(0x17F) + "t"), (chr(0xFB06), "st"),
)
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + chr(0x3000)
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "
_ASCII_CONTROL = "".join(rf"\x{c:02X}" for c in (*range(9), *range(14, 32), 127))
_CONTROL = rf"[{_ASCII_CONTROL}\x{{206A}}-\x{{206F}}\x{{FEFF}}\x{{FFF9}}-\x{{FFFC}}]"


def nfc(text: Column) -> Column:
    """Canonical composition (NFC) through the ICU library Spark ships.

    Null becomes the empty string, as everywhere in this chain.
    """
    return F.call_function(
        "reflect",
        F.lit("com.ibm.icu.text.Normalizer"),
        F.lit("compose"),
        F.coalesce(text, F.lit("")),
        F.lit(False),
    )


def may_compose(text: Column) -> Column:
    """False only where NFC changes nothing: no character below U+0300 ever composes."""
    return text.rlike(r"[\x{300}-\x{10FFFF}]")


def has_wide(text: Column) -> Column:
    return text.rlike(r"[\x{FF01}-\x{FF5E}]")


def may_need_repair(text: Column) -> Column:
    """False only where the emoji and encoding rules change nothing.

    Passes over simple character classes; coarse, so that they stay simple.
    """
    leads = "".join(sorted({wrong[0] for wrong, _ in _mojibake_pairs()}))
    # Printable ASCII is passed over by one test.
    odd = text.rlike(rf"(?![\x20-\x7E])[{leads}{_ASCII_CONTROL}\x{{206A}}-\x{{206F}}\x{{E000}}-\x{{1FFFF}}]")
    return odd | may_be_misread(text)


def narrow(text: Column) -> Column:
    return F.translate(text, _WIDE, _NARROW)


def split_ligatures(text: Column) -> Column:
    for ligature, letters in _LIGATURES:
        text = F.replace(text, F.lit(ligature), F.lit(letters))
    return text


def repair_mojibake(text: Column) -> Column:
    for wrong, letter in _mojibake_pairs():
        text = F.replace(text, F.lit(wrong), F.lit(letter))
    return text


def drop_control(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?![\x20-\x7E]){_CONTROL}", "")


def repair_encoding(text: Column) -> Column:
    """Read misread lines back, repair common letters in the rest, wide forms, ligatures, controls; then NFC."""
    # Composed unasked: a test before it would have the whole chain computed once more.
    return nfc(drop_control(narrow(split_ligatures(repair_mojibake(read_back(F.coalesce(text, F.lit(""))))))))


# --- T4-T9: markup, special items, hashtags --------------------------------

def may_have_url(text: Column) -> Column:
    """Coarse test by plain searches, which are far cheaper than a pattern."""
    found = text.contains("://")
    for end in ("ww.", "WW.", "wW.", "Ww."):
        found = found | text.contains(end)
    return found


def settle_entities(text: Column) -> Column:
    """Replace nested character references until none is left, in lines without ``<``.

    A line is read again only while that changes it. It has more readings than
    its references and names of ampersands at no time, as each uses up one. What stands
    before its first ampersand is never read.
    """
    def settled(whole: Column) -> Column:
        place = F.locate("&", whole)
        line = F.substr(whole, place)
        most = F.regexp_count(line, F.lit("(?i)&|amp|#0*38|#x0*26")) * 2 + 1
        # Two loops, as one can't be left: after the last reading only the outer one runs on.
        some = F.sequence(F.lit(1), F.ceil(F.sqrt(most)).cast("int"))
        start = F.struct(F.lit("").alias("before"), line.alias("now"))

        def read(state: Column, _: Column) -> Column:
            before, now = state["before"], state["now"]
            settled = F.struct(F.lit(None).cast("string").alias("before"), now.alias("now"))
            again = F.struct(now.alias("before"), unescape_html(now).alias("now"))
            return F.when(before.isNull(), state).when(
                (before == now) | ~now.rlike("&[#A-Za-z]"), settled).otherwise(again)

        def read_some(state: Column, _: Column) -> Column:
            return F.when(state["before"].isNull(), state).otherwise(F.aggregate(some, state, read))

        done = F.aggregate(some, start, read_some, lambda state: state["now"])
        return F.concat(F.substr(whole, F.lit(1), place - 1), done)

    lines = F.transform(F.split(text, "\n", -1), lambda line: F.when(
        line.contains("&") & ~line.contains("<"), settled(line)).otherwise(line))
    return F.array_join(lines, "\n")


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", " ")


def tag_urls(text: Column, tag: str = "<URL>") -> Column:
    return F.regexp_replace(text, _URL, f" {tag} ")


def tag_emails(text: Column, tag: str = "<EMAIL>") -> Column:
    return F.regexp_replace(text, _EMAIL, f" {tag} ")


def may_have_phone(text: Column) -> Column:
    """Coarse test: seven characters in a row that a phone number could have."""
    space = r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F\x20\x85\xA0"
    run = rf"[0123456789{space}\-()\x{{300}}-\x{{10FFFF}}]"
    return text.rlike(rf"{run}{{6}}(?:[\p{{Nd}}]|{run})")


def tag_phones(text: Column, tag: str = "<PHONE>") -> Column:
    return F.regexp_replace(text, _PHONE, f" {tag} ")


def tag_mentions(text: Column, tag: str = "<USER>") -> Column:
    return F.regexp_replace(text, rf"@[{WORD}]+", f" {tag} ")


def open_hashtags(text: Column, rules: RulePack) -> Column:
    """Split hashtags but leave the ``#`` in front of each."""
    if not rules.intended:
        return F.regexp_replace(
            F.regexp_replace(text, _ASCII_TAG, " #$1 "), _ASCII_CAMEL, "$1$2 "
        )
    text = F.regexp_replace(text, _ASCII_TAG_I, f"$1$2{ASCII_CAPITAL_I}")
    text = F.regexp_replace(F.regexp_replace(text, _ANY_TAG, " #$1 "), _ANY_CAMEL, "$1$2 ")
    return F.replace(text, F.lit(ASCII_CAPITAL_I), F.lit("i"))


def split_hashtags(text: Column, rules: RulePack = OBSERVED) -> Column:
    """``#CamelCase`` to separate words."""
    inside = WORD if rules.intended else "A-Za-z0-9_"
    return F.regexp_replace(open_hashtags(text, rules), f"#(?=[{inside}])", "")


# --- T10-T12: case, punctuation, numbers -----------------------------------

def lower_turkic(text: Column) -> Column:
    text = F.replace(text, F.lit("I"), F.lit("ı"))
    return F.lower(F.replace(text, F.lit("İ"), F.lit("i")))


def lower_az(text: Column) -> Column:
    """Azerbaijani lowercase: dotless and dotted i stay apart."""
    return lower_turkic(nfc(text))


def squeeze_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, r"([!?.,;:])\1+", "$1")


def squeeze_spaces(text: Column) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def tag_numbers(text: Column) -> Column:
    return F.regexp_replace(text, f"{DIGIT}+", " <NUM> ")


def drop_punctuation(text: Column, keep_sentence_punct: bool = False) -> Column:
    kept = ".!?" if keep_sentence_punct else ""
    return F.regexp_replace(text, f"[^{WORD}{SPACE}<>'{kept}]", " ")


# --- T13-T16: tokens --------------------------------------------------------

def extract_tokens(text: Column, rules: RulePack = OBSERVED) -> Column:
    """Runs of Azerbaijani letters and the known tags; all else is dropped."""
    tags = TOKEN_TAGS + (REVIEW_TAGS if rules.intended else ())
    return F.regexp_extract_all(text, F.lit(f"[{TOKEN_LETTERS}]+|" + "|".join(tags)), F.lit(0))


def collapse_repeats(text: Column) -> Column:
    """Three or more of one character become two."""
    return F.regexp_replace(text, r"([^\n])\1{2,}", "$1$1")


def _look_up(table, token: Column) -> Column:
    """Value for ``token`` in a small table, or the token itself."""
    words = F.array(*[F.lit(w) for w in table])
    values = F.array(*[F.lit(v) for v in table.values()])
    place = F.array_position(words, token)
    found = F.element_at(values, F.greatest(place, F.lit(1)).cast("int"))
    return F.when(place > 0, found).otherwise(token)


def fix_spelling(token: Column, rules: RulePack = OBSERVED) -> Column:
    """Dictionary form of one token, or the token itself."""
    if not rules.spelling:
        return token
    return _look_up(rules.spelling, token)


def _mark_scope(spaced: Column, negators, scope: int, tag: str, word: str, suffix: str) -> Column:
    """Suffix the tokens in the scope of a negator, one pass for each place.

    Pass k reads a negator, the k words already suffixed after it and any tags
    in between, and suffixes the next word unless that is a negator. ``tag``
    matches one tag and ``word`` one character of a word.
    """
    negator = any_of(negators)
    tags = rf"(?: +{tag})*+"
    done = rf"(?: +{word}+{suffix}(?= ){tags})"
    for place in range(scope):
        pattern = (
            rf"( (?:{negator})(?= ){tags}{done}{{{place}}}) +"
            rf"(?!(?:{negator}) )({word}+)(?= )"
        )
        spaced = F.regexp_replace(spaced, pattern, f"$1 $2{suffix}")
    return spaced


def mark_negation(text: Column, rules: RulePack = OBSERVED) -> Column:
    """Suffix the words after a negator in space-separated ``text``.

    Tags are neither suffixed nor counted; another negator starts a new scope.
    """
    if not (rules.negation and rules.negators):
        return text
    spaced = F.concat(F.lit(" "), text, F.lit(" "))
    return F.trim(
        _mark_scope(
            spaced, rules.negators, rules.negation_scope, "<[^ ]*", "[^ <]", NEGATION_SUFFIX
        )
    )


def drop_short_tokens(tokens: Column, rules: RulePack = OBSERVED) -> Column:
    kept = list(rules.kept_short_tokens)
    return F.filter(tokens, lambda t: (F.length(t) != 1) | t.isin(kept))


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


# --- T18-T20: sentences, corpus lines, white-space tokens -------------------

def split_sentences(text: Column) -> Column:
    """Non-empty stripped parts between runs of ``.``, ``!`` and ``?``."""
    parts = F.transform(F.split(text, r"[.!?]+", -1), squeeze_ends)
    return F.filter(parts, lambda p: p != "")


def squeeze_ends(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def corpus_line(domain: Column, sentence: Column, rules: RulePack = OBSERVED) -> Column:
    """``dom<domain> <text>``; null when nothing is left of the text."""
    if rules.intended:
        body = squeeze_spaces(sentence)
    else:
        body = F.regexp_replace(sentence, f"[^{WORD}{SPACE}<>']", "")
        body = F.lower(squeeze_spaces(body))
    return F.when(body != "", F.concat(F.lit("dom"), domain, F.lit(" "), body))


def whitespace_tokens(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+", -1), lambda t: t != "")


# --- The chain on one string -------------------------------------------------
# From here on the tokens are kept in one string with a space around each,
# letters and tags coded as said in the rules module: string passes are far
# cheaper than arrays of tokens.

def sweep_tag_chars(text: Column) -> Column:
    return F.regexp_replace(text, f"[{TAG_CLASS}{ASCII_CAPITAL_I}]", TAG_SWEPT)


MAX_CHAINED_WORDS = 16


def code_numbers(lowered: Column) -> Column:
    return F.regexp_replace(lowered, f"{DIGIT}+", f" {TAG_CODES['<NUM>']} ")


def to_spaced_tokens(lowered: Column, rules: RulePack) -> Column:
    """Lowercased text with coded numbers to spaced coded tokens."""
    if rules.intended:
        for tag, char in TAG_CHARS.items():
            lowered = F.replace(lowered, F.lit(char), F.lit(TAG_CODES[tag]))
    for letter, code in LETTER_CODES.items():
        lowered = F.replace(lowered, F.lit(letter), F.lit(code))
    spaced = F.regexp_replace(lowered, f"[^{CODED_LETTERS}{CODED_TAGS}]+", " ")
    spaced = F.regexp_replace(spaced, r"([^ ])\1\1+", "$1$1")
    return F.concat(F.lit(" "), spaced, F.lit(" "))


def _has_any(spaced: Column, words) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | spaced.contains(f" {coded(word)} ")
    return found


def needs_respelling(spaced: Column, rules: RulePack) -> Column:
    # A long dictionary is looked up by token, with no search for each word.
    if len(rules.spelling) > MAX_CHAINED_WORDS:
        return F.lit(True)
    return _has_any(spaced, rules.spelling)


def respell(spaced: Column, rules: RulePack) -> Column:
    if not rules.spelling:
        return spaced
    table = {coded(word): coded(repaired) for word, repaired in rules.spelling.items()}
    if len(table) > MAX_CHAINED_WORDS or set(table) & set(table.values()):
        words = F.transform(F.split(F.trim(spaced), " +", -1), lambda t: _look_up(table, t))
        return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    for word, repaired in table.items():
        # Neighbours share a space, so one pass can miss every second one.
        for _ in range(2):
            spaced = F.replace(spaced, F.lit(f" {word} "), F.lit(f" {repaired} "))
    return spaced


def _coded_negators(rules: RulePack) -> list[str]:
    return [coded(word) for word in rules.negators]


def has_negator(spaced: Column, rules: RulePack) -> Column:
    return _has_any(spaced, rules.negators)


def negate_spaced(spaced: Column, rules: RulePack) -> Column:
    return _mark_scope(
        spaced,
        _coded_negators(rules),
        rules.negation_scope,
        f"[{CODED_TAGS}]",
        f"[{CODED_LETTERS}]",
        SUFFIX_CODE,
    )


def finish_spaced(spaced: Column, rules: RulePack) -> Column:
    """Drop short tokens and write the codes out."""
    kept = {coded(token) for token in rules.kept_short_tokens}
    dropped = "".join(c for c in CODED_LETTERS if c not in kept)
    out = F.trim(F.regexp_replace(spaced, f" [{dropped}](?= )", ""))
    for letter, code in LETTER_CODES.items():
        out = F.replace(out, F.lit(code), F.lit(letter))
    for tag in TAG_CODES if rules.intended else ["<NUM>"]:
        out = F.replace(out, F.lit(TAG_CODES[tag]), F.lit(tag))
    return F.replace(out, F.lit(SUFFIX_CODE), F.lit(NEGATION_SUFFIX))


def normalize(text: Column, rules: RulePack = OBSERVED) -> Column:
    """The whole ``observed`` chain as one expression; null gives ``""``."""
    if rules.intended:
        raise ValueError("use sozmill.operators.normalize for the intended rules")
    out = strip_tags(unescape_html(settle_entities(repair_encoding(map_emoji(sweep_tag_chars(text), rules)))))
    out = tag_mentions(tag_phones(tag_emails(tag_urls(out))))
    out = lower_az(open_hashtags(out, rules))
    out = to_spaced_tokens(code_numbers(out) if rules.numbers_to_token else out, rules)
    out = respell(out, rules)
    if rules.negation and rules.negators:
        out = negate_spaced(out, rules)
    return finish_spaced(out, rules)
