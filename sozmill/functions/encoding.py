"""Texts whose UTF-8 bytes were once read in a single-byte code page.

A line is taken back to its bytes in each code page that has all its characters,
and these are read as UTF-8. Of the line itself and its readings the one that
looks least like such a mistake is kept, again and again until that is the line.
Code pages come from Python's codecs when the plan is built and travel as literals.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, functions as F

#: In this order of equal readings: Western, Turkish, Central European, Cyrillic. Others, such as the
#: Baltic one, give the same characters to other bytes than these, so their texts can't be told apart.
CODE_PAGES = ("cp1252", "cp1254", "cp1250", "cp1251")


@lru_cache(maxsize=None)
def high_characters(page: str) -> str:
    """The characters of the bytes 0x80 to 0xFF; a byte without one stands for itself, as in Latin-1."""
    return "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in range(0x80, 0x100))


def _sequence(page: str) -> str:
    """What a character of two to four UTF-8 bytes looks like in a code page."""
    high = high_characters(page)
    rest, two, three, four = (_ranges(high[a - 0x80:b - 0x80]) for a, b in (
        (0x80, 0xC0), (0xC2, 0xE0), (0xE0, 0xF0), (0xF0, 0xF5)))
    return rf"(?![\x00-\x7F])(?:[{two}][{rest}]|[{three}][{rest}]{{2}}|[{four}][{rest}]{{3}})"


def _ranges(chars) -> str:
    """Body of a character class, with runs of characters as ranges."""
    runs: list[list[int]] = []
    for c in sorted({ord(c) for c in chars}):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in runs)


#: Java asks a class with many letters beyond Latin-1 for each of them in turn. So one test for ASCII
#: comes first in all patterns, and the classes look back at what it let pass.
_HIGH = r"[^\x00-\x7F]"


@lru_cache(maxsize=None)
def _any_sequence() -> str:
    """A lead byte and a further one, in any code page; coarse."""
    leads = {c for page in CODE_PAGES for c in high_characters(page)[0x42:0x75]}
    rest = {c for page in CODE_PAGES for c in high_characters(page)[:0x40]}
    return f"{_HIGH}{_HIGH}(?<=[{_ranges(leads)}][{_ranges(rest)}])"


def may_be_misread(text: Column) -> Column:
    """False only where no line can be read otherwise."""
    return text.rlike(_any_sequence())


#: Control characters, the replacement character, and phonetic letters and marks but for the Azerbaijani schwa: a
#: capital before a closing quotation mark would be read as one of these.
_UNLIKELY = rf"{_HIGH}(?<=[\x{{80}}-\x{{9F}}\x{{FFFD}}\x{{250}}-\x{{258}}\x{{25A}}-\x{{2BF}}])"


def misreading_cost(line: Column) -> Column:
    """How much of a line looks misread: sequences of UTF-8 bytes in any page, and unlikely characters."""
    return F.regexp_count(line, F.lit(_any_sequence())) + F.regexp_count(line, F.lit(_UNLIKELY))


def reading(line: Column, page: str) -> Column:
    """The line's bytes in a code page read as UTF-8; null if it has no such bytes or they are no UTF-8."""
    high = high_characters(page)
    as_latin = F.translate(line, high, "".join(map(chr, range(0x80, 0x100))))
    # A next-line character at the end is let pass, as before a pattern's end.
    alien = rf"{_HIGH}(?<![{_ranges(high)}])(?!(?<=\x{{85}})\z)"
    fits = line.rlike(_sequence(page)) & ~line.rlike(alien)
    return F.when(fits, F.try_validate_utf8(F.encode(as_latin, "ISO-8859-1").cast("string")))


def _better(line: Column) -> Column:
    """The cheapest of the readings of a line and the line itself, which wins ties."""
    readings = F.filter(F.array(*[reading(line, page) for page in CODE_PAGES]), lambda r: r.isNotNull())
    costed = F.transform(readings, lambda r: F.struct(misreading_cost(r).alias("cost"), r.alias("line")))
    cheapest = F.reduce(costed, F.struct(misreading_cost(line).alias("cost"), line.alias("line")),
                        lambda best, r: F.when(r["cost"] < best["cost"], r).otherwise(best))
    return cheapest["line"]


def read_back(text: Column) -> Column:
    """Undo misread UTF-8 line by line, however often it happened.

    A reading takes two characters or more for one, so a line has no more
    readings than its run of such characters can be halved. Once a line is its own
    best reading, the rounds left only pass it on.
    """
    def settled(line: Column) -> Column:
        odd = F.greatest(F.lit(1), F.regexp_count(line, F.lit(_HIGH)))
        rounds = F.sequence(F.lit(1), F.floor(F.log2(odd)).cast("int") + 1)
        start = F.struct(F.lit("").alias("before"), line.alias("now"))

        def read(state: Column, _: Column) -> Column:
            before, now = state["before"], state["now"]
            again = F.struct(now.alias("before"), F.when(may_be_misread(now), _better(now)).otherwise(now).alias("now"))
            return F.when(before == now, state).otherwise(again)

        return F.aggregate(rounds, start, read, lambda state: state["now"])

    lines = F.transform(F.split(text, "\n", -1), lambda line: F.when(
        may_be_misread(line), settled(line)).otherwise(line))
    return F.when(may_be_misread(text), F.array_join(lines, "\n")).otherwise(text)
