"""HTML character references as a native column expression.

The name table comes from Python's standard library when the plan is built
and travels as one literal, so no Python worker is started.
"""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, functions as F

_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_LAST_CODE_POINT = 0x10FFFF


@lru_cache(maxsize=None)
def _names_by_letter() -> tuple[str, str]:
    """Names and their values as JSON arrays, by the code of the first letter."""
    names: list[list[str]] = [[] for _ in range(128)]
    values: list[list[str]] = [[] for _ in range(128)]
    for name, value in html5.items():
        names[ord(name[0])].append(name)
        values[ord(name[0])].append(value)
    return json.dumps(names), json.dumps(values)


@lru_cache(maxsize=None)
def _bare_names_pattern() -> str:
    """Names that count without a semicolon, longest first."""
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return "^(" + "|".join(bare) + ")"


def _c1_readings() -> list[str]:
    """References to 0x80-0x9F are read as Windows-1252, as browsers do."""
    return [bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0)]


def _named(reference: Column) -> Column:
    # Arrays, not maps: equal array literals let Spark see that two uses of a
    # cleaned table are the same work, equal map literals do not.
    names, values = (F.from_json(F.lit(t), "array<array<string>>") for t in _names_by_letter())
    letter = F.ascii(reference) + 1
    place = F.array_position(F.try_element_at(names, letter), reference)
    return F.when(place > 0, F.element_at(F.try_element_at(values, letter), place.cast("int")))


def _numeric(reference: Column) -> Column:
    digits = F.regexp_extract(reference, r"^#[xX]?0*([0-9a-fA-F]*)", 1)
    value = F.when(reference.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
    # More than seven digits is above the last code point in either base.
    code = (
        F.when(F.length(digits) > 7, F.lit(_LAST_CODE_POINT + 1))
        .when(digits == "", F.lit(0))
        .otherwise(value.cast("int"))
    )
    c1 = F.from_json(F.lit(json.dumps(_c1_readings())), "array<string>")
    not_a_character = (
        code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F)
        | (code == 0x7F) | code.between(0xFDD0, 0xFDEF)
        | (code.bitwiseAND(0xFFFE) == 0xFFFE)
    )
    unknown = (code == 0) | (code > _LAST_CODE_POINT) | code.between(0xD800, 0xDFFF)
    return (
        F.when(unknown, F.lit(chr(0xFFFD)))
        .when(not_a_character, F.lit(""))
        .when(code.between(0x80, 0x9F), F.try_element_at(c1, code - 0x7F))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _read_piece(piece: Column) -> Column:
    """The text after one ``&`` with the reference it may start with."""
    return F.struct(
        piece.alias("piece"), F.regexp_extract(piece, _REFERENCE, 1).alias("reference")
    )


def _look_up(read: Column) -> Column:
    reference = read["reference"]
    value = F.when(reference.startswith("#"), _numeric(reference)).otherwise(_named(reference))
    return F.struct(read["piece"].alias("piece"), reference.alias("reference"), value.alias("value"))


def _write_piece(found: Column) -> Column:
    piece, reference = found["piece"], found["reference"]
    bare = F.regexp_extract(reference, _bare_names_pattern(), 1)

    def then_rest(value, used):
        return F.concat(value, F.substr(piece, F.length(used) + 1))

    return F.coalesce(
        then_rest(found["value"], reference),
        then_rest(_named(bare), bare),
        F.concat(F.lit("&"), piece),
    )


def unescape_html(text: Column) -> Column:
    """Replace every character reference once, as HTML5 readers do."""
    pieces = F.split(text, "&", -1)
    tail = F.slice(pieces, 2, F.size(pieces))
    # One transform for each step, so that no step is evaluated twice.
    tail = F.transform(F.transform(F.transform(tail, _read_piece), _look_up), _write_piece)
    return F.concat(F.element_at(pieces, 1), F.array_join(tail, ""))
