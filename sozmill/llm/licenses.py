"""License scan by ordered signature rules.

Texts are compared as words (A-Z lower-cased, anything else but digits and
characters outside ASCII is a gap). A rule is a regular expression over the
words joined by spaces. It runs only where its keyword occurs. Detections are
taken by priority; one that lies inside a detection taken before is dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import license_notices as notices
from .common import as_bytes, lean, slices, with_fields
from .words import LOWER, find_words

# The phrases that always count, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# License families as (label, keyword, names, versions).
FAMILIES = (
    ("apache", "apache", "apache software|apache", "1.0 1.1 2.0"),
    ("agpl", "affero", "gnu affero general public|affero general public", "1.0 3 3.0"),
    ("agpl", "agpl", "gnu agpl|agpl", "1.0 3 3.0"),
    ("lgpl", "lesser", "gnu lesser general public|lesser general public", "2.1 3 3.0"),
    ("lgpl", "library", "gnu library general public|library general public", "2 2.0"),
    ("lgpl", "lgpl", "gnu lgpl|lgpl", "2 2.0 2.1 3 3.0"),
    ("gpl", "general", "gnu general public|general public", "1 1.0 2 2.0 3 3.0"),
    ("gpl", "gpl", "gnu gpl|gpl", "1 1.0 2 2.0 3 3.0"),
    ("gfdl", "documentation", "gnu free documentation|free documentation", "1.1 1.2 1.3"),
    ("mpl", "mozilla", "mozilla public", "1.0 1.1 2.0"),
    ("mpl", "mpl", "mpl", "1.0 1.1 2.0"),
    ("epl", "eclipse", "eclipse public", "1.0 2.0"),
    ("edl", "eclipse", "eclipse distribution", "1.0"),
    ("cddl", "cddl", "cddl", "1.0 1.1"),
    ("cddl", "development", "common development and distribution", "1.0 1.1"),
    ("cpl", "common", "common public", "1.0"),
    ("ipl", "ibm", "ibm public", "1.0"),
    ("eupl", "eupl", "eupl", "1.0 1.1 1.2"),
    ("eupl", "european", "european union public", "1.0 1.1 1.2"),
    ("osl", "osl", "osl", "1.0 2.0 2.1 3.0"),
    ("osl", "open", "open software", "1.0 2.0 2.1 3.0"),
    ("afl", "academic", "academic free", "1.1 1.2 2.0 2.1 3.0"),
    ("artistic", "artistic", "artistic", "1.0 2.0"),
    ("ofl", "font", "sil open font|open font", "1.0 1.1"),
    ("bsl", "boost", "boost software", "1.0"),
    ("psf", "python", "python software foundation|python", "2 2.0"),
    ("php", "php", "php", "3.0 3.01"),
    ("zpl", "zope", "zope public", "1.1 2.0 2.1"),
    ("lppl", "latex", "latex project public", "1.0 1.1 1.2 1.3"),
    ("ms-pl", "microsoft", "microsoft public", ""),
    ("ms-rl", "microsoft", "microsoft reciprocal", ""),
    ("qpl", "q", "q public", "1.0"),
    ("cecill", "cecill", "cecill", "1.0 2.0 2.1"),
    ("mulan", "mulan", "mulan psl|mulan permissive software", "1 1.0 2 2.0"),
    ("isc", "isc", "isc", ""),
    ("zlib", "zlib", "zlib", ""),
    ("unlicense", "unlicense", "unlicense", ""),
    ("wtfpl", "wtfpl", "wtfpl", ""),
    ("mit", "mit", "mit x11|mit", ""),
    ("mit", "expat", "expat", ""),
    ("x11", "x11", "x11", ""),
    ("ruby", "ruby", "ruby", ""),
    ("w3c", "w3c", "w3c software|w3c", ""),
    ("upl", "universal", "universal permissive", "1.0"),
    ("odbl", "database", "open database", "1.0"),
    ("bsd-2-clause", "bsd", "2 clause bsd|bsd 2 clause|two clause bsd|simplified bsd", ""),
    ("bsd-3-clause", "bsd", "3 clause bsd|bsd 3 clause|three clause bsd|new bsd|revised bsd", ""),
    ("bsd-4-clause", "bsd", "4 clause bsd|bsd 4 clause|original bsd", ""),
    ("bsd", "bsd", "bsd", ""),
)
# Creative Commons terms as (label, words).
CC_TERMS = (
    ("by", "by|attribution"),
    ("by-sa", "by sa|attribution share ?alike"),
    ("by-nd", "by nd|attribution no ?deriv(?:ative)?s"),
    ("by-nc", "by nc|attribution non ?commercial"),
    ("by-nc-sa", "by nc sa|attribution non ?commercial share ?alike"),
    ("by-nc-nd", "by nc nd|attribution non ?commercial no ?deriv(?:ative)?s"),
)
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
# Sentences of license texts as (label, keyword, words).
SENTENCES = (
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public"),
    ("apache", "except", "you may not use this file except in compliance with the license"),
    ("mpl", "subject", "this source code form is subject to the terms of the mozilla public"),
    ("zlib", "warranty", "this software is provided as is without any express or implied warranty"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "public", "do what the fuck you want to public license"),
    ("bsl", "permission", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("cc0", "commons", "creative commons (?:cc0|zero)(?: 1 0| universal)*"),
    ("cc0", "zero", "cc zero(?: 1 0| universal)*"),
    ("cc0", "cc0", "cc0(?: 1 0| universal)*"),
    ("public-domain", "domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "reserved", "all rights reserved"),
)

# Priorities: what names a license exactly comes first. The score goes with it.
EXPRESSION, IDENTIFIER, GRANT, NAMED, SENTENCE, LOOSE = 6, 5, 4, 3, 2, 1
SCORES = {EXPRESSION: 1.0, IDENTIFIER: 1.0, GRANT: 0.95, NAMED: 0.85, SENTENCE: 0.8, LOOSE: 0.6}
BASE_SCORE = 0.5

_GRANT = ("(?:licensed|released|distributed|available|provided|published|covered|offered) "
          "(?:to you )?(?:under|by|with) (?:the )?(?:terms of )?(?:the )?(?:conditions of the )?")
_LICENSE = "(?: public)? licen[sc]e"


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    keyword: str
    priority: int
    pattern: str


def build_rules() -> tuple[Rule, ...]:
    """All rules by priority and then in their order: those of families and versions, and those written one by one."""
    rules = []

    def add(label, keyword, priority, pattern):
        rules.append(Rule(f"r{len(rules):03d}-{label}", label, keyword, priority, pattern))

    for label, keyword, names, versions in FAMILIES:
        name = f"(?:{names})"
        for version in versions.split():
            number = version.replace(".", " ")
            exact = f"{label}-{version}"
            tail = f"(?:{_LICENSE})?(?: version| v)? (?:v)?{number}(?: only| or later| or any later version)?"
            add(exact, keyword, GRANT, _GRANT + name + tail)
            add(exact, keyword, NAMED, name + tail)
        add(label, keyword, GRANT, _GRANT + name + _LICENSE)
        add(label, keyword, LOOSE, name + _LICENSE)
    identifiers = {(label, v) for label, _, _, versions in FAMILIES for v in ["", *versions.split()]}
    identifiers |= {(f"cc-{term}", v) for term, _ in CC_TERMS for v in CC_VERSIONS.split()}
    for label, version in sorted(identifiers, key=lambda x: (x[0], x[1] == "", x[1])):
        words = f"{label} {version}".replace("-", " ").replace(".", " ").strip()
        add(f"{label}-{version}".strip("-"), "spdx", IDENTIFIER,
            f"spdx license identifier {words}(?: only| or later)?")
    for term, words in CC_TERMS:
        for version in CC_VERSIONS.split():
            number = version.replace(".", " ")
            label = f"cc-{term}-{version}"
            body = f"(?:{words})(?: (?:international|unported|generic))?(?:{_LICENSE})?(?: version| v)? {number}"
            for keyword, name in (("cc", "cc"), ("commons", "creative commons")):
                add(label, keyword, GRANT, f"{_GRANT}(?:a )?{name} {body}")
                add(label, keyword, NAMED, f"{name} {body}")
        add(f"cc-{term}", "commons", LOOSE, f"creative commons (?:{words}){_LICENSE}")
    for priority, table in (
            (EXPRESSION, notices.EXPRESSIONS), (GRANT, notices.NOTICES), (NAMED, notices.ADDRESSES),
            (SENTENCE, notices.EXCEPTIONS), (SENTENCE, notices.PASSAGES), (SENTENCE, SENTENCES)):
        for label, keyword, words in table:
            add(label, keyword, priority, words)
    return tuple(sorted(rules, key=lambda r: -r.priority))


class Scanner:
    """The rules, compiled and grouped by keyword."""

    def __init__(self, rules: tuple[Rule, ...], base: dict[str, str]):
        self.by_keyword = defaultdict(list)
        for order, rule in enumerate(rules):
            self.by_keyword[rule.keyword.encode()].append(
                (order, rule, re.compile(f" (?:{rule.pattern})(?= )".encode())))
        self.base = [(re.compile(f"(?= {p} )".encode()), p.encode(), p.split()[-1].encode(), label)
                     for p, label in base.items()]

    def wanted(self, lowered: bytes) -> list[bytes]:
        """Keywords that occur in a lower-cased text; words may go on beyond them."""
        return [k for k in self.by_keyword if k in lowered]

    def detect(self, words: bytes, keywords: list[bytes]) -> list[tuple[Rule, int, int]]:
        """Detections as (rule, first word, word after the last), overlaps resolved."""
        found = []
        for keyword in keywords:
            if b" %b " % keyword not in words:
                continue
            for order, rule, pattern in self.by_keyword[keyword]:
                for match in pattern.finditer(words):
                    found.append((order, match.start(), match.end(), rule))
        kept = uncontained([(-rule.priority, start, stop, order) for order, start, stop, rule in found])
        taken = sorted((found[i] for i in kept), key=lambda x: x[1:3])
        at = word_numbers(words, [x for _, start, stop, _ in taken for x in (start, stop)])
        return [(rule, at[start], at[stop]) for _, start, stop, rule in taken]

    def phrases(self, words: bytes) -> list[tuple[str, int]]:
        """Places of the base phrases: label and first word."""
        found = [(label, match.start()) for pattern, plain, _, label in self.base if b" %b " % plain in words
                 for match in pattern.finditer(words)]
        at = word_numbers(words, [start for _, start in found])
        return [(label, at[start]) for label, start in found]


def uncontained(spans: list[tuple[int, int, int, int]]) -> list[int]:
    """Which of some ``rank, start, stop, order`` lie in no span taken before them.

    Smaller ranks come first, then longer spans, then smaller orders. A span that lies in one that was
    dropped also lies in the one that took its place, so it is enough to look at all spans that come first: of
    smaller rank, by the furthest stop of those that start no later; of equal rank in one sweep.
    """
    by_rank = defaultdict(list)
    for i, (rank, start, stop, order) in enumerate(spans):
        by_rank[rank].append((start, -stop, order, i))
    out, starts, reach = [], [], []  # of smaller ranks: starts in order, furthest stop so far
    for rank in sorted(by_rank):
        own, furthest, left = sorted(by_rank[rank]), -1, []
        for start, stop, _, i in own:
            before = bisect_right(starts, start)
            if furthest < -stop and (not before or reach[before - 1] < -stop):
                left.append((start, -stop))
                out.append(i)
            furthest = max(furthest, -stop)
        both = sorted([*zip(starts, reach), *left])
        starts = [start for start, _ in both]
        reach = list(accumulate((stop for _, stop in both), max))
    return out


def word_numbers(words: bytes, places: list[int]) -> dict[int, int]:
    """Blanks before each of some places, counted in one pass."""
    out, last, number = {}, 0, 0
    for place in sorted(set(places)):
        number += words.count(b" ", last, place)
        out[place], last = number, place
    return out


_DETECTION = "struct<label:string,rule:string,priority:int,start:int,stop:int>"
_PLACE = "struct<label:string,start:int>"


def scan(docs: DataFrame, text: str = "text", base: dict[str, str] = BASE) -> DataFrame:
    """``docs`` without ``text``, with ``n_words``, ``places`` and ``detections``.

    ``places`` are those of the base phrases, ``detections`` those of the rules
    that overlap resolution left. Null is empty: no words, empty lists. Whole
    texts are scanned, row by row, so repeated rows get equal results. Columns
    of these names are replaced.
    """
    docs = docs.drop("n_words", "places", "detections")
    others = [c for c in docs.columns if c != text]
    detection = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.string()), ("priority", pa.int32()),
                                    ("start", pa.int32()), ("stop", pa.int32())]))
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32())]))

    def run(batches):
        scanner = Scanner(build_rules(), base)
        for batch in batches:
            column = as_bytes(batch.column(text))
            counts, places, detections = [], [], []
            for a, b in slices(column):
                part = column.slice(a, b - a)
                counts.extend(find_words(part).counts().tolist())
                for value in part:
                    lowered = value.as_py().translate(LOWER)
                    keywords = scanner.wanted(lowered)
                    phrases = any(last in lowered for _, _, last, _ in scanner.base)
                    words = b" %b " % b" ".join(lowered.split()) if keywords or phrases else b""
                    places.append([{"label": label, "start": i} for label, i in scanner.phrases(words)]
                                  if phrases else [])
                    detections.append([
                        {"label": r.label, "rule": r.name, "priority": r.priority, "start": i, "stop": j}
                        for r, i, j in (scanner.detect(words, keywords) if keywords else ())])
            batch = batch.drop_columns([text])
            batch = batch.append_column("n_words", pa.array(counts, pa.int64()))
            batch = batch.append_column("places", pa.array(places, place))
            yield batch.append_column("detections", pa.array(detections, detection))

    return docs.select(*others, text).mapInArrow(lean(run), with_fields(
        docs.select(*others), f"n_words long, places array<{_PLACE}>, detections array<{_DETECTION}>"))


def strongest() -> F.Column:
    """Score of the surest detection of a scanned row."""
    scores = F.create_map(*[F.lit(x) for pair in SCORES.items() for x in pair])
    best = F.array_max(F.transform("detections", lambda d: scores[d["priority"]]))
    return F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size("places") > 0, BASE_SCORE).otherwise(0.0))
