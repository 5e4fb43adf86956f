import random
import re
import time

import pytest
from pyspark.sql import functions as F

import brute
from sozmill.llm import license_notices as notices, licenses


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner(licenses.build_rules(), licenses.BASE)


def labels(scanner, text):
    words = (" " + " ".join(brute.words(text)) + " ").encode()
    return [rule.label for rule, _, _ in scanner.detect(words, scanner.wanted(words))]


@pytest.mark.parametrize("text, found", [
    ("Licensed under CC BY-NC 4.0.", ["cc-by-nc-4.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["gpl-3"]),
    ("Licensed under the Apache License, Version 2.0.", ["apache-2.0"]),
    ("Released under the MIT License.", ["mit"]),
    ("SPDX-License-Identifier: MPL-2.0", ["mpl-2.0"]), ("SPDX-License-Identifier: BSL-1.0", ["bsl-1.0"]),
    ("SPDX-License-Identifier: CC-BY-SA-4.0", ["cc-by-sa-4.0"]), ("SPDX-License-Identifier: AGPL-3.0-or-later", ["agpl-3.0"]),
    ("under the Expat license", ["mit"]), ("CC Zero 1.0 Universal", ["cc0"]),
    ("GNU Lesser General Public License v2.1 or later", ["lgpl-2.1"]),
    ("distributed under the Creative Commons Attribution-ShareAlike 3.0 license", ["cc-by-sa-3.0"]),
    ("the 3-clause BSD license and the ISC license", ["bsd-3-clause", "isc"]),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", ["mit"]),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ["mit-or-apache-2.0"]),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", ["gpl-2.0-with-linux-syscall-note"]),
    ("See https://www.apache.org/licenses/LICENSE-2.0 for it", ["apache-2.0"]),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", ["cc-by-nc-sa-4.0"]),
    ("it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either "
     "version 2.1 of the License, or (at your option) any later version.", ["lgpl-2.1"]),
    ("The origin of this software must not be misrepresented; you must not claim", ["zlib"]),
    ("Neither the name of the University nor the names of its contributors may be used to endorse or promote products",
     ["bsd-3-clause"]),
    ("The Software shall be used for Good, not Evil.", ["json"]), ("Business Source License 1.1", ["busl-1.1"]),
    ("Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", ["bsd"]),
    ("I apache the mit in general", []), ("this is in the public domain of thought", []), ("", []), ("submit licenses", []),
])
def test_rules(scanner, text, found):
    assert labels(scanner, text) == found


def test_there_are_hundreds():
    rules = licenses.build_rules()
    assert len(rules) > 300 and len({r.name for r in rules}) == len(rules)
    for rule in rules:
        re.compile(rule.pattern)
    assert [r.priority for r in rules] == sorted((r.priority for r in rules), reverse=True)


def test_keywords_gate_nothing_that_matches():
    """Each reading of a rule needs its keyword."""
    for _, keyword, names, _ in licenses.FAMILIES:
        assert all(keyword in name.split() for name in names.split("|")), names
    written = [t for name in ("EXPRESSIONS", "NOTICES", "ADDRESSES", "EXCEPTIONS", "PASSAGES") for t in getattr(notices, name)]
    assert len(written) > 140 and len(set(written)) == len(written)
    for _, keyword, words in [*licenses.SENTENCES, *written]:
        needed = re.sub(r"\(\?:[^()]*\)(?:[?*]|\{\d+,\d+\})", "", words)
        readings = re.sub(r"\(\?:[^()]*\)", "", needed)
        assert keyword in readings.split() or all(
            keyword in x.split() for group in re.findall(r"\(\?:([^()]*)\)", needed) for x in group.split("|")), words


def test_containment_and_priority(scanner):
    words = b" licensed under the apache license version 2 0 and the apache license "
    found = scanner.detect(words, scanner.wanted(words))
    assert [(r.label, r.priority, a, b) for r, a, b in found] == [
        ("apache-2.0", licenses.GRANT, 0, 8), ("apache", licenses.LOOSE, 10, 12)]


def test_containment_equals_brute_force():
    rng = random.Random(2)
    for _ in range(2000):
        spans = [(rng.randrange(3), a, a + rng.randrange(1, 6), k)
                 for k, a in enumerate(rng.choices(range(12), k=rng.randrange(14)))]
        taken = []
        for i in sorted(range(len(spans)), key=lambda i: (spans[i][0], spans[i][1] - spans[i][2], spans[i][1], spans[i][3])):
            _, start, stop, _ = spans[i]
            if not any(spans[j][1] <= start and stop <= spans[j][2] for j in taken):
                taken.append(i)
        assert sorted(licenses.uncontained(spans)) == sorted(taken)


def test_a_text_of_many_mentions(scanner):
    n = 100_000
    words = (" " + "licensed under the apache license version 2 0 and mit license " * n).encode()
    begun = time.perf_counter()
    found, places = scanner.detect(words, scanner.wanted(words)), scanner.phrases(words)
    assert time.perf_counter() - begun < 20
    assert len(found) == len(places) == 2 * n
    assert [f[1:] for f in found[:3]] == [(0, 8), (9, 11), (11, 19)] and found[-1][2] == 11 * n
    assert {rule.label for rule, _, _ in found} == {"apache-2.0", "mit"}


def base(text):
    w = brute.words(text)
    return sorted((label, i) for phrase, label in licenses.BASE.items() for i in range(len(w))
                  if w[i:i + len(phrase.split())] == phrase.split())


def test_places_and_odd_rows(documents, odd, session):
    more = session.createDataFrame(
        [(50, "MIT license mit LICENSE; Apache-License general\npublic license", "en", "s", 1)], odd.schema)
    docs = documents.unionByName(odd).unionByName(more).withColumn("places", F.lit("clash"))
    rows = licenses.scan(docs.withColumn("given", F.col("text"))).collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert row.n_words == len(brute.words(row.given))
        assert sorted((p.label, p.start) for p in row.places) == base(row.given)
    assert licenses.scan(odd.limit(0)).count() == 0
