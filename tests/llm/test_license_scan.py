import random

import numpy as np

from tabloom.llm.license_scan import (
    BAND, GAP, MATCH, MISMATCH, REQUIRED, TEMPLATES, LicenseIndex, find_licenses, kind_of, split_words, winnowed,
)

INDEX = LicenseIndex(TEMPLATES, REQUIRED)


def test_every_template_is_found_in_place():
    for name, template in TEMPLATES.items():
        text = f"Énd of file.\n{template}\n* more words here"
        found = [m for m in INDEX.scan(text) if kind_of(m.template)[0] == kind_of(name)[0]]
        assert [(m.coverage, m.end - m.start) for m in found] == [(1.0, len(template.rstrip(".").rstrip()))]
        assert text[found[0].start : found[0].end] == template.rstrip(".").rstrip()


def test_edited_template_is_found_and_scraps_are_not():
    words = TEMPLATES["MIT"].split()
    for at in (70, 40, 15):
        words[at] = "changed"
    del words[30]
    found = [m for m in INDEX.scan("x " * 500 + " ".join(words)) if m.template == "MIT"]
    assert len(found) == 1 and 0.8 <= found[0].coverage < 1
    assert INDEX.scan("the license of this software is hereby granted") == []
    assert INDEX.scan("licensed under nothing at all") == []


def test_winnowing_takes_one_of_every_window():
    hashes = [random.Random(1).randrange(50) for _ in range(200)]
    places = set(winnowed(hashes))
    assert all(places & set(range(i, i + 3)) for i in range(198))


def test_repeats_and_awkward_table(spark, awkward, no_documents):
    line = "Released under the MIT License."
    rows = [(1, f"{line} filler words between them {line}"), (None, line), (2, None), (3, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["span_start"], r["span_end"]) for r in find_licenses(frame).collect())
    assert got == [("1", 0, 30), ("1", 58, 88), ("None", 0, 30)]
    assert find_licenses(awkward).count() == 0 and find_licenses(no_documents).count() == 0


def licenses(text):
    return [m.template for m in INDEX.scan(text)]


def test_whole_texts_and_the_template_with_most_words():
    assert licenses("x. " + TEMPLATES["BSD-3-Clause"]) == ["BSD-3-Clause"]
    assert licenses("x. " + TEMPLATES["BSD-2-Clause"]) == ["BSD-2-Clause"]
    for name in ("GPL-2 text", "LGPL-2 text", "LGPL-2.1 text", "AGPL-3.0 header", "MPL-2.0 text"):
        assert licenses("x. " + TEMPLATES[name]) == [name]
    assert TEMPLATES["MIT"].endswith("DEALINGS IN THE SOFTWARE.")


def test_names_and_versions_are_matched():
    assert licenses("Released under the BSD License") == ["BSD notice"]
    assert licenses("Licensed under CC BY 4.0") == ["CC-BY-4.0 notice"]
    assert licenses("Licensed under CC BY-SA 4.0") == ["CC-BY-SA-4.0 notice"]
    assert licenses("Licensed under the Apache License, Version 1.1") == ["Apache-1.1 notice"]
    assert licenses("This work is licensed under the GNU General Public License, version 2") == ["GPL-2.0 notice"]
    assert licenses("This work is licensed under the GNU General Public License, version 1") == []
    assert licenses("Released under the Foo License") == []


def test_words_inserted_into_a_long_template():
    words = TEMPLATES["MIT"].split()
    at = len(words) // 2
    for more in (9, 30, 60):
        text = " ".join(["before", *words[:at], *["inserted"] * more, *words[at:], "after", *words])
        found = [m for m in LicenseIndex(TEMPLATES, REQUIRED).scan(text) if m.template == "MIT"]
        assert [m.coverage for m in found] == [1.0, 1.0]


def kinds(text):
    return [kind_of(m.template) for m in INDEX.scan(text)]


def test_tags_and_spellings_of_versions():
    assert kinds("# SPDX-License-Identifier: MIT") == [("MIT", "tag")]
    assert kinds("SPDX-License-Identifier: GPL-3.0-or-later\ncode") == [("GPL-3.0", "tag")]
    assert kinds("SPDX-License-Identifier: Foo-1.0") == []
    assert kinds("Licensed under GPLv3") == [("GPL-3.0", "notice")]
    assert kinds("Licensed under the GPL v2") == [("GPL-2.0", "notice")]
    assert kinds("licensed under the GNU General Public License v3.0") == [("GPL-3.0", "notice")]
    assert kinds("released under the GNU Lesser General Public License v2.1") == [("LGPL-2.1", "notice")]
    assert kinds("Creative Commons Attribution 4.0 International") == [("CC-BY-4.0", "notice")]
    assert kinds("Licensed under the Apache License v2.0") == [("Apache-2.0", "notice")]
    text = "see: Licensed under GPLv3."
    assert [text[m.start : m.end] for m in INDEX.scan(text)] == ["Licensed under GPLv3"]


def test_coverage_of_parts_is_reported(spark):
    words = TEMPLATES["MIT"].split()
    half = " ".join(words[: len(words) // 2 + 4])
    (found,) = INDEX.scan(half)
    assert kind_of(found.template) == ("MIT", "text") and 0.4 < found.coverage < 0.6
    frame = spark.createDataFrame([(1, half)], "doc_id long, text string")
    assert find_licenses(frame, least_text_coverage=0.8).count() == 0
    assert find_licenses(frame).columns[:4] == ["doc_id", "license", "kind", "template"]


def whole_alignment(template, words):
    """(score, matched, first, last) by the whole dynamic program."""
    best, before = (0, 0, 0, -1), [(0, 0, 0)] * (len(words) + 1)
    for word in template:
        now = [(0, 0, 0)]
        for j, other in enumerate(words, start=1):
            options = [(0, 0, 0)]
            score, matched, first = before[j - 1]
            if word == other:
                options.append((score + MATCH, matched + 1, first if score else j))
            else:
                options.append((score + MISMATCH, matched, first))
            options += [(before[j][0] + GAP, *before[j][1:]), (now[j - 1][0] + GAP, *now[j - 1][1:])]
            cell = max(options)
            now.append(cell if cell[0] > 0 else (0, 0, 0))
            if now[j][0] > best[0]:
                best = (*now[j], j - 1)
        before = now
    return best


def test_banded_alignment_equals_the_whole_program():
    rng = random.Random(12)
    for name in ("MIT", "ISC", "BSD-3-Clause", "Zlib"):
        t = INDEX.names.index(name)
        template = split_words(TEMPLATES[name].lower())[0]
        for _ in range(6):
            words = list(template)
            for _ in range(rng.randint(1, BAND)):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = [f"new{rng.randrange(99)}"] * rng.randint(0, 2)
            words = ["before"] * rng.randint(0, 20) + words + ["after"] * 5
            numbers = np.array([INDEX.numbers.get(w, 0) for w in words], np.int64)
            matched, first, last = INDEX.align(t, numbers, INDEX.hits(numbers)[t], 0, len(words))
            score, want, begin, end = whole_alignment(INDEX.words[t], numbers.tolist())
            assert (matched, last) == (want, end) and first <= begin - 1
