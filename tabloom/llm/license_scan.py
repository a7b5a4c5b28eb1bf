"""License scans: winnowed fingerprints in an inverted index, then banded alignment.

Texts and templates are words. Of a template's hashed word k-grams the least of every window is a fingerprint; the
index has the templates and places of each. All k-grams of a document are looked up, so every stretch of a template
that is at least a window long is met. Hits near one diagonal are one candidate, and a banded local alignment of the
template with the text about it gives the part of the template that is matched and the matched span.

Defined cases: a null or empty text has no matches and so no rows; null doc_ids pass through; repeated rows each return
their rows; several matches of a license in a text are a row each; an empty table gives an empty result; other columns
are ignored; texts of any length are scanned whole. Spans count code points, the end is exclusive. Of templates that match
one place equally well the shorter one is reported, then the first by name.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabloom.llm.common import batch_of, slices, texts_of

GRAM, WINDOW, BAND = 3, 3, 8
LEAST_COVERAGE, LEAST_TEXT_COVERAGE = 0.8, 0.4  # of notices, headers and tags; of license texts
LONG, LEAST_HITS = 100, 5  # templates with more words are aligned if so many hundredths of their fingerprints are hit
MATCH, MISMATCH, GAP = 2, -1, -1
WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")

MIT_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT
OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above copyright notice,
this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution.
"""
BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.
"""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN
CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS
SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
# notices and the words of each that name the license and its version
NOTICES = {
    f"{name} notice{kind}": (form, words)
    for kind, name, form, words in [
        ("", "BSD", "Released under the BSD License", "bsd"),
        ("", "BSD-2-Clause", "Released under the BSD 2-Clause License", "bsd 2-clause"),
        ("", "BSD-3-Clause", "Released under the BSD 3-Clause License", "bsd 3-clause"),
        ("", "ISC", "Released under the ISC License", "isc"),
        (" 2", "MIT", "Licensed under the MIT License", "mit"),
        (" 2", "BSD", "Licensed under the BSD License", "bsd"),
        (" 2", "BSD-2-Clause", "Licensed under the BSD 2-Clause License", "bsd 2-clause"),
        (" 2", "BSD-3-Clause", "Licensed under the BSD 3-Clause License", "bsd 3-clause"),
        (" 2", "ISC", "Licensed under the ISC License", "isc"),
        ("", "Apache-1.1", "Licensed under the Apache License, Version 1.1", "apache 1.1"),
        (" 2", "Apache-2.0", "Released under the Apache License 2.0", "apache 2.0"),
        ("", "MPL-2.0", "Licensed under the Mozilla Public License, version 2.0", "mozilla 2.0"),
        ("", "GPL-2.0", "This work is licensed under the GNU General Public License, version 2", "general public 2"),
        ("", "LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1", "lesser 2.1"),
        ("", "LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3", "lesser 3"),
        ("", "AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3", "affero 3"),
        *[("", f"CC-{kind.upper()}-{version}", f"Licensed under CC {kind.upper()} {version}", f"{kind} {version}")
          for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd") for version in ("3.0", "4.0")
          if (kind, version) != ("by-nc", "4.0")],
        *[(" 2", f"CC-{kind.upper()}-{version}",
           f"This work is licensed under a Creative Commons {long} {version} International License", f"{key} {version}")
          for kind, long, key in (
              ("by", "Attribution", "attribution"), ("by-sa", "Attribution-ShareAlike", "attribution-sharealike"),
              ("by-nd", "Attribution-NoDerivatives", "attribution-noderivatives"),
              ("by-nc", "Attribution-NonCommercial", "attribution-noncommercial"),
              ("by-nc-sa", "Attribution-NonCommercial-ShareAlike", "attribution-noncommercial-sharealike"),
              ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives", "attribution-noncommercial-noderivatives"),
          ) for version in ("4.0",)],
    ]
}
GNU = [("GPL-2.0", "", "gpl", "2"), ("GPL-3.0", "", "gpl", "3"), ("LGPL-2.1", "Lesser ", "lgpl", "2.1"),
       ("LGPL-3.0", "Lesser ", "lgpl", "3"), ("AGPL-3.0", "Affero ", "agpl", "3")]
for _name, _kind, _short, _version in GNU:
    for _k, _verb in enumerate(("Licensed", "Released"), start=3):
        _words = f"{_kind.strip().lower() or 'general'} public {_version}" if _kind else f"general public {_version}"
        NOTICES[f"{_name} notice {_k}"] = (f"{_verb} under the GNU {_kind}General Public License version {_version}", _words)
        NOTICES[f"{_name} notice {_k + 2}"] = (f"{_verb} under the {_short.upper()} version {_version}", f"{_short} {_version}")
        NOTICES[f"{_name} notice {_k + 4}"] = (f"{_verb} under {_short.upper()} version {_version}", f"{_short} {_version}")
for _kind, _long in [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                     ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                     ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]:
    NOTICES[f"CC-{_kind}-4.0 notice 3"] = (f"Creative Commons {_long} 4.0 International", f"{_long.lower()} 4.0")
GNU_HEADERS = {"GPL-2.0": "general public 2", "LGPL-2.1": "lesser 2.1", "LGPL-3.0": "lesser 3", "AGPL-3.0": "affero 3"}
WHOLE = "Apache-2.0 Artistic GPL-1 GPL-2 GPL-3 LGPL-2 LGPL-2.1 LGPL-3 MPL-1.1 MPL-2.0 CC0-1.0 GFDL-1.2 GFDL-1.3".split()


VERSIONS = "1 1.1 1.2 1.3 2 2.1 3 4".split()


def spellings() -> dict[str, list[str]]:
    """Words that stand for others: "v3.0" and "3.0" for version numbers, "gplv3", the word that begins a license tag."""
    found = {"v": ["version"], "spdx-license-identifier": ["spdx", "license", "identifier"]}
    for version in VERSIONS:
        for number in (version, f"{version}.0") if "." not in version else (version,):
            found[f"v{number}"] = ["version", version]
            if number != version:
                found[number] = [version]
            for name in ("gpl", "lgpl", "agpl"):
                found[f"{name}v{number}"] = [name, "version", version]
    return found


SPELLINGS = spellings()


def split_words(lowered: str) -> tuple[list[str], list[int] | None]:
    """The words of a text, and which run of characters each stands for; None if each stands for its own."""
    words = WORD.findall(lowered)
    if SPELLINGS.keys().isdisjoint(words):
        return words, None
    spelled = [(w, i) for i, word in enumerate(words) for w in SPELLINGS.get(word, (word,))]
    return [w for w, _ in spelled], [i for _, i in spelled]


def license_notices() -> dict[str, str]:
    """Short notices, and the file headers of the GNU licenses and of Mozilla's."""
    found = {name: form for name, (form, _) in NOTICES.items()}
    for name in GNU_HEADERS:
        kind = {"L": "Lesser ", "A": "Affero "}.get(name[0], "")
        found[f"{name} header"] = f"""This program is free software; you can redistribute it and/or modify it under the
terms of the GNU {kind}General Public License as published by the Free Software Foundation; either version
{name.split("-")[1].removesuffix(".0")} of the License, or (at your option) any later version. This program is distributed
in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more details."""
    found["MPL-2.0 header"] = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"""[:-1]
    return found


def whole_texts() -> dict[str, str]:
    """License texts kept beside this module, from the first word to the last."""
    texts = {}
    for name in WHOLE:
        text = (Path(__file__).parent / "licenses" / f"{name}.txt").read_text()
        places = [m.span() for m in WORD.finditer(text.lower())]
        texts[f"{name} text"] = text[places[0][0] : places[-1][1]]
    return texts


# fixed values: notices and license texts as they are commonly given
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3",
    "MIT notice": "Released under the MIT License",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0",
    "Apache-2.0 header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "GPL-3.0 header": """This program is free software: you can redistribute it and/or modify it under the terms of the
GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
"""
    + MIT_DISCLAIMER,
    "MIT-0": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so.
"""
    + MIT_DISCLAIMER,
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
    + ISC_DISCLAIMER,
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted.
"""
    + ISC_DISCLAIMER,
    "BSD-2-Clause": BSD_START + BSD_DISCLAIMER,
    "BSD-3-Clause": BSD_START + BSD_NAMES + BSD_DISCLAIMER,
    "BSD-4-Clause": BSD_START
    + """All advertising materials mentioning features or use of this software must display the following
acknowledgement: This product includes software developed by the organization.
"""
    + BSD_NAMES
    + BSD_DISCLAIMER,
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the
original software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required. Altered source versions must be plainly marked as such, and must not be misrepresented
as being the original software. This notice may not be removed or altered from any source distribution.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom
the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire
statement, including the above license grant, this restriction and the following disclaimer, must be included in all
copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS
PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR
ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author
or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this
dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this
dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under
copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    **license_notices(),
    **whole_texts(),
}
# fixed values: identifiers of licenses whose templates are named otherwise
SPDX = {"GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-3": "LGPL-3.0", "Artistic": "Artistic-1.0"}


def kind_of(template: str) -> tuple[str, str]:
    """(license identifier, kind) of a template by its name: a text, or a notice, a header or a tag."""
    name, _, rest = template.partition(" ")
    return SPDX.get(name, name), rest.split(" ")[0] or "text"


def license_tags() -> dict[str, str]:
    """A tag for each identifier; those of the GNU licenses come with two endings more."""
    names = sorted({kind_of(t)[0] for t in TEMPLATES} - {"BSD"})
    ends = lambda n: ("", "-only", "-or-later") if "GPL" in n or "GFDL" in n else ("",)
    return {f"{n} tag {e}".rstrip(): f"SPDX-License-Identifier: {n}{e}" for n in names for e in ends(n)}


TAGS = license_tags()
TEMPLATES |= TAGS

# words that name a license and its version; the first of each in the template must be matched
REQUIRED = {
    "Apache-2.0 notice": "apache 2.0",
    "GPL-3.0 notice": "general public 3",
    "MIT notice": "mit",
    "CC-BY-NC-4.0 notice": "by-nc 4.0",
    "Apache-2.0 header": "apache 2.0",
    "GPL-3.0 header": "general public 3",
    "MPL-2.0 header": "mozilla 2.0",
    **{name: words for name, (_, words) in NOTICES.items()},
    **{f"{name} header": words for name, words in GNU_HEADERS.items()},
    **{name: f"identifier {tag.split()[1].lower()}" for name, tag in TAGS.items()},
}


@dataclass(frozen=True)
class Match:
    template: str
    coverage: float
    start: int
    end: int


def winnowed(hashes: list[int]) -> dict[int, int]:
    """Place and hash of the least hash of every window, the last of equals; all if there is less than a window."""
    if len(hashes) <= WINDOW:
        return dict(enumerate(hashes))
    chosen = {}
    for first in range(len(hashes) - WINDOW + 1):
        place = min(range(first, first + WINDOW), key=lambda i: (hashes[i], -i))
        chosen[place] = hashes[place]
    return chosen


class LicenseIndex:
    """Template words by number, and template places by fingerprint."""

    def __init__(
        self, templates: dict[str, str], required: dict[str, str] | None = None,
        least_coverage: float = LEAST_COVERAGE, least_text_coverage: float = LEAST_TEXT_COVERAGE,
    ):
        self.names = list(templates)
        self.least = [least_text_coverage if kind_of(n)[1] == "text" else least_coverage for n in self.names]
        self.numbers: dict[str, int] = {}
        self.words = [
            [self.numbers.setdefault(w, len(self.numbers) + 1) for w in split_words(t.lower())[0]]
            for t in templates.values()
        ]
        named = [[self.numbers[w] for w in split_words((required or {}).get(name, ""))[0]] for name in self.names]
        self.required = [sorted(words.index(w) for w in some) for words, some in zip(self.words, named, strict=True)]
        self.base = len(self.numbers) + 1
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.least_hits = []
        for t, words in enumerate(self.words):
            prints = winnowed(self.grams(np.array(words)).tolist())
            for place, gram in prints.items():
                self.places[gram].append((t, place))
            self.least_hits.append(1 if len(words) <= LONG else -(-len(prints) * LEAST_HITS // 100))
        self.fingerprints = np.array(sorted(self.places), np.uint64)

    def grams(self, words: np.ndarray) -> np.ndarray:
        """Scrambled k-grams; words that are in no template (0) make a k-gram that no template has."""
        size = len(words) - GRAM + 1
        if size <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(size, np.uint64)
        for i in range(GRAM):
            total = total * np.uint64(self.base) + words[i : i + size].astype(np.uint64)
        return total * np.uint64(0x9E3779B97F4A7C15)  # odd, so different k-grams stay different

    def hits(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """(text place, template place) of fingerprints in the text by template, in text order."""
        grams = self.grams(words)
        near = np.minimum(np.searchsorted(self.fingerprints, grams), len(self.fingerprints) - 1)
        found = defaultdict(list)
        for at in np.flatnonzero(self.fingerprints[near] == grams).tolist():
            for t, place in self.places[int(grams[at])]:
                found[t].append((at, place))
        return found

    def align(self, t: int, words: np.ndarray, some: list[tuple[int, int]], low: int, high: int) -> tuple[int, int, int]:
        """(matched template words, first, last text word) of the best local alignment with the words from ``low`` to
        ``high``, in a band about the diagonals of the hits. Required words are matched, or there is no alignment."""
        template, required = self.words[t], set(self.required[t])
        until, since = (min(required), max(required)) if required else (len(template), 0)
        diagonals = [at - place for at, place in some]
        start = min(diagonals) - BAND
        width = max(diagonals) + BAND + 1 - start
        text = np.full(len(template) + width, -1, np.int64)  # the word at place x of the text is at x - start
        a, b = max(low, start), min(high, start + len(text))
        text[a - start : b - start] = words[a:b]
        # a cell is the score, the matched words and the first matched place + 1, packed so that the largest is the best
        one = np.int64(1) << 48
        ramp = np.arange(width, dtype=np.int64) * one
        before = np.zeros(width, np.int64)
        best, best_last = np.int64(0), -1
        for i, word in enumerate(template):
            same = text[i : i + width] == word
            fresh = np.arange(start + i + 1, start + i + 1 + width) if i <= until else np.int64(0)
            gained = before + MATCH * one + (np.int64(1) << 34)
            matched = np.where(before > 0, gained, gained + fresh if i <= until else 0)
            if i in required:
                now = np.where(same, matched, 0)
            else:
                now = np.where(same, matched, before + MISMATCH * one)
                now[:-1] = np.maximum(now[:-1], before[1:] + GAP * one)  # a template word is left out
            now = np.maximum.accumulate(now - GAP * ramp) + GAP * ramp  # text words are left out
            now[now < one] = 0
            if i >= since and (top := now.max()) >> 48 >= max(best >> 48, 1):
                rows = np.flatnonzero(now >> 48 == top >> 48)
                firsts = now[rows] & ((1 << 34) - 1)
                k = rows[firsts.argmin()]
                if now[k] >> 48 > best >> 48 or firsts.min() < best & ((1 << 34) - 1):
                    best, best_last = now[k], start + i + int(k)
            before = now
        return int(best >> 34) & 0x3FFF, int(best & ((1 << 34) - 1)) - 1, best_last

    def occurrences(self, t: int, words: np.ndarray, some: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
        """(matched words, first, last) of alignments of a template. An alignment ends before its gaps outweigh its
        matches, so it spans less than three templates; a window of hits has room for that from any of its first part."""
        size = len(self.words[t])
        low = begin = 0
        while begin < len(some):
            start = some[begin][0]
            end = bisect_left(some, (start + 4 * size,))
            todo = [(low, min(len(words), start + 5 * size), begin, end)]
            after = start + size
            while todo:
                a, b, i, j = todo.pop()
                inside = some[i:j]
                if len({place for _, place in inside}) < self.least_hits[t] or not inside:
                    continue
                matched, first, last = self.align(t, words, inside, a, b)
                if matched and matched >= self.least[t] * size:
                    yield matched, first, last
                    after, low = max(after, last + 1), max(low, last + 1)
                    todo.append((a, first, i, bisect_left(some, (first - GRAM + 1,), i, j)))
                    todo.append((last + 1, b, bisect_left(some, (last + 1,), i, j), j))
            begin = max(begin + 1, bisect_left(some, (after,)))

    def scan(self, text: str) -> list[Match]:
        lowered = text.lower()
        if len(lowered) != len(text):  # some letters have longer small forms; keep places as they are
            lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        spelled, owners = split_words(lowered)
        words = np.array([self.numbers.get(w, 0) for w in spelled], np.int64)
        found = [
            (matched, matched / len(self.words[t]), self.names[t], first, last)
            for t, some in self.hits(words).items()
            for matched, first, last in self.occurrences(t, words, some)
        ]
        if not found:
            return []
        spans = [m.span() for m in WORD.finditer(lowered)]
        spans = spans if owners is None else [spans[i] for i in owners]
        # of templates that match the same place the one with most matched words stays
        kept: list[tuple[int, int]] = []
        matches = []
        for _, coverage, name, first, last in sorted(found, key=lambda x: (-x[0], -x[1], x[2], x[3])):
            at = bisect_right(kept, (last, len(words)))
            near = kept[max(0, at - 1) : at]
            while near and near[0][1] >= first and not covers(near[0], first, last) and at > 1:
                at -= 1
                near = kept[at - 1 : at]
            if near and covers(near[0], first, last):
                continue
            insort(kept, (first, last))
            matches.append(Match(name, round(coverage, 4), spans[first][0], spans[last][1]))
        return sorted(matches, key=lambda m: (m.start, m.end, m.template))


def covers(kept: tuple[int, int], first: int, last: int) -> bool:
    """Whether more than half of the words from first to last are inside the kept ones."""
    return 2 * (min(kept[1], last) - max(kept[0], first) + 1) > last - first + 1


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("license", pa.string()), ("kind", pa.string()), ("template", pa.string()), ("coverage", pa.float64()), ("span_start", pa.int64()),
     ("span_end", pa.int64())]
)


def find_licenses(
    documents: DataFrame, templates: dict[str, str] | None = None, id_column="doc_id", text_column="text",
    least_coverage: float = LEAST_COVERAGE, least_text_coverage: float = LEAST_TEXT_COVERAGE,
) -> DataFrame:
    """One row per match: doc_id, license (its identifier), kind, template, coverage of the template, span in the text.

    Matches of less than ``least_coverage`` of a notice, header or tag, or ``least_text_coverage`` of a license text, are left out.
    """
    required = REQUIRED if templates is None else None
    index = LicenseIndex(templates or TEMPLATES, required, least_coverage, least_text_coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows = [
                (doc_id, *kind_of(m.template), m.template, m.coverage, m.start, m.end)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                for m in index.scan(text)
            ]
            yield batch_of(RESULT, *(zip(*rows, strict=True) if rows else [[]] * 7))

    schema = "doc_id long, license string, kind string, template string, coverage double, span_start long, span_end long"
    return texts_of(documents, id_column, text_column).mapInArrow(run, schema)
