"""Licence scans: passages compared to licence templates by Dice coefficient over word bigrams.

A text is compared as a whole, by paragraphs, by lines and by sentences, and by windows over its words: for each
template of at least ``NOTICE`` bigrams, the windows of up to its largest possible size that are most like it, wherever
they begin and end. So a notice is found at any place, also over several sentences or paragraphs of a longer text. Shorter
templates are references of one line, where the name or version at the end decides: a window could leave it out, so
these are compared by whole lines and sentences only. Of windows that overlap by half of the shorter, the one with
most of its template counts. Texts are normalised: lower case, words only, lines that state a copyright left out. Two sets of
bigrams are alike if 2 * common / (size + size) reaches ``LEAST``. Sizes alone bound that value, so a
passage meets only the templates of fitting size; and as a match must hold two thirds of a template's
bigrams, one of the rarer third of them must be there, or the passage is not looked at.

Null and empty texts have no passages. Of nested passages that match the same licence, the best counts
(ties: the shorter, then the first). Rows are scanned each, whole, and independently; an empty table gives
an empty result. Other columns are carried along.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm.common import prepared, table, text_of, wrapped

LEAST = 0.8
# Bigrams from which on a template is searched by windows.
NOTICE = 16
PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
)
ENDORSEMENT = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Texts and notices of public licences. Of one licence, every entry is a template of its own.
TEMPLATES = {
    "MIT": (
        PERMISSION + " " + AS_IS,
        PERMISSION,
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD-2-Clause": (
        REDISTRIBUTION + " " + BSD_AS_IS,
        REDISTRIBUTION,
        "Licensed under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        REDISTRIBUTION + " " + ENDORSEMENT + " " + BSD_AS_IS,
        REDISTRIBUTION + " " + ENDORSEMENT,
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "Licensed under the ISC License.",
        "SPDX-License-Identifier: ISC",
    ),
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        'an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
        "Licensed under the Apache License, Version 2.0.",
        "This project is licensed under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.",
        "SPDX-License-Identifier: Unlicense",
    ),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "CC-BY-NC-4.0": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-NC-ND-4.0": ("Licensed under CC BY-NC-ND 4.0.",),
}

WORDS = re.compile(r"[^\W_]+")
COPYRIGHT = re.compile(r"^[^\w\n]*(?:copyright\b|\(c\)|©)[^\n]*$", re.IGNORECASE | re.MULTILINE)
PARAGRAPH = re.compile(r"\n[\x20\t]*\n")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
Bigrams = frozenset[tuple[str, str]]


def normalised(text: str) -> list[str]:
    return WORDS.findall(COPYRIGHT.sub("", text).lower())


def bigrams(words: list[str]) -> Bigrams:
    return frozenset(zip(words, words[1:]))


def dice(a: Bigrams, b: Bigrams) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


class Templates:
    """Templates in order of size, and the bigrams of which every match holds at least one."""

    def __init__(self, texts: dict[str, tuple[str, ...]], least: float) -> None:
        known = [(bigrams(normalised(t)), name) for name, versions in texts.items() for t in versions]
        self.least = least
        self.known = sorted((k for k in known if k[0]), key=lambda k: (len(k[0]), k[1], sorted(k[0])))
        self.sizes = [len(grams) for grams, _ in self.known]
        self.anchors: set[tuple[str, str]] = set()
        # For each anchor, the notices that it may stand in.
        self.notices: dict[tuple[str, str], list[int]] = {}
        for number, (grams, _) in enumerate(self.known):
            needed = math.ceil(least / (2 - least) * len(grams) - 1e-9)
            # Any choice would do; pairs of long words are rare in other texts.
            rare = sorted(grams, key=lambda g: (-len(g[0]) - len(g[1]), g))
            some = rare[: len(grams) - needed + 1]
            self.anchors.update(some)
            for anchor in some if len(grams) >= NOTICE else ():
                self.notices.setdefault(anchor, []).append(number)

    def best(self, words: list[str]) -> tuple[float, str] | None:
        """The best template of a passage; ties by name."""
        pairs = list(zip(words, words[1:]))
        if self.anchors.isdisjoint(pairs):
            return None
        grams = frozenset(pairs)
        small = bisect_left(self.sizes, math.ceil(len(grams) * self.least / (2 - self.least) - 1e-9))
        large = bisect_right(self.sizes, math.floor(len(grams) * (2 - self.least) / self.least + 1e-9))
        found = [(dice(grams, known), name) for known, name in self.known[small:large]]
        found = [f for f in found if f[0] >= self.least]
        return min(found, key=lambda f: (-f[0], f[1])) if found else None


def _cut(text: str, at: int, mark: re.Pattern) -> Iterator[tuple[int, str]]:
    """``(place, part)`` of the parts between marks."""
    start = 0
    for m in mark.finditer(text):
        yield at + start, text[start : m.start()]
        start = m.end()
    yield at + start, text[start:]


@cache
def _standard() -> Templates:
    return Templates(TEMPLATES, LEAST)


def _apart(found: list[tuple], share: float) -> list[tuple]:
    """Of ``(rank, start, end, ...)`` in order, those that no earlier one overlaps by more than ``share`` of the shorter."""
    kept: list[tuple] = []
    for f in found:
        if not any(min(e, f[2]) - max(s, f[1]) > share * min(e - s, f[2] - f[1]) for _, s, e, *_ in kept):
            kept.append(f)
    return kept


def _likest(pairs: list[tuple[str, str]], anchors: list[int], grams: Bigrams, least: float) -> list[tuple]:
    """``((-dice, length), start, end, common)`` of the runs of ``pairs`` most like ``grams``, none overlapping."""
    needed = math.ceil(least / (2 - least) * len(grams) - 1e-9)
    longest = math.floor(len(grams) * (2 - least) / least + 1e-9)
    hits: list[int] = []
    for a in anchors:  # every match holds an anchor
        first = max(a - longest + 1, hits[-1] + 1 if hits else 0)
        hits.extend(k for k in range(first, min(a + longest, len(pairs))) if pairs[k] in grams)
    found = []
    for n, start in enumerate(hits):
        # The likest run begins and ends with bigrams of the template.
        if bisect_left(hits, start + longest) - n < needed:
            continue
        seen: set[tuple[str, str]] = set()
        common, best = 0, None
        for k in range(start, min(start + longest, len(pairs))):
            new = pairs[k] not in seen
            seen.add(pairs[k])
            if pairs[k] in grams:
                common += new
                rank = (-2 * common / (len(seen) + len(grams)), k + 1 - start)
                if common >= needed and -rank[0] >= least and (best is None or rank < best[0]):
                    best = (rank, start, k + 1, common)
        if best:
            found.append(best)
    return _apart(sorted(found), 0.0)


def _windows(text: str, templates: Templates) -> Iterator[tuple[int, str]]:
    """The runs of words most like a notice."""
    places = list(WORDS.finditer(COPYRIGHT.sub(lambda m: " " * len(m.group()), text)))
    words = [m.group().lower() for m in places]
    pairs = list(zip(words, words[1:]))
    anchors: dict[int, list[int]] = {}
    for k, pair in enumerate(pairs):
        for number in templates.notices.get(pair, ()):
            anchors.setdefault(number, []).append(k)
    found = []
    for number, at in anchors.items():
        grams, name = templates.known[number]
        found += [((-common, *rank, name), start, end) for rank, start, end, common in _likest(pairs, at, grams, templates.least)]
    for _, start, end in _apart(sorted(found), 0.5):
        begin = places[start].start()
        yield begin, text[begin : places[end].end()]


def _passages(text: str, templates: Templates | None = None) -> set[tuple[int, str]]:
    """The text, its paragraphs, its lines, sentences within lines and paragraphs, and windows."""
    found = {(0, text), *_windows(text, templates or _standard())}
    for at, paragraph in _cut(text, 0, PARAGRAPH):
        found.add((at, paragraph))
        found.update(_cut(paragraph, at, SENTENCE))
        for begin, line in _cut(paragraph, at, re.compile("\n")):
            found.add((begin, line))
            found.update(_cut(line, begin, SENTENCE))
    return found


def licences(text: str, templates: Templates) -> list[tuple[int, int, str, float]]:
    """``(start, end, name, dice)`` of the passages that match, in order, none within another of the same licence."""
    words = WORDS.findall(text.lower())
    if templates.anchors.isdisjoint(zip(words, words[1:])) and not COPYRIGHT.search(text):
        return []
    found = []
    for at, passage in _passages(text, templates):
        best = templates.best(normalised(passage))
        if best:
            start = at + len(passage) - len(passage.lstrip())
            found.append((best[0], start, max(start, at + len(passage.rstrip())), best[1]))
    found.sort(key=lambda f: (-f[0], f[2] - f[1], f[1], f[3]))
    kept: list[tuple[int, int, str, float]] = []
    for score, start, end, name in found:
        if not any(n == name and s < end and start < e for s, e, n, _ in kept):
            kept.append((start, end, name, score))
    return sorted(kept)


def licence_scan(docs: DataFrame, text_col: str = "text", texts: dict[str, tuple[str, ...]] | None = None, least: float = LEAST) -> DataFrame:
    """All rows as ``doc`` with ``licences``, an array of ``(start, end, name, dice)``; places are code points."""
    prepared(docs.sparkSession)
    given = TEMPLATES if texts is None else texts
    ready: list[Templates] = []

    @F.arrow_udf("array<struct<start: long, end: long, name: string, dice: double>>")
    def scan(texts: pa.Array) -> pa.Array:
        if not ready:
            ready.append(Templates(given, least))
        names = ("start", "end", "name", "dice")
        kind = pa.list_(pa.struct(list(zip(names, (pa.int64(), pa.int64(), pa.string(), pa.float64())))))
        return pa.array([[dict(zip(names, f)) for f in licences(t, ready[0])] for t in texts.to_pylist()], kind)

    return wrapped(docs).withColumn("licences", scan(text_of(f"doc.`{text_col}`")))


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.array_max(F.transform("licences", lambda f: F.struct(f["dice"].alias("dice"), f["name"].alias("name"))))
    written = F.transform("licences", lambda f: F.concat_ws(":", f["name"], f["start"], f["end"], F.round(f["dice"], 4)))
    return found.select(
        "doc.doc_id",
        F.size("licences").cast("long").alias("n_licences"),
        best["name"].alias("licence"),
        best["dice"].alias("dice"),
        F.array_join(written, ",").alias("spans"),
    )


SQL: dict[str, str] = {}
QUERIES = {"op3_licence_scan": op3_licence_scan}
