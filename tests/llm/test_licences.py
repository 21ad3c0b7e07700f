import re

import pytest
from cases import EDGES, FOLDER

from hardwood.llm import licences as op

TEMPLATES = op.Templates(op.TEMPLATES, op.LEAST)


def brute(text):
    """Every passage against every template, without bounds."""
    known = [(op.bigrams(op.normalised(t)), n) for n, versions in op.TEMPLATES.items() for t in versions]
    found = []
    for at, passage in op._passages(text):
        grams = op.bigrams(op.normalised(passage))
        scores = [(2 * len(grams & k) / (len(grams) + len(k)), n) for k, n in known]
        scores = sorted((s for s in scores if s[0] >= op.LEAST), key=lambda s: (-s[0], s[1]))
        if scores:
            start = at + len(passage) - len(passage.lstrip())
            found.append((scores[0][0], start, at + len(passage.rstrip()), scores[0][1]))
    found.sort(key=lambda f: (-f[0], f[2] - f[1], f[1], f[3]))
    kept = []
    for score, start, end, name in found:
        if not any(n == name and s < end and start < e for s, e, n, _ in kept):
            kept.append((start, end, name, score))
    return sorted(kept)


TEXTS = [
    "Copyright (c) 2020 Somebody\n\n" + op.PERMISSION.replace("Software", "software").replace(" the ", "\nthe ") + "\n\n" + op.AS_IS,
    "some words. Released under the MIT License.\nmore words",
    "one line. This work is licensed under the GNU General Public License, version 3. And more.",
    "Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.",
    "/* Licensed under the Apache License, Version 2.0 */",
    "The licence of the house of the people is not one of these",
    op.ENDORSEMENT,
    "copyright x\nSPDX-License-Identifier: MIT",
]


@pytest.mark.parametrize("text", TEXTS)
def test_bounds_lose_nothing(text):
    assert op.licences(text, TEMPLATES) == brute(text)


def test_names():
    names = [[n for _, _, n, _ in op.licences(t, TEMPLATES)] for t in TEXTS]
    assert names[:6] == [["MIT"], ["MIT"], ["GPL-3.0"], ["CC-BY-NC-4.0", "CC-BY-4.0"], ["Apache-2.0"], []]


def test_places_are_code_points():
    text = "é😀 text\n  Released under the MIT License.  \nend"
    (start, end, name, score), = op.licences(text, TEMPLATES)
    assert (text[start:end], name, score) == ("Released under the MIT License.", "MIT", 1.0)


def test_query(spark, documents):
    rows = op.op3_licence_scan(spark, FOLDER).collect()
    assert len(rows) == len(documents)
    some = 0
    for r in rows:
        want = brute(documents[r["doc_id"]]["text"] or "")
        assert r["n_licences"] == len(want)
        assert [s.rsplit(":", 1)[0] for s in r["spans"].split(",") if s] == [f"{n}:{s}:{e}" for s, e, n, _ in want]
        some += bool(want)
    planted = [d for d, r in documents.items() if re.search(r"licen[sc]ed under|released under the", r["text"], re.I)]
    assert some >= len(planted) > 0


def test_edges(edges):
    assert op.licence_scan(edges).where("size(licences) > 0").count() == 0
    assert op.licence_scan(edges).count() == len(EDGES)


def test_empty(nothing):
    assert op.licence_scan(nothing).count() == 0


BSD = {
    "BSD-2-Clause": [op.REDISTRIBUTION],
    "BSD-3-Clause": [op.REDISTRIBUTION, op.ENDORSEMENT],
}
FILLER = " ".join(f"word{i} of the plain{i % 7}" for i in range(60))


def licence_file(parts):
    """Numbered conditions and the disclaimer, separated by blank lines."""
    text = " ".join(parts)
    for number, begin in enumerate(["Redistributions of source", "Redistributions in binary", "Neither the name"], 1):
        text = text.replace(begin, f"\n\n{number}. {begin}")
    return "Copyright (c) 2001, Somebody\n\n" + text + "\n\n" + op.BSD_AS_IS


GPL = op.TEMPLATES["GPL-3.0"][0].replace(" This program is", "\n\nThis program is").replace(" See the", "\n\nSee the")
PLACED = [
    ("GPL-3.0", GPL + "\n\n" + FILLER),
    ("GPL-3.0", FILLER + "\n\n" + GPL + "\n\n" + FILLER),
    ("GPL-3.0", FILLER + " " + op.TEMPLATES["GPL-3.0"][0] + " " + FILLER),
    *[(name, licence_file(parts)) for name, parts in BSD.items()],
    *[(name, FILLER + "\n\n" + licence_file(parts) + "\n\n" + FILLER) for name, parts in BSD.items()],
]


@pytest.mark.parametrize("name, text", PLACED)
def test_notices_within_longer_texts(name, text):
    """The likest of all runs of words, by trying each."""
    words = op.normalised(text)
    best = 0.0
    for known in (op.bigrams(op.normalised(t)) for t in op.TEMPLATES[name]):
        for start in range(len(words) - 1):
            seen, common = set(), 0
            for pair in list(zip(words[start:], words[start + 1 :]))[: len(known) * 3 // 2]:
                common += pair in known and pair not in seen
                seen.add(pair)
                if len(known) >= op.NOTICE:
                    best = max(best, 2 * common / (len(seen) + len(known)))
    found = op.licences(text, TEMPLATES)
    assert [n for _, _, n, _ in found] == [name]
    assert found[0][3] == pytest.approx(best) and best > 0.9
    assert op.licences(text, TEMPLATES) == brute(text)


def test_one_line_references_keep_their_version():
    assert op.licences("Licensed under the Apache License, Version 1.1, as it was. " + FILLER, TEMPLATES) == []
