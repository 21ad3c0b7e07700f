import hashlib
import re

import pytest
from cases import EDGES, FOLDER

from hardwood.llm import personal_data as op

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v // 10 + v % 10
    return total % 10 == 0


def fixed(text):
    """(start, kind, end) by the plain patterns."""
    text = text or ""
    bare = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(bare(m)) <= 19 and luhn(bare(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(bare(m)) <= 15]
    return sorted(found)


TRICKY = [
    "a@b a@b.c x.y+z@m-1.co.uk.@q.r a@b@c.d @x.y ..@a.b a@.b c@d..e",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.004 1.2.3 999999.1.1.1 12.34.56.78.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 5500000000000004x 1234567890123456789012 4111  1111",
    "+1 (555) 555-2186 +49.30.1234567 +12 +1(2)3 ++1 555 555 5555 +1234567890123456",
    "é😀a@b.cd 日本 +1 555 555 5555, 10.0.0.1; 4111111111111111",
    "a" * 500 + "@" + "b" * 500 + " " + "@" * 50 + "1" * 500 + ".1" * 50,
]


@pytest.mark.parametrize("text", TRICKY)
def test_fixed_kinds(text):
    assert op.fixed_spans(text) == fixed(text)


def test_long_runs_are_linear():
    for text in ("a" * 300_000 + "@", "1" * 300_000 + ".", "1." * 150_000, "@" * 300_000, "a1" * 300_000):
        assert op.mentions(text) is not None


def test_query(spark, documents):
    rows = op.op4_personal_data(spark, FOLDER).collect()
    assert len(rows) == len(documents)
    for r in rows:
        want = fixed(documents[r["doc_id"]]["text"])
        written = ",".join(f"{op.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in op.KINDS] == [sum(x == i for _, x, _ in want) for i in range(4)]
        assert set(filter(None, written.split(","))) <= set(r["spans"].split(","))


def test_edges(edges):
    found = op.personal_data(edges).select("doc.doc_id", "spans").collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(d) for d, *_ in EDGES)
    assert all(r["spans"] == [] for r in found)


def test_empty(nothing):
    assert op.personal_data(nothing).count() == 0


CORPUS = (
    [(i, f"Please write to me under mailbox: user{i}@mail.example.org as soon as you can") for i in range(6)]
    + [(10 + i, f"the usual place of address {i}.{i}.{i}.{i} and the rest of the text, the end") for i in range(6)]
    + [(20, "somebody hid it as mailbox: john77(at)example(dot)org in this text")]
    + [(21, "the 1234567 of the year is no identifier and the 99 neither")]
    + [(30 + i, f"the red house the blue house the green house {i}x") for i in range(10)]
)


def test_patterns_discover_unseen_identifiers(make):
    found = {r["doc_id"]: r["spans"] for r in op.personal_data(make(CORPUS)).select("doc.doc_id", "spans").collect()}
    text = dict(CORPUS)
    learnt = {(d, text[d][s["start"] : s["end"]], op.KINDS[s["kind"]]) for d, spans in found.items() for s in spans if s["learnt"]}
    assert learnt == {(20, "john77(at)example(dot)org", "email")}
    for d, t in CORPUS:
        assert [(s["start"], s["kind"], s["end"]) for s in found[d] if not s["learnt"]] == fixed(t)


def confidence_by_hand(corpus, rounds=op.ROUNDS, support=op.SUPPORT):
    """The graph scores, on Python dictionaries."""
    edges = {}
    for _, t in corpus:
        for _, _, kind, value, one, two in op.mentions(t):
            for p in filter(None, (one, two)):
                edges[p, value, kind] = edges.get((p, value, kind), 0) + 1
    patterns = {p for p, _, _ in edges if sum(q == p and k >= 0 for q, _, k in edges) >= support}
    total = dict.fromkeys(patterns, 0)
    for _, t in corpus:
        words = re.sub("[0-9]", "0", t.lower()).split()
        for i in range(len(words) - 1):
            for p in (words[i], " ".join(words[i - 1 : i + 1]) if i else ""):
                if p in total:
                    total[p] += 1
    seeds = {(v, k): 1.0 for _, v, k in edges if k >= 0}
    score = dict(seeds)
    for _ in range(rounds):
        conf = {}
        for (p, v, _), n in edges.items():
            for k in range(4):
                if p in patterns and (v, k) in score:
                    conf[p, k] = conf.get((p, k), 0) + n * score[v, k] / total[p]
        conf = {key: min(1.0, c) for key, c in conf.items()}
        doubt = {}
        for p, v, kind in edges:
            for k in range(4):
                if kind < 0 and (p, k) in conf:
                    doubt[v, k] = doubt.get((v, k), 1.0) * max(1 - conf[p, k], 1e-9)
        score = dict(seeds)
        for key, d in doubt.items():
            score[key] = max(score.get(key, 0), 1 - d)
    best = {}
    for (p, k), c in conf.items():
        if p not in best or (-c, k) < (-best[p][1], best[p][0]):
            best[p] = (k, c)
    return best


def test_scores_are_those_of_the_graph(make):
    docs = make(CORPUS)
    found = op.confident_patterns(op._scanned(docs, "text"), docs).collect()
    want = confidence_by_hand(CORPUS)
    assert {r["pattern"]: r["kind"] for r in found} == {p: k for p, (k, _) in want.items()}
    for r in found:
        assert abs(r["confidence"] - want[r["pattern"]][1]) < 1e-6


def test_patterns_are_counted_in_slices(make, monkeypatch):
    docs = make(CORPUS)
    whole = {tuple(r) for r in op.confident_patterns(op._scanned(docs, "text"), docs).collect()}
    monkeypatch.setattr(op, "SLICE", 2)
    assert {tuple(r) for r in op.confident_patterns(op._scanned(docs, "text"), docs).collect()} == whole


def learnt(docs):
    rows = op.personal_data(docs).select("doc.doc_id", "spans").collect()
    return sorted((r["doc_id"], s["start"], s["end"], s["value"]) for r in rows for s in r["spans"] if s["learnt"])


def test_keys_glued_to_values_are_patterns(make):
    """Seeds after a key discover the values that no fixed form covers, and other keys discover nothing."""
    seeds = [(i, f"row {i} email=user{'abcdef'[i]}@mail{i}.example end") for i in range(6)]
    seeds += [(10 + i, f'{{"tel":"+49{i}0 123 456 78", "n":"x"}}') for i in range(4)]
    hidden = [(20, "row 20 email=john77(at)mail.example end"), (21, '{"tel":"0049-30-1234567"}'), (22, "row 22 size=john77(at)mail.example"), (23, "see http://a1.example/x email=")]
    assert learnt(make(seeds + hidden)) == [(20, 13, 35, "john77(at)mail.example"), (21, 8, 23, "0049-30-1234567")]


def test_a_key_before_most_other_things_is_no_pattern(make):
    rows = [(i, f"id=user{'abc'[i]}@mail.example") for i in range(3)] + [(10 + i, f"id=item{i} id=x{i}") for i in range(9)]
    assert learnt(make(rows)) == []


def test_a_pattern_with_a_third_of_all_instances(make, spark):
    """A hot pattern, and instances met by many patterns, with every join salted."""
    rows = [(i, f"write to u{i}@mail{i % 7}.example now, code k{i}") for i in range(400)] + [(1_000, "write to nobody77 now")]
    for name in ("broadcastRows", "blockRows"):
        spark.conf.set(f"spark.hardwood.{name}", "5")
    try:
        assert learnt(make(rows)) == [(1_000, 9, 17, "nobody77")]
    finally:
        for name in ("broadcastRows", "blockRows"):
            spark.conf.unset(f"spark.hardwood.{name}")
