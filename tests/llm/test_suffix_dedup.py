import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hardwood.llm import suffix_dedup as op

from cases import EDGES, FOLDER


def brute(texts, least):
    """Per text: bytes, removed bytes, removed runs, and what remains."""
    data = [(t or "").encode() for t in texts]
    starts = defaultdict(list)
    for d, text in enumerate(data):
        for i in range(len(text) - least + 1):
            starts[text[i : i + least]].append((d, i))
    covered = [np.zeros(len(t) + 1, dtype=np.int64) for t in data]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                covered[d][i] += 1
                covered[d][i + least] -= 1
    out = []
    for text, edges in zip(data, covered):
        gone = np.cumsum(edges)[:-1] > 0
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(text), int(gone.sum()), runs, bytes(np.frombuffer(text, dtype=np.uint8)[~gone])))
    return out


def found(df, **options):
    rows = op.without_repeats(df, **options).select("doc.doc_id", "doc.text", "n_bytes", "spans", "kept").collect()
    return [(r["doc_id"], r["text"], (r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), bytes(r["kept"]))) for r in rows]


def check(make, texts, **options):
    want = dict(enumerate(brute(texts, options.get("least", op.LEAST))))
    got = found(make(list(enumerate(texts))), **options)
    assert len(got) == len(texts)
    for doc_id, _, row in got:
        assert row == want[doc_id], (doc_id, row, want[doc_id])


def corpus(seed, n=60, passages=6, words=40):
    """Texts with passages in common, cut at any byte, and with periodic stretches."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    shared = [" ".join(rng.choices(vocabulary, k=rng.randint(4, 30))) for _ in range(passages)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, words)))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(shared)
            cut = sorted(rng.sample(range(len(passage) + 1), 2))
            parts += [passage[cut[0] : cut[1]], " ".join(rng.choices(vocabulary, k=rng.randint(0, 9)))]
        if rng.random() < 0.15:
            parts.append(rng.choice(["ab", "-", "line of text\n"]) * rng.randint(5, 60))
        texts.append("".join(parts))
    return texts + [texts[0], texts[1], texts[1], "", None]


@pytest.mark.parametrize("least", [16, 21, 48])
def test_any_overlap(make, least):
    check(make, corpus(least), least=least)


def test_ranges_runs_and_copies_in_many_tasks(make, monkeypatch):
    for name, value in {"RANGE": 40, "RUN_BYTES": 2_000, "RANGES": 5}.items():
        monkeypatch.setattr(op, name, value)
    check(make, corpus(7, n=120), least=20)


def test_beyond_broadcast(make, low_limits):
    check(make, corpus(11, n=40), least=20, hot=6)


@pytest.mark.parametrize("hot", [0, 4])
def test_hot_beginnings_go_by_digests(make, hot):
    check(make, corpus(9, n=80, passages=2), least=20, hot=hot)


def test_edges(edges):
    want = defaultdict(list)
    for (doc_id, text, *_), row in zip(EDGES, brute([e[1] for e in EDGES], op.LEAST)):
        want[doc_id, text].append(row)
    got = found(edges)
    assert len(got) == len(EDGES)
    for doc_id, text, row in got:
        assert row == want[doc_id, text][0]


def test_empty(nothing):
    assert found(nothing) == []


def test_short_passages_are_refused(edges):
    with pytest.raises(ValueError):
        op.without_repeats(edges, least=15)


def test_chunks_pick_the_same_positions():
    shape = op.Shape.of(40)
    rng = np.random.default_rng(2)
    data = rng.integers(97, 100, 5_000).astype(np.uint8)
    offsets = np.array([0, 10, 10, 700, 4_000, 4_039, 5_000])
    whole = op.picked(data, offsets, shape)
    assert (op.picked(data, offsets, shape, chunk_bits=8) == whole).all()
    # Each stretch of a text holds a position among its first ones.
    for text in range(len(offsets) - 1):
        for start in range(offsets[text], offsets[text + 1] - shape.least + 1):
            assert ((whole >= start) & (whole < start + shape.window)).any()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text("ab", max_size=12).map(str.encode), max_size=8), min_size=1, max_size=6))
def test_loser_tree_merges_and_knows_prefixes(runs):
    coded = []
    for run in runs:
        run = sorted(run)
        coded.append([(s, op.common_prefix(run[i - 1], s) if i else 0, None) for i, s in enumerate(run)])
    merged = list(op.LoserTree(coded))
    strings = [s for s, _, _ in merged]
    assert strings == sorted(s for run in runs for s in run)
    for i in range(1, len(merged)):
        assert merged[i][1] == op.common_prefix(strings[i - 1], strings[i])


@given(st.binary(max_size=150), st.binary(max_size=150), st.binary(max_size=150))
def test_common_prefix(head, a, b):
    plain = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert op.common_prefix(head + a, head + b) == len(head) + plain
    assert op.common_prefix(head + a, head + b, len(head)) == len(head) + plain


def test_query(spark, documents):
    ids = list(documents)
    want = dict(zip(ids, brute([documents[d]["text"] for d in ids], 400)))
    rows = op.op13_suffix_dedup(spark, FOLDER).collect()
    assert len(rows) == len(ids)
    for r in rows:
        n, gone, runs, kept = want[r["doc_id"]]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (n, gone, runs, hashlib.sha256(kept).hexdigest())
