import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hardwood.llm import collocations as op

from cases import EDGES, FOLDER

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows):
    """Per language, the counts of all phrases of one to three words."""
    found = {}
    for _, text, lang in rows:
        here = found.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            for size in (1, 2, 3):
                here.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return found


def expected(rows, least=10, top=2000, held=50):
    out = []
    for lang, f in counts(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        scored, most = [], Counter()
        for q, c in f.items():
            if len(q) == 3 and c >= least:
                for p in (q[:2], q[1:]):
                    most[p] = max(most[p], c)
        for p, a in f.items():
            if len(p) == 1 or a < least:
                continue
            if most[p] and 100 * most[p] >= held * a:
                continue
            cuts = [(1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in op.collocations(df, **options).collect())


def three(rows):
    return [(d, t, rest[0] if rest else "en") for d, t, *rest in rows]


def test_edges(edges):
    assert found(edges, least=1) == expected(three(EDGES), least=1)


def test_empty(nothing):
    assert found(nothing) == []


def test_ties_repeats_and_pieces(make):
    rows = [(i, "Red fox, red fox; blue\tsky A b c d e", "en" if i % 2 else None) for i in range(30)]
    rows += [(100 + i, "a b", "en") for i in range(40)] + [(200 + i, "x y z? x y! x", "und") for i in range(11)]
    assert found(make([(*r, "s") for r in rows])) == expected(rows)
    assert found(make([(*r, "s") for r in rows]), top=3, held=100) == expected(rows, top=3, held=100)


def test_hot_nodes_go_by_slots(make):
    # Two words make most tokens, and lead to a hundred others.
    rows = [(i, " . ".join(f"of the w{i % 50} w{(i + j) % 100}" for j in range(12)), "en") for i in range(60)]
    assert found(make([(*r, "s") for r in rows]), least=2) == expected(rows, least=2)


def test_beyond_broadcast(make, low_limits):
    rows = [(i, f"Red fox, red fox w{i % 3} blue sky a b c", "en" if i % 4 else "fr") for i in range(60)]
    assert found(make([(*r, "s") for r in rows]), least=4) == expected(rows, least=4)


def test_tasks_hand_on_early(make, monkeypatch):
    rows = [(i, f"one two three four. two three w{i % 9} one two", "en") for i in range(40)]
    monkeypatch.setattr(op, "HELD_TOKENS", 5)
    monkeypatch.setattr(op, "HELD_WORDS", 3)
    assert found(make([(*r, "s") for r in rows]), least=3) == expected(rows, least=3)


def test_another_seed_where_words_collide(make, monkeypatch):
    whole, seeds = op.dictionary, []

    def colliding(texts, seed):
        seeds.append(seed)
        return whole(texts, seed).withColumn("code", F.lit(7).cast("long")) if seed == 0 else whole(texts, seed)

    rows = [(i, "a b c a b", "en") for i in range(12)]
    monkeypatch.setattr(op, "dictionary", colliding)
    assert found(make([(*r, "s") for r in rows])) == expected(rows)
    assert seeds == [0, 1]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 4)] * 3), min_size=1, max_size=60), st.sampled_from([5, 1 << 30]))
def test_distinct_rows(triples, numbers):
    rows, n = op._distinct(np.array(triples, dtype=np.int64).T, numbers)
    assert Counter(triples) == {tuple(map(int, c)): int(k) for c, k in zip(rows.T, n)}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 2)] * 2, st.integers(1, 5)), max_size=30), st.integers(1, 7))
def test_runs_over_many_batches(rows, size):
    rows = sorted(rows)
    want = Counter()
    for x, y, n in rows:
        want[x, y] += n
    held, got = np.zeros((3, 0), dtype=np.int64), []
    starts = range(0, len(rows) + 1, size)
    for start in starts:
        part = np.array(rows[start : start + size], dtype=np.int64).reshape(-1, 3).T
        keys, n, held = op._runs(held, part[:2], part[2], start == starts[-1])
        got += [(int(x), int(y), int(k)) for x, y, k in zip(*keys, n)]
    assert got == [(x, y, n) for (x, y), n in sorted(want.items())]


@pytest.mark.parametrize("times", [10, 25])
def test_paths_are_whole_passages(make, times):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(i, f"w{i} {passage} v{i}", "en", "s") for i in range(times)] + [(900, "beta gamma. iota", "en", "s")]
    placed = op.compacted_paths(make(rows)).collect()
    # A piece ends at (beta, gamma), so two edges meet there and the passage is two paths.
    by_path = {}
    for r in placed:
        by_path.setdefault(r["path"], []).append(r["place"])
        assert r["n"] == times
    assert sorted(sorted(p) for p in by_path.values()) == [[0], list(range(7))]


def test_query(spark, documents):
    rows = [(d, r["text"], r["lang"]) for d, r in documents.items()]
    assert sorted(tuple(r) for r in op.op11_collocations(spark, FOLDER).collect()) == expected(rows)
