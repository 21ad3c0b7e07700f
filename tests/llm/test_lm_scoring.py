import math
from collections import Counter

import numpy as np
import pytest
from cases import EDGES, FOLDER
from hypothesis import given
from hypothesis import strategies as st

from hardwood.llm import lm_scoring as op


def by_hand(rows, target, word_least=2, pair_least=2):
    """Losses from dictionaries of words and pairs; ``rows`` are (id, text)."""
    texts = [(d in target and d is not None, (t or "").encode().lower().split()) for d, t in rows]
    words, pairs = {c: Counter() for c in "nt"}, {c: Counter() for c in "nt"}
    lead = Counter()
    for inside, line in texts:
        for c in "nt" if inside else "n":
            words[c].update(line)
            pairs[c].update(zip(["<s>", *line], line))
            lead[c] += bool(line)
    total = {c: sum(words[c].values()) for c in "nt"}
    vocabulary = {w for w, k in words["n"].items() if k >= word_least}
    small = min(total.values())
    scale = {c: min(1.0, small / max(total[c], 1)) if small else 1.0 for c in total}
    rest = {c: total[c] - sum(words[c][w] for w in vocabulary) for c in total}

    def p(c, v, w):
        have = words[c][w] if w in vocabulary else rest[c]
        one = (have * scale[c] + 1) / (total[c] * scale[c] + len(vocabulary) + 1)
        if pairs["n"][v, w] < pair_least or w not in vocabulary or v != "<s>" and v not in vocabulary:
            return one
        before = (lead[c] if v == "<s>" else words[c][v]) * scale[c]
        share = min(1.0, pairs[c][v, w] * scale[c] / max(before, 1e-12))
        return op.PAIRS_WEIGHT * share + (1 - op.PAIRS_WEIGHT) * one

    return [
        (len(line), *[-sum(math.log(p(c, v, w)) for v, w in zip(["<s>", *line], line)) / max(len(line), 1) for c in "tn"])
        for _, line in texts
    ]


def check(spark, docs, rows, target, **least):
    ids = spark.createDataFrame([(i,) for i in target], "id long")
    found = op.scored(docs, ids, **least).collect()
    want = by_hand([(d, t) for d, t, *_ in rows], target, **least)
    have = sorted((str(r["id"]), r["n_tokens"], r["ce_target"], r["ce_background"]) for r in found)
    want = sorted((str(d), *w) for (d, *_), w in zip(rows, want))
    assert len(have) == len(want)
    for a, b in zip(have, want):
        assert a[:2] == b[:2]
        assert a[2:] == pytest.approx(b[2:], rel=1e-9, abs=1e-9)


def lines(n=40):
    return [(i, " ".join(f"w{(i * j) % 11}" for j in range(1, 4 + i % 17)) + f" only{i}" * (i % 3)) for i in range(n)]


@pytest.mark.parametrize("least", [(2, 2), (1, 1), (5, 3), (3, 9)])
def test_losses(spark, make, least):
    check(spark, make(lines()), lines(), [i for i in range(40) if i % 3 == 0], word_least=least[0], pair_least=least[1])


@pytest.mark.parametrize("target", [[], [5, 8], [9]])
def test_edges(spark, edges, target):
    check(spark, edges, EDGES, target)


def test_empty(spark, nothing):
    assert op.scored(nothing, spark.createDataFrame([(1,)], "id long")).count() == 0


def test_only_empty_texts(spark, make):
    rows = [(1, None), (2, ""), (3, "  ")]
    check(spark, make(rows), rows, [2])


@pytest.mark.parametrize("range_bytes", [50, 1 << 30])
def test_many_blocks_and_ranges(spark, make, monkeypatch, range_bytes):
    monkeypatch.setattr(op, "HELD_WORDS", 5)
    monkeypatch.setattr(op, "RANGE_BYTES", range_bytes)
    check(spark, make(lines(80)).repartition(6), lines(80), [1, 2, 3, 50])


@given(st.lists(st.integers(0, 2**64 - 1)))
def test_numbers_come_back(numbers):
    assert op.opened(op.squeezed(np.array(numbers, dtype=np.uint64))).tolist() == numbers


def test_target_like_texts_score_lower(spark, make):
    rows = [(i, " ".join(f"{'ab'[i % 2]}{j * i % 7}" for j in range(30))) for i in range(60)]
    found = op.scored(make(rows), spark.createDataFrame([(i,) for i in range(0, 40, 2)], "id long")).collect()
    score = {r["id"]: r["ce_target"] - r["ce_background"] for r in found}
    assert max(score[i] for i in range(40, 60, 2)) < min(score[i] for i in range(41, 60, 2))


def test_query(spark, documents):
    rows = op.op8_lm_scoring(spark, FOLDER).collect()
    assert len(rows) == len(documents)
    for r in rows:
        assert r["n_tokens"] == len(documents[r["doc_id"]]["text"].encode().split())
        assert math.isclose(r["score"], r["ce_target"] - r["ce_background"], abs_tol=1e-12)


def test_what_repeats_is_kept_at_any_size(spark, make):
    """Words and pairs seen twice among 400,000 tokens count."""
    rows = [(i, "common words " * 2_000) for i in range(100)]
    rows += [(200 + i, f"rare{i // 2} pair{i // 2} once{i} rare{i // 2} pair{i // 2}") for i in range(40)] + [(300, None), (301, "")]
    check(spark, make(rows), rows, [0, 200, 201, 230])
