import math
import random

import numpy as np
import pandas as pd
import pytest
from cases import EDGES, FOLDER
from pyspark.sql import functions as F

from hardwood.llm import near_dedup as op
from hardwood.llm.components import components


def shingles(text, words):
    w = (text or "").encode().lower().split()
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(*[w[i:] for i in range(words)]))


def classes(texts, words, percent):
    """Component of every position, by comparing all pairs."""
    sets = [shingles(t, words) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def check(found, rows, words, percent):
    roots, sizes = classes([t for _, t, *_ in rows], words, percent)
    least = {}
    for (doc_id, *_), root in zip(rows, roots):
        least.setdefault(root, []).append(doc_id)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    want = sorted(str((doc_id, size, least[root])) for (doc_id, *_), root, size in zip(rows, roots, sizes))
    found = found.collect()
    assert sorted(str((r["id"], r["size"], r["component_id"])) for r in found) == want
    assert sum(r["kept"] for r in found) == len(set(roots))
    assert all(r["id"] == r["component_id"] for r in found if r["kept"])


def test_query(spark, documents):
    rows = sorted((d, r["text"]) for d, r in documents.items())
    found = op.op6_near_dedup(spark, FOLDER).select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("size"), "component_id", "kept")
    check(found, rows, 3, 85)


def test_edges(edges):
    check(op.near_duplicates(edges, op.Near(3, 85)), EDGES, 3, 85)


def test_empty(nothing):
    assert op.near_duplicates(nothing).count() == 0
    assert op.one_of_each(nothing).columns == nothing.columns


def edited(words, share, rng):
    return [f"e{rng.random()}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def crowd():
    """A hub with many variants, chains of edits, a passage that many documents share, and exact copies."""
    rng = random.Random(5)
    fresh = lambda n: [f"v{rng.randrange(10**9)}" for _ in range(n)]
    hub = fresh(150)
    texts = [edited(hub, rng.choice([0.01, 0.02, 0.03, 0.05]), rng) for _ in range(60)] + [hub]
    passage = fresh(40)
    texts += [passage + fresh(rng.randrange(1, 60)) for _ in range(60)]
    chain = fresh(100)
    for _ in range(25):
        chain = edited(chain, 0.02, rng)
        texts.append(chain)
    texts += [passage[:20] + passage for _ in range(5)]
    rng.shuffle(texts)
    return [(i * 3 + 1, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("limit, block, words, percent", [(64, 512, 3, 85), (6, 512, 5, 80), (2, 16, 3, 85)])
def test_long_lists_lose_no_link(make, crowd, monkeypatch, limit, block, words, percent):
    """With short lists nearly everything goes by large groups, and with small blocks these are cut."""
    monkeypatch.setattr(op, "LIST", limit)
    monkeypatch.setattr(op, "BLOCK", block)
    check(op.near_duplicates(make(crowd), op.Near(words, percent)), crowd, words, percent)


def test_a_thousand_pairs_of_common_text_at_the_limit(make):
    """Each word is in more sets than a list may hold, so only bands can find the pairs, which are at 0.80 exactly."""
    rng = random.Random(23)
    pool = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(1_000):
        words = rng.sample(pool, 100)
        for j, own in enumerate((words[80:90], words[90:])):
            text = words[:80] + own
            rng.shuffle(text)
            rows.append((2 * i + j, " ".join(text)))
    found = {r["id"]: r["component_id"] for r in op.near_duplicates(make(rows), op.Near(1, 80)).select("id", "component_id").collect()}
    assert found == {d: d - d % 2 for d, _ in rows}


@pytest.mark.parametrize("percent", [80, 85])
def test_enough(percent):
    """The chance that all of so many values are in one set only is below the limit, and that of one less is not."""
    alone = 1 - percent / 100
    for n in (1, 5, 12, 64):
        tail = lambda k: sum(math.comb(n, i) * alone**i * (1 - alone) ** (n - i) for i in range(k, n + 1))
        least = op.enough(n, percent)
        assert tail(least) <= op.MISSED < tail(least - 1)


def test_forest_joins_what_links():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 10**9, 100)
    sets = [np.unique(np.r_[base[: 100 - k], rng.integers(10**9, 2 * 10**9, k)]) for k in rng.integers(0, 30, 40)]
    for sides in (np.zeros(40, dtype=int), np.arange(40) % 2):
        links = op.forest(pd.DataFrame({"rep": range(40), "side": sides, "shingles": sets}), 80)
        want, have = list(range(40)), list(range(40))

        def join(parent, a, b):
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            parent[max(a, b)] = min(a, b)

        for i in range(40):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common) and (sides.max() == 0 or sides[i] != sides[j]):
                    join(want, i, j)
        for a, b in links.itertuples(index=False):
            join(have, a, b)

        def roots(parent):
            def find(x):
                return x if parent[x] == x else find(parent[x])

            return [find(i) for i in range(40)]

        assert roots(have) == roots(want) and len(links) < 40


def test_one_of_each_keeps_columns(make, crowd):
    docs = make(crowd)
    kept = op.one_of_each(docs)
    assert kept.columns == docs.columns
    roots, _ = classes([t for _, t in crowd], 5, 80)
    assert {r["doc_id"] for r in kept.collect()} == {crowd[i][0] for i in set(roots)}


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(300, 300 + i) for i in range(1, 90)] + [(500 + i, 501 + i) for i in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: find(n) for n in list(parent) if find(n) != n}


def test_shingle_hashes_depend_on_order_and_length():
    sets = [op.shingle_set(t, 3, {}) for t in (b"a b c", b"c b a", b"a b", b"a", b"A B C")]
    assert len({s.tobytes() for s in sets}) == 4
    assert np.array_equal(sets[0], sets[4])


@pytest.mark.parametrize("common, rare, own, other", [(10, 2, 2, 3), (54, 10, 11, 12)])
def test_short_texts_of_common_words_link(make, common, rare, own, other):
    """A whole set, with all its rare values beyond the end of its partner's list, in the first and in the second round."""
    value = {w: int(op.shingle_set(w.encode(), 1, {})[0]) for w in (f"w{i}" for i in range(common + rare + own))}
    words = sorted(value, key=value.get)
    shared, partners, last = words[:common], words[common : common + own], words[common + own :]
    beyond = (w for w in (f"x{i}" for i in range(10**6)) if op.shingle_set(w.encode(), 1, {})[0] > value[shared[-1]])
    texts = [shared + last, shared + last + partners] + [shared + [next(beyond) for _ in range(other)] for _ in range(op.LIST + 10)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert classes([t for _, t in rows], 1, 85)[0][:3] == [0, 0, 2]
    check(op.near_duplicates(make(rows), op.Near(1, 85)), rows, 1, 85)
