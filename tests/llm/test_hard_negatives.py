import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hardwood.llm import hard_negatives as op

from cases import FOLDER

SCHEMA = "vec_id long, embedding array<float>, label int, v string, norm string, cluster string, bounds string, id string"


def brute(rows, positives=5, negatives=10, lower=30, upper=90, every=100):
    known = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        known[i] = min(known.get(i, row), row)
    out = []
    for anchor, (label, v) in known.items():
        if anchor % every:
            continue
        score = {i: sum(a * b for a, b in zip(v, w)) for i, (_, w) in known.items() if i != anchor}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if known[i][0] == label][:positives]:
            fits = [i for i in order if known[i][0] != label and lower * score[p] <= 100 * score[i] <= upper * score[p]]
            out += [(anchor, p, rank, i, score[p], score[i]) for rank, i in enumerate(fits[:negatives], 1)]
    return sorted(out)


def found(spark, rows, every=100, **options):
    df = spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = op.integer_vectors(df, "vec_id", label, "embedding")
    return sorted(tuple(r) for r in op.hard_negatives(whole, whole.where(F.col("id") % every == 0), **options).collect())


def cloud(n, seed=3, labels=3, width=8):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(middles)], rng.randrange(labels)) for i in range(n)]


EDGES = [
    (None, [1.0, 2.0], 1), (0, [1.0, 2.0, 0.5], 1), (100, None, 1), (200, [1.0, None], 1), (300, [1.0, float("nan")], 1),
    (400, [float("inf"), 1.0], 1), (500, [1.0, 1.0], None), (600, [], 1), (700, [0.0, 0.0, 0.0], 2), (800, [-1.0, -2.0], 1),
    (900, [0.5], 1), (900, [0.25], 1), (900, [0.25], 1), (1, [1.0, 1.0], 1), (2, [0.5, 0.5, 0.5, 0.5], 2), (3, [0.5, 0.5], 3),
    (5, [0.5, 0.5], 3), (8, [0.25, 0.5], 3), (9, [1.0, 2.0], 1),
]


def test_edges(spark):
    assert found(spark, EDGES) == brute(EDGES)


def test_empty(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 1), (2, [0.5], 2)]) == []


@pytest.mark.parametrize("copies", [0, 200])
def test_levels_blocks_and_clusters(spark, monkeypatch, copies):
    # Lists of several levels, blocks of few rows and members, a vector with many copies.
    for name, value in {"FIRST_LEVEL": 40, "BLOCK_ROWS": 30, "BLOCK_ANCHORS": 8}.items():
        monkeypatch.setattr(op, name, value)
    rows = cloud(400) + [(1000 + i, [0.3] * 8, i % 2) for i in range(copies)]
    assert found(spark, rows, every=4) == brute(rows, every=4)


def test_beyond_broadcast(spark, low_limits):
    rows = cloud(120, seed=7)
    assert found(spark, rows, every=10) == brute(rows, every=10)


def test_other_numbers(spark):
    rows = cloud(150, seed=5)
    options = {"positives": 2, "negatives": 3, "lower": 10, "upper": 100}
    assert found(spark, rows, every=10, **options) == brute(rows, every=10, **options)


def test_bounds_hold_and_walks_end_early():
    rng = np.random.default_rng(1)
    centres = np.eye(6)[:2]
    vectors = np.r_[rng.integers(-9, 9, (300, 6)), np.c_[rng.integers(90, 99, 300), rng.integers(0, 5, (300, 5))]]
    norms = np.sqrt((vectors**2).sum(1))
    members = vectors[-20:]
    angles = op._angles(members, norms[-20:], centres)[:, 0]
    bound = norms * (np.cos(np.maximum(0.0, op._angles(vectors, norms, centres)[:, 0] - angles.max() - op.SLACK)) + op.SLACK)
    assert (members @ vectors.T <= norms[-20:, None] * bound[None, :] + 1e-6).all()
    # The list's top holds all that is needed, so its rest is ruled out by the bound.
    best = np.sort(members @ vectors.T, axis=1)[:, -10]
    assert (norms[-20:] * np.sort(bound)[300] < best).all()


def test_too_large_is_an_error():
    big = pd.DataFrame({"anchor": [1], "positive": [1], "label": [1], "v": [[2**30]], "norm": [2.0**30], "low": [-np.inf], "high": [np.inf], "need": [-np.inf]})
    rows = pd.DataFrame({"id": [2], "label": [1], "v": [[2**30]], "norm": [2.0**30], "bound": [2.0**30]})
    with pytest.raises(OverflowError):
        op._walk_block(big, rows, 5, True)


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op.op12_hard_negatives(spark, FOLDER).collect()) == brute(rows)
