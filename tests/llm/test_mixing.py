import math

import pytest
from pyspark.sql import functions as F

from hardwood.llm import mixing as op

from cases import EDGES, FOLDER


def filled(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by handing on the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    open_, left = set(order), share * sum(sizes.values())
    while open_ and left > 1e-9:
        whole = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / whole
        left = 0.0
        for s in list(open_):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                open_.discard(s)
    return target


def check(found, rows):
    sizes = {}
    for _, text, *rest in rows:
        source = (*rest, None, None)[1] if rest else "a"
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    want = filled(sizes)
    found = found.select("doc.source", "doc.text", "size", "source_size", "target", "copies").collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["size"] == len((r["text"] or "").encode().split())
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert math.floor(rate) <= r["copies"] <= math.ceil(rate) <= 2


def test_edges(edges):
    check(op.mixed(edges), EDGES)


def test_empty(nothing):
    assert op.mixed(nothing).count() == 0
    assert op.mixture(nothing).columns == nothing.columns


@pytest.mark.parametrize("limits", ["1000000", "0"])
def test_hot_source(spark, make, limits):
    """One source holds most rows; without broadcast its rows are salted."""
    rows = [(i, f"w{i} " * (1 + i % 9), "en", "hot") for i in range(300)] + [(1000 + i, "a b c", "en", f"s{i % 5}") for i in range(60)]
    spark.conf.set("spark.hardwood.broadcastRows", limits)
    spark.conf.set("spark.hardwood.blockRows", "50")
    try:
        check(op.mixed(make(rows)), rows)
    finally:
        spark.conf.unset("spark.hardwood.broadcastRows")
        spark.conf.unset("spark.hardwood.blockRows")


def test_taken_words_come_near_the_targets(make):
    rows = [(i, "w " * (1 + i % 13), "en", "abc"[i % 3]) for i in range(3000)]
    sums = op.mixed(make(rows)).groupBy("doc.source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.first("target").alias("g"))
    for r in sums.collect():
        assert abs(r["t"] / r["g"] - 1) < 0.05


def test_mixture_repeats_rows(make):
    docs = make([(i, "w " * (1 + i % 7), "en", "ab"[i % 2]) for i in range(200)])
    wanted = {r["doc_id"]: r["copies"] for r in op.mixed(docs).select("doc.doc_id", "copies").collect()}
    found = {r["doc_id"]: r["count"] for r in op.mixture(docs).groupBy("doc_id").count().collect()}
    assert found == {d: n for d, n in wanted.items() if n}


def test_reruns_and_partitions_agree(spark):
    first = {tuple(r) for r in op.op9_mixing(spark, FOLDER).collect()}
    assert first == {tuple(r) for r in op.op9_mixing(spark, FOLDER).repartition(7).collect()}
