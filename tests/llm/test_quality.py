import math
import zlib

import pytest
from cases import EDGES, FOLDER
from pyspark.sql import functions as F

from hardwood.llm import quality as op
from hardwood.llm.statistics import counted


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def ensemble(docs, labels):
    return op.learnt(docs, labels)


def test_held_out_accuracy(docs, labels, ensemble):
    found = op.scored(docs, ensemble).select("doc.doc_id", "score").join(labels, "doc_id")
    found = found.where(op.held_out(F.col("doc_id"))).collect()
    right = sum((r["score"] >= op.THRESHOLD) == (r["quality"] == 1) for r in found)
    assert len(found) > 50 and right / len(found) > 0.95


def test_query_holds_out_by_crc(spark):
    for r in op.op10_quality(spark, FOLDER).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_never_learns_from_held_out_rows(docs, labels):
    """Labels of held-out rows may say anything."""
    lies = labels.withColumn("quality", F.when(op.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert op.learnt(docs, lies) == op.learnt(docs, labels)


def test_rules_are_sparse_conjunctions(ensemble):
    assert 0 < len(ensemble.rules) < 200
    assert all(r.at_most or r.above for r in ensemble.rules)
    assert any(len(r.at_most) + len(r.above) > 1 for r in ensemble.rules)


def test_compiled_score_is_the_sum_of_rules(docs, ensemble):
    of = op.features("counts")
    rows = docs.select("doc_id", counted(F.col("text")).alias("counts"))
    for r in rows.select(ensemble.score("counts").alias("score"), *[c.alias(n) for n, c in of.items()]).limit(50).collect():
        total = ensemble.intercept
        for rule in ensemble.rules:
            if all(r[n] <= b for n, b in rule.at_most) and all(r[n] > b for n, b in rule.above):
                total += rule.weight
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_edges(edges, ensemble):
    found = op.scored(edges, ensemble)
    assert found.count() == len(EDGES)
    assert found.where("score IS NULL OR isnan(score)").count() == 0


def test_empty(nothing, labels, ensemble):
    assert op.scored(nothing, ensemble).count() == 0
    assert op.accepted(nothing, labels).columns == nothing.columns


@pytest.mark.parametrize("quality, score", [([], 0.5), ([1, 1, 1], 0.8), ([0], 1 / 3)])
def test_nothing_to_tell_apart(spark, make, quality, score):
    labels = spark.createDataFrame([(i * 4, q) for i, q in enumerate(quality)] + [(None, 1), (3, None)], "doc_id long, quality int")
    labels = labels.where(~op.held_out(F.col("doc_id")))
    docs = make([(i * 4, f"some text {i}") for i in range(3)])
    n = labels.join(docs, "doc_id").where("quality IS NOT NULL").count()
    good = labels.join(docs, "doc_id").where("quality = 1").count()
    found = op.scored(docs, op.learnt(docs, labels)).collect()
    assert all(math.isclose(r["score"], (good + 1) / (n + 2)) for r in found)


def test_accepted_keeps_columns(docs, labels):
    kept = op.accepted(docs, labels)
    assert kept.columns == docs.columns
    judged = kept.select("doc_id").join(labels, "doc_id").groupBy("quality").count().collect()
    by = {r["quality"]: r["count"] for r in judged}
    assert by.get(0, 0) < 0.1 * by[1]


def test_rows_that_share_an_id_always_give_the_same_model(docs, labels):
    """Two texts under each of some ids, in any order of rows."""
    twice = docs.select("doc_id", "text").unionByName(docs.where("doc_id % 3 = 0").select("doc_id", F.concat("text", F.lit(" and more")).alias("text")))
    first = op.learnt(twice.repartition(3, "text"), labels)
    assert first == op.learnt(twice.orderBy(F.col("text").desc()), labels)
