import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from hardwood.llm import exact_dedup as op

from cases import EDGES, FOLDER


def expected(rows):
    """Text to (largest id, count)."""
    by_text = defaultdict(list)
    for doc_id, text, *_ in rows:
        by_text[text or ""].append(doc_id)
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in by_text.items()}


def check(found, rows):
    want = expected(rows)
    found = found.select("doc.doc_id", "doc.text", "keep_id", "group_size", "kept").collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["keep_id"], r["group_size"]) == want[r["text"] or ""]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in found) == len(want)


def test_edges(edges):
    check(op.exact_duplicates(edges), EDGES)


def test_empty(nothing):
    assert op.exact_duplicates(nothing).count() == 0
    assert op.without_copies(nothing).columns == nothing.columns


def test_collisions_are_chained_and_pages_overflow(make):
    rows = [(i, f"text {i % 7}") for i in range(60)] + [(100 + i, f"alone {i}") for i in range(40)]
    # Two keys for everything: 47 different texts collide, and each key overflows many pages.
    key = F.pmod(F.xxhash64("doc.text"), F.lit(2)).cast("long")
    check(op.exact_duplicates(make(rows), capacity=4, key=key), rows)


def test_directory_doubles_only_where_overfull(spark):
    keys = spark.range(64).select(F.shiftleft(F.col("id"), 50).alias("key"), F.lit(1).cast("long").alias("n"))  # share 8 leading bits
    far = spark.range(4).select((F.shiftleft(F.col("id"), 62) + 1000).alias("key"), F.lit(1).cast("long").alias("n"))
    leaves = op.directory(keys.union(far), 16).collect()
    assert sum(r["load"] for r in leaves) == 68
    spread = {r["depth"] for r in leaves}
    assert len(spread) > 1  # only the overfull side went deeper
    assert max(r["load"] for r in leaves) <= 16


def test_without_copies(make):
    rows = [(1, "a"), (5, "a"), (3, "b"), (None, "c"), (None, "c")]
    kept = op.without_copies(make(rows))
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect()) == [(-1, "c"), (3, "b"), (5, "a")]
    assert kept.columns == make(rows).columns


def test_query(spark, documents):
    want = expected([(d, r["text"]) for d, r in documents.items()])
    found = op.op2_exact_dedup(spark, FOLDER).collect()
    assert len(found) == len(documents)
    for r in found:
        text = documents[r["doc_id"]]["text"]
        assert (r["keep_id"], r["group_size"]) == want[text or ""]
        assert r["kept"] == (r["doc_id"] == r["keep_id"])
        assert r["text_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
