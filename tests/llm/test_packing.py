import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hardwood.llm import packing as op

from cases import EDGES, FOLDER


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def pieces(tokenizer, text, length=1024):
    """(piece, start, length, crc) of a text, straight from the file's own library."""
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    first = len(ids) % length or length
    ends = list(range(min(first, len(ids)), len(ids) + 1, length))
    return [
        (n, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())) for n, (s, e) in enumerate(zip([0, *ends], ends))
    ]


def check_sequences(rows, length=1024):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in by.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= length
    return len(by)


def test_query(spark, documents, tokenizer):
    rows = op.op5_packing(spark, FOLDER).collect()
    found = defaultdict(list)
    for r in rows:
        found[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert {d: sorted(p) for d, p in found.items()} == {d: pieces(tokenizer, r["text"]) for d, r in documents.items()}
    total = sum(r["length"] for r in rows)
    assert check_sequences(rows) <= -(-total // 1024) * 1.02 + 1


def test_edges(edges, tokenizer):
    rows = op.packed(op.tokenised(edges)).collect()
    want = sorted(str((d, *p)) for d, text, *_ in EDGES for p in pieces(tokenizer, text))
    assert sorted(str((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows) == want
    check_sequences(rows)


def test_empty(nothing):
    assert op.packed(op.tokenised(nothing)).count() == 0


@pytest.mark.parametrize("text", ["a<|endoftext|>b", "<|endoftext|>", "tab\tand  two spaces\n\n", "é中\U0001f600 1234567"])
def test_ids_are_those_of_the_tokenizers_file(tokenizer, text):
    assert op.encoder()(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_round_trip(make, tokenizer):
    rows = op.tokenised(make([(1, "some text to be cut " * 40)]), length=32, with_ids=True).orderBy("start").collect()
    ids = [i for r in rows for i in r["ids"]]
    assert ids.pop() == 2
    assert tokenizer.decode(ids) == "some text to be cut " * 40
    assert [r["length"] for r in rows[1:]] == [32] * (len(rows) - 1)


def test_islands_and_provinces(spark):
    sizes = spark.range(400).select(F.col("id"), (1 + F.pmod(F.xxhash64("id"), F.lit(99))).alias("length"), F.lit("p").alias("province"))
    found = op.packed(sizes.drop("province"), length=100, province=150, islands=3, epochs=3)
    rows = found.collect()
    assert len(rows) == 400
    total = sum(r["length"] for r in rows)
    assert check_sequences(rows, 100) <= -(-total // 100) * 1.06
    assert found.columns == ["id", "length", "sequence_id", "offset"]


def test_evolution_does_not_get_worse():
    rng = np.random.default_rng(3)
    sizes = np.sort(rng.integers(20, 70, 300))[::-1].copy()
    first = op._best_fit(range(len(sizes)), sizes.tolist(), np.full(len(sizes), -1), [], 100)
    genes = op._evolve([], sizes, 100, 12, np.random.default_rng(1))
    assert op._cost(genes[0], sizes) <= op._cost(first, sizes)
    for gene in genes:
        assert (gene >= 0).all()
        assert np.bincount(gene, weights=sizes).max() <= 100
