"""Language-model scoring by cross-entropy difference.

A target and a background model of words and word pairs share one vocabulary: the words seen at least ``WORD_LEAST``
times in all documents; the rest is one unknown word, whose probability comes from the words seen less often.
Pairs of such words count from ``PAIR_LEAST`` times on. Both are fixed numbers, so vocabulary and pairs grow with the
corpus, and no word or pair that repeats is left out at any size. The models are matched: counts are scaled to the smaller
corpus, and cut-offs, smoothing and interpolation are the same. A document's score is the mean over its tokens of the loss under
the target model less the loss under the background model; the lower, the more like the target. A pair that does not
count leaves its second word alone.

Documents are read once, in blocks of about ``HELD_TOKENS`` tokens. A block is kept as the numbers of its words, and asks for the
counts of its different words and pairs, each once, with what it counted itself: the same rows that ask
make the totals. Questions go by key ranges as sorted, delta-coded lists. A range adds up what all blocks counted, and answers
each block with one bit per key and the totals of the keys that count, so what occurs once costs a bit. The block
then adds up the losses of its documents. Nothing is broadcast but a few sums, and no key is hot: each block asks once.

Words are lower-cased runs without ASCII white space. Words and pairs go by hashes with ``SPARE_BITS`` bits more than it takes to
count the corpus' bytes (63 at most), so at any size fewer than one in 10^7 shares its hash with another. Null and empty texts have no tokens,
losses and score 0. Rows without an id are background. An empty target gives a uniform target model. Repeated
rows count as often as they occur and give a row each; an empty table gives an empty result. Other columns are not read. A text of
any length is part of one block. Scores that tie stay as they are: nothing is ranked.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm.common import prepared, table, text_of
from hardwood.operators.balance import attach
from hardwood.session import materialize

WORD_LEAST, PAIR_LEAST = 2, 2
PAIRS_WEIGHT = 0.6
# Tokens and different words of a block, checked after each batch of texts.
HELD_TOKENS, HELD_WORDS = 2_000_000, 300_000
# Tokens of a row that keeps documents: Parquet looks at the size of a page only after a hundred rows.
ROW_TOKENS = 50_000
# Bytes of text whose words and pairs make one range of keys.
RANGE_BYTES = 16 * 1024 * 1024
SPARE_BITS = 24
# Hash of what leads a text.
START = 0x9E3779B97F4A7C15

_BLOCK = (
    "block long, part long, ids array<long>, lengths binary, words binary, keys binary, n binary, t binary, "
    "tokens_n long, tokens_t long, texts_n long, texts_t long"
)
_ANSWER = "block long, part long, size long, known binary, n binary, t binary, words_known long, words_n long, words_t long"


class Numbers(dict):
    """Words by the order in which they are met, from 1 on."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def squeezed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on as bytes: small ones cost little, as equal bytes of all numbers lie together."""
    planes = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def opened(data: bytes) -> np.ndarray:
    """What :func:`squeezed` got, as unsigned longs."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _block_keys(words: np.ndarray, codes: np.ndarray, bits: int) -> np.ndarray:
    """Keys of a block's words (even) and of its pairs (odd), from word hashes and ``first << 32 | second``; 0 leads a text.

    A key has ``bits`` bits of hash and one that tells words from pairs.
    """
    hashes = np.r_[np.uint64(START), words]
    first, second = hashes[codes >> np.uint64(32)], hashes[codes & np.uint64(0xFFFFFFFF)]
    pair = (first ^ (first >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + second
    pair = (pair ^ (pair >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    pair ^= pair >> np.uint64(29)
    rest = np.uint64(64 - bits)
    return np.r_[words >> rest << np.uint64(1), pair >> rest << np.uint64(1) | np.uint64(1)]


def _pairs(sequence: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``first << 32 | second`` of each token of texts one after another; the first word of a text follows 0."""
    first = np.zeros(len(sequence), dtype=np.uint64)
    first[1:] = sequence[:-1]
    starts = (np.cumsum(lengths) - lengths)[lengths > 0]
    first[starts] = 0
    first <<= np.uint64(32)
    first |= sequence
    return first


def _blocks(texts: DataFrame, bits: int, range_bits: int) -> DataFrame:
    """Rows of documents (null ``part``) and questions of blocks, from ``(id, text, target)``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
        schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _BLOCK.split(", ")])

        def row(**values: object) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([values.get(c)], schema.field(c).type) for c in names], schema=schema)

        # For each batch: the numbers of all words, the texts' lengths, and which texts are in the target.
        known = Numbers()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def asked() -> Iterator[pa.RecordBatch]:
            words = np.fromiter(map(xxhash.xxh3_64_intdigest, known), dtype=np.uint64, count=len(known))
            sequence, lengths, inside = (np.concatenate(c) for c in zip(*held))
            held.clear()
            weights = np.repeat(inside, lengths).astype(np.float64)
            codes, at, n = np.unique(_pairs(sequence, lengths), return_inverse=True, return_counts=True)
            t = np.bincount(at, weights=weights, minlength=len(codes))
            single = sequence.astype(np.int64) - 1
            n = np.r_[np.bincount(single, minlength=len(words)), n]
            t = np.r_[np.bincount(single, weights=weights, minlength=len(words)), t].astype(np.int64)
            keys = _block_keys(words, codes, bits)
            del codes, at
            order = np.argsort(keys, kind="stable")
            keys, n, t = keys[order], n[order], t[order]
            filled = lengths > 0
            yield row(
                block=number, words=squeezed(words), tokens_n=len(sequence), tokens_t=int(weights.sum()),
                texts_n=int(filled.sum()), texts_t=int((filled & inside).sum()),
            )
            part = keys >> np.uint64(bits + 1 - range_bits)
            edges = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(keys)]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if a < b:
                    steps = np.diff(keys[a:b], prepend=np.uint64(0))
                    yield row(block=number, part=int(part[a]), keys=squeezed(steps), n=squeezed(n[a:b]), t=squeezed(t[a:b]))

        for batch in batches:
            numbers, lengths, ids, inside = array("I"), [], [], []

            def kept() -> pa.RecordBatch:
                sequence, sizes = np.array(numbers, dtype=np.uint32), np.array(lengths, dtype=np.int64)
                held.append((sequence, sizes, np.array(inside, dtype=bool)))
                return row(block=number, ids=ids, lengths=squeezed(sizes), words=squeezed(sequence))

            for doc_id, text, target in zip(batch.column("id").to_pylist(), batch.column("text"), batch.column("target").to_pylist()):
                words = text.as_py().lower().split()
                numbers.extend(map(known.__getitem__, words))
                lengths.append(len(words))
                ids.append(doc_id)
                inside.append(target)
                if len(numbers) > ROW_TOKENS:
                    yield kept()
                    numbers, lengths, ids, inside = array("I"), [], [], []
            if lengths:
                yield kept()
            if sum(len(s) for s, _, _ in held) > HELD_TOKENS or len(known) > HELD_WORDS:
                yield from asked()
                known.clear()
                number += 1
        if held:
            yield from asked()

    return materialize(texts.mapInArrow(read, _BLOCK), "blocks")


def _answers(blocks: DataFrame, word_least: int, pair_least: int) -> DataFrame:
    """For each question, which keys count and their totals; and per range the words that count."""

    def answer(questions: pa.Table) -> pa.Table:
        columns = {c: questions.column(c).to_pylist() for c in ("block", "part", "keys", "n", "t")}
        keys = [np.cumsum(opened(k), dtype=np.uint64) for k in columns["keys"]]
        sizes = [len(k) for k in keys]
        different, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = {c: np.bincount(at, weights=np.concatenate([opened(v) for v in columns[c]]).astype(np.float64)).astype(np.int64) for c in "nt"}
        single = different & np.uint64(1) == 0
        counts = total["n"] >= np.where(single, word_least, pair_least)
        rows, end = [], 0
        for block, part, size in zip(columns["block"], columns["part"], sizes):
            asked = at[end : end + size]
            end += size
            known = counts[asked]
            rows.append((block, part, size, np.packbits(known).tobytes(), *[squeezed(total[c][asked[known]]) for c in "nt"], None, None, None))
        words = counts & single
        rows.append((None, columns["part"][0], None, None, None, None, int(words.sum()), *[int(total[c][words].sum()) for c in "nt"]))
        kinds = {"long": pa.int64(), "binary": pa.binary()}
        schema = [c.split() for c in _ANSWER.split(", ")]
        return pa.table({name: pa.array(values, kinds[kind]) for (name, kind), values in zip(schema, zip(*rows))})

    asked = blocks.where("part IS NOT NULL").select("block", "part", "keys", "n", "t")
    return materialize(asked.groupBy("part").applyInArrow(answer, _ANSWER), "answers")


def scored(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    word_least: int = WORD_LEAST,
    pair_least: int = PAIR_LEAST,
) -> DataFrame:
    """``(id, n_tokens, ce_target, ce_background)`` for each row; ``target`` holds the ids of the target, in ``id``."""
    prepared(docs.sparkSession)
    ids = materialize(target.select("id").where("id IS NOT NULL").distinct().withColumn("target", F.lit(True)), "target")
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(f"`{text_col}`").cast("binary").alias("text"))
    marked = attach(texts, ids, ["id"], ["text"]).select("id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(63, size.bit_length() + SPARE_BITS)
    blocks = _blocks(marked, bits, min(bits, max(0, -(-size // RANGE_BYTES) - 1).bit_length()))
    answers = _answers(blocks, word_least, pair_least)

    sums = blocks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens_n", "tokens_t", "texts_n", "texts_t")]).first()
    kept = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words_known", "words_n", "words_t")]).first()
    total = {c: sums[f"tokens_{c}"] for c in "nt"}
    lead = {c: sums[f"texts_{c}"] for c in "nt"}
    rest = {c: total[c] - kept[f"words_{c}"] for c in "nt"}
    vocabulary = kept["words_known"] + 1
    small = min(total.values())
    scale = {c: min(1.0, small / max(total[c], 1)) if small else 1.0 for c in "nt"}

    def score(documents: pa.Table, answered: pa.Table) -> pa.Table:
        rows = documents.to_pylist()
        words = opened(next(r["words"] for r in rows if r["ids"] is None))
        rows = [r for r in rows if r["ids"] is not None]
        names = ["id", "n_tokens", "ce_target", "ce_background"]
        lengths = np.concatenate([opened(r["lengths"]) for r in rows]).astype(np.int64)
        codes, at = np.unique(_pairs(np.concatenate([opened(r["words"]) for r in rows]), lengths), return_inverse=True)
        keys = _block_keys(words, codes, bits)
        replies = sorted(answered.to_pylist(), key=lambda r: r["part"])
        known = np.concatenate([np.zeros(0, dtype=bool), *[np.unpackbits(np.frombuffer(r["known"], np.uint8), count=r["size"]).astype(bool) for r in replies]])
        order = np.argsort(keys, kind="stable")
        first, second = (codes >> np.uint64(32)).astype(np.int64), (codes & np.uint64(0xFFFFFFFF)).astype(np.int64) - 1
        counts = np.zeros(len(keys), dtype=bool)
        counts[order] = known
        order, means = order[known], []
        del keys, codes
        text = np.repeat(np.arange(len(lengths)), lengths)
        for c in "tn":
            found = np.zeros(len(counts), dtype=np.float64)
            found[order] = np.concatenate([np.zeros(0), *[opened(r[c]).astype(np.float64) for r in replies]])
            single, pair = found[: len(words)], found[len(words) :]
            one = (np.where(counts[: len(words)], single, rest[c]) * scale[c] + 1.0) / (total[c] * scale[c] + vocabulary)
            leads = np.maximum(np.r_[lead[c], single] * scale[c], 1e-12)
            # A pair counts with both its words, or as the beginning of a text with its only one.
            sure = counts[len(words) :] & counts[: len(words)][second] & np.r_[True, counts[: len(words)]][first]
            share = np.minimum(pair * scale[c] / leads[first], 1.0)
            loss = -np.log(np.where(sure, PAIRS_WEIGHT * share + (1 - PAIRS_WEIGHT) * one[second], one[second]))
            means.append(np.bincount(text, weights=loss[at], minlength=len(lengths)) / np.maximum(lengths, 1))
        ids = pa.array([i for r in rows for i in r["ids"]], pa.int64())
        return pa.table([ids, pa.array(lengths), pa.array(means[0]), pa.array(means[1])], names=names)

    documents = blocks.where("part IS NULL").select("block", "ids", "lengths", "words")
    replies = answers.where("block IS NOT NULL").select("block", "part", "size", "known", "n", "t")
    return documents.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        score, "id long, n_tokens long, ce_target double, ce_background double"
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what the labels call good and not toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    found = scored(docs, labels.select(F.col("doc_id").alias("id")))
    difference = (F.col("ce_target") - F.col("ce_background")).alias("score")
    return found.select(F.col("id").alias("doc_id"), "n_tokens", "ce_target", "ce_background", difference)


SQL: dict[str, str] = {}
QUERIES = {"op8_lm_scoring": op8_lm_scoring}
