"""Packing of documents into sequences by a grouping genetic algorithm on islands.

A document becomes its token ids and an end id; only longer ones are cut, into pieces of one whole
sequence, of which the first may be shorter. Whole pieces are a sequence each. The rest is dealt out
to provinces of bounded size, and several islands evolve a packing of each province. A chromosome is
a grouping of pieces into bins: crossover injects well-filled bins of one parent into the other,
removes the bins that hold a piece twice, and puts the displaced pieces back by best fit. After each
epoch every island passes its best packing to the next one; the best island of a province counts.

Null and empty texts are one end id. Repeated rows are packed as often as they occur. A text of any length is cut in one
task. Pieces of equal length are taken in the order of their rows, equally good packings in that of their islands. An empty table
gives no pieces. No piece is dropped or cut again, and one task sees one province only. Other columns are not carried along.

The ids are those of the ``tokenizers`` file. They are computed by ``tiktoken`` from the same
vocabulary, which is several times faster; a text that holds a special token's string goes through
``tokenizers`` itself.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.llm.common import parts_for, prepared, table, text_of
from hardwood.session import materialize

LENGTH, END_ID = 1024, 2
PROVINCE, ISLANDS, EPOCHS = 20_000, 2, 2
POPULATION, GENERATIONS, WELL_FILLED = 4, 4, 0.98


# Kept by the process that made them.
_encoders: dict[tuple[str, str], Callable[[str], np.ndarray]] = {}


def _files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(tokenizer: str | None = None, ranks: str | None = None) -> Callable[[str], np.ndarray]:
    """Text to ids, as ``tokenizers`` gives them without special tokens added. Kept once per process."""
    import tiktoken

    if tokenizer is None or ranks is None:
        tokenizer, ranks = _files()
    if (tokenizer, ranks) in _encoders:
        return _encoders[tokenizer, ranks]
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(ranks, "rb") as lines:
        pairs = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pairs, special_tokens={})
    with open(tokenizer, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file).get("added_tokens") or []]
    slow = Tokenizer.from_file(tokenizer)

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special):
            return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    _encoders[tokenizer, ranks] = encode
    return encode


def tokenised(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    with_ids: bool = False,
    files: tuple[str, str] | None = None,
) -> DataFrame:
    """``(id, piece, start, length, ids_crc32[, ids])``: the pieces of every document."""
    prepared(docs.sparkSession)
    kind = docs.schema[id_col].dataType

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*(files or (None, None)))
        for batch in batches:
            row, piece, start, size, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text), np.uint32(END_ID)).astype("<u4")
                first = len(ids) % length or length
                for number, end in enumerate(range(min(first, len(ids)), len(ids) + 1, length)):
                    begin = max(0, end - length) if number else 0
                    part = ids[begin:end]
                    row.append(i)
                    piece.append(number)
                    start.append(begin)
                    size.append(end - begin)
                    crc.append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        kept.append(part.astype("int32"))
            columns = [
                batch.column("id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType(
        [T.StructField("id", kind)]
        + [T.StructField("piece", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
        + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])
    )
    return docs.select(F.col(f"`{id_col}`").alias("id"), text_of(docs[f"`{text_col}`"]).alias("text")).mapInArrow(cut, schema)


def _best_fit(order, sizes: list[int], gene: np.ndarray, room: list[int], capacity: int) -> np.ndarray:
    """Put the pieces of ``order`` into the fullest bin that has room; ``gene`` is changed."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for number, left in enumerate(room):
        if left:
            by_room[left].append(number)
            mask |= 1 << left
    for item in order:
        size = sizes[item]
        above = mask >> size
        if above:
            left = size + (above & -above).bit_length() - 1
            number = by_room[left].pop()
            if not by_room[left]:
                mask ^= 1 << left
        else:
            left, number = capacity, len(room)
            room.append(capacity)
        left -= size
        room[number] = left
        if left:
            by_room[left].append(number)
            mask |= 1 << left
        gene[item] = number
    return gene


def _cost(gene: np.ndarray, sizes: np.ndarray) -> tuple[int, float]:
    """Fewer bins first, then fuller ones."""
    fill = np.bincount(gene, weights=sizes)
    return int((fill > 0).sum()), -float((fill**2).sum())


def _child(mother: np.ndarray, father: np.ndarray, sizes: np.ndarray, plain: list[int], capacity: int, rng) -> np.ndarray:
    """The mother's grouping with some well-filled bins of the father's."""
    fill = np.bincount(father, weights=sizes)
    chosen = (fill >= WELL_FILLED * capacity) & (rng.random(len(fill)) < 0.5)
    injected = chosen[father]
    own = np.bincount(mother, weights=sizes)
    removed = np.zeros(len(own), dtype=bool)
    removed[mother[injected]] = True
    # The emptiest bins are taken apart, too.
    removed |= own < np.quantile(own[own > 0], 0.01) if (own > 0).any() else removed
    displaced = removed[mother] & ~injected
    gene = np.where(injected, father + len(own), mother)
    gene[displaced] = -1
    placed = gene >= 0
    labels, gene[placed] = np.unique(gene[placed], return_inverse=True)
    room = (capacity - np.bincount(gene[placed], weights=sizes[placed], minlength=len(labels))).astype(int).tolist()
    loose = np.flatnonzero(displaced)
    loose = loose[np.argsort(-(sizes[loose] + rng.random(len(loose)) * 0.02 * capacity), kind="stable")]
    return _best_fit(loose.tolist(), plain, gene, room, capacity)


def _evolve(genes: list[np.ndarray], sizes: np.ndarray, capacity: int, generations: int, rng) -> list[np.ndarray]:
    plain = sizes.tolist()
    noise = 0.0
    while len(genes) < POPULATION:
        order = np.argsort(-(sizes + rng.random(len(sizes)) * noise * capacity), kind="stable")
        genes.append(_best_fit(order.tolist(), plain, np.full(len(sizes), -1), [], capacity))
        noise += 0.02
    ranked = sorted(((_cost(g, sizes), i, g) for i, g in enumerate(genes)), key=lambda x: x[:2])[:POPULATION]
    fewest = -(-int(sizes.sum()) // capacity)
    for number in range(generations):
        if ranked[0][0][0] <= fewest:
            break  # no packing has fewer bins
        a, b = rng.permutation(len(ranked))[:2]
        child = _child(ranked[min(a, b)][2], ranked[max(a, b)][2], sizes, plain, capacity, rng)
        ranked.append((_cost(child, sizes), POPULATION + number, child))
        ranked = sorted(ranked, key=lambda x: x[:2])[:POPULATION]
    return [g for _, _, g in ranked]


def packed(pieces: DataFrame, length: int = LENGTH, province: int = PROVINCE, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; a piece's ``length`` is at most ``length``."""
    pieces = materialize(pieces.withColumn("pid", F.monotonically_increasing_id()), "pieces")
    partial = pieces.where(F.col("length") < length).select("pid", "length")
    provinces = parts_for(partial.count(), province)
    dealt = partial.select(F.pmod(F.xxhash64("pid"), F.lit(provinces)).cast("int").alias("province"), "pid", "length")
    state = dealt.select(
        "*",
        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
        F.lit(False).alias("migrant"),
        F.array().cast("array<int>").alias("genes"),
    )

    def epoch(number: int):
        last = number == epochs - 1

        def evolve(key, rows: pd.DataFrame) -> pd.DataFrame:
            here, island = int(key[0]), int(key[1])
            rows = rows.sort_values(["migrant", "length", "pid"], ascending=[True, False, True], kind="stable")
            own, guests = rows[~rows["migrant"]], rows[rows["migrant"]]
            sizes = own["length"].to_numpy(dtype=np.int64)
            genes = []
            if number:
                genes = list(np.stack(own["genes"].to_list()).T.astype(np.int64))
                if len(guests):
                    genes.append(np.stack(guests["genes"].to_list())[:, 0].astype(np.int64))
            rng = np.random.default_rng([here, island, number])
            genes = _evolve(genes, sizes, length, GENERATIONS, rng)
            out = pd.DataFrame({"province": here, "island": island, "pid": own["pid"].to_numpy(), "length": sizes})
            if not last:
                out["genes"] = list(np.stack(genes, axis=1).astype(np.int32))
                return out
            _, label = np.unique(genes[0], return_inverse=True)
            order = np.argsort(label, kind="stable")
            before = np.cumsum(sizes[order]) - sizes[order]
            first = np.r_[True, label[order][1:] != label[order][:-1]]
            offset = np.empty(len(sizes), dtype=np.int64)
            offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
            out["sequence_id"] = (np.int64(here) << 32) + label
            out["offset"] = offset
            out["bins"] = int(label.max()) + 1
            return out

        return evolve

    kept = "province int, island int, pid long, length long, genes array<int>"
    final = "province int, island int, pid long, length long, sequence_id long, offset long, bins long"
    for number in range(epochs):
        evolved = state.groupBy("province", "island").applyInPandas(epoch(number), final if number == epochs - 1 else kept)
        state = evolved = materialize(evolved, "islands")
        if number < epochs - 1:
            stay = evolved.withColumn("migrant", F.lit(False))
            move = evolved.select(
                "province",
                F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"),
                "pid",
                "length",
                F.slice("genes", 1, 1).alias("genes"),
                F.lit(True).alias("migrant"),
            )
            state = stay.unionByName(move) if islands > 1 else stay
    ranked = evolved.groupBy("province").agg(F.min(F.col("bins") * islands + F.col("island")).alias("best"))
    best = ranked.select("province", F.pmod("best", F.lit(islands)).cast("int").alias("island"))
    placed = evolved.join(best, ["province", "island"]).select("pid", "sequence_id", "offset")
    # A whole piece is a sequence of its own.
    return pieces.join(placed, "pid", "left").select(
        *[c for c in pieces.columns if c != "pid"],
        F.coalesce("sequence_id", -1 - F.col("pid")).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packed(tokenised(docs)).withColumnRenamed("id", "doc_id")


SQL: dict[str, str] = {}
QUERIES = {"op5_packing": op5_packing}
