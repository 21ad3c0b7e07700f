"""Repeated passages by a distributed merge sort of suffixes that knows common prefixes.

Removed is each byte covered by a string of ``least`` bytes that starts anywhere else, too, in the same text or another.

1. *Which suffixes.* In every stretch of ``least`` bytes one position is picked by the bytes alone: the leftmost least hash of eight
   bytes among the first W positions. Equal stretches pick the same place, so two of them give suffixes that agree for at least
   ``least - W + 1`` bytes. Suffixes whose first so many bytes occur once are no part of a repeat and go no further.
2. *Sorted runs.* A task sorts the suffixes of its texts and cuts the run at splitters common to all. Runs are exchanged
   front-coded: a suffix is the length of the prefix it shares with the one before, and the rest.
3. *Merge.* A loser tree merges a range's runs. Each loser keeps the length of the prefix it shares with the winner that
   passed, so bytes known to be equal are never compared again; the lengths come out as the LCP array.
4. *Repeats.* A stretch that begins o bytes before suffix a is repeated if another suffix shares o bytes to the left and
   ``least - o`` to the right. With the bytes to the left sorted in the same way, suffixes that share t bytes are those between
   entries below t of an LCP array, so one pass for each o finds all repeated stretches, without a look at pairs. The first and
   the last of them bound what a removes.

Splitters look at the first ``least - W + 1`` bytes only, so what may be equal stays together. Suffixes of one beginning with more
than ``HOT`` members are not sorted in one task: their stretches are counted by 128-bit digests instead.

Matches do not cross texts. A null text counts as empty and has nothing to remove, nor does one shorter than ``least``. Texts that occur
twice and have ``least`` bytes are removed whole; null and repeated ids make no difference. Long texts are read in chunks. Ties cannot
occur, as all rows are judged on the input. An empty table gives an empty result; other columns are carried along.
Texts are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm.common import table, text_of, wrapped
from hardwood.operators.balance import attach, within_limit
from hardwood.session import materialize

LEAST = 400
# Positions hashed at once; their numbers take the low bits of a packed hash.
CHUNK_BITS = 20
# Bytes of suffixes in a run, suffixes in a range, ranges that the driver knows splitters of, and samples for each.
RUN_BYTES, RANGE, RANGES, SAMPLES = 48 * 1024 * 1024, 30_000, 2_000, 8
# Suffixes of one beginning that are sorted in one task.
HOT = 50_000


@dataclass(frozen=True)
class Shape:
    """Lengths that follow from ``least``: positions looked at, and bytes that equal suffixes share at least."""

    least: int
    window: int
    shared: int

    @classmethod
    def of(cls, least: int) -> Shape:
        if least < 16:
            raise ValueError("passages have at least 16 bytes")
        window = 1 << int(math.log2(least * 2 / 3))
        return cls(least, window, least - window + 1)


def _eights(data: np.ndarray) -> np.ndarray:
    """A mixed hash of the eight bytes from each position on, but the last seven positions."""
    n = max(0, len(data) - 7)
    out = np.empty(n, dtype=np.uint64)
    for shift in range(min(8, n)):
        count = -(-(n - shift) // 8)
        out[shift::8] = np.frombuffer(data[shift : shift + 8 * count].tobytes(), dtype="<u8")
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out


def picked(data: np.ndarray, offsets: np.ndarray, shape: Shape, chunk_bits: int = CHUNK_BITS) -> np.ndarray:
    """The positions in ``data`` (texts one after another from ``offsets`` on) that some stretch of a text picks."""
    found = []
    low = np.uint64((1 << chunk_bits) - 1)
    step = (1 << chunk_bits) - shape.window
    for start in range(0, len(data) - shape.least + 1, step):
        windows = min(step, len(data) - shape.least + 1 - start)
        hashes = _eights(data[start : start + windows + shape.window + 6])
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while width < shape.window:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        inside = np.zeros(windows, dtype=bool)
        first = max(0, int(np.searchsorted(offsets, start, side="right")) - 1)
        for text in range(first, len(offsets) - 1):
            if offsets[text] >= start + windows:
                break
            inside[max(0, offsets[text] - start) : max(0, offsets[text + 1] - shape.least + 1 - start)] = True
        at = (least[:windows][inside] & low).astype(np.int64)
        found.append(np.unique(at) + start)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of texts, and where each begins."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _samples(texts: DataFrame, shape: Shape) -> DataFrame:
    """``(h, k, pos)``: the picked positions of ``(k, text)`` with a hash of the bytes they certainly share."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _joined(batch.column("text"))
            at = picked(data, offsets, shape)
            text = np.searchsorted(offsets, at, side="right") - 1
            view = memoryview(data)
            hashes = [xxhash.xxh3_64_intdigest(view[p : p + shape.shared]) for p in at.tolist()]
            keys = batch.column("k").to_numpy(zero_copy_only=False)[text]
            columns = [np.array(hashes, dtype=np.uint64).view(np.int64), keys, (at - offsets[text]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "k", "pos"])

    return materialize(texts.mapInArrow(pick, "h long, k long, pos int"), "samples")


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix of two strings of which ``known`` bytes are known to be equal."""
    n = min(len(a), len(b))
    while known < n:
        x, y = a[known : known + 64], b[known : known + 64]
        if x != y:
            short = min(len(x), len(y))
            differ = int.from_bytes(x[:short]) ^ int.from_bytes(y[:short])
            return known + short - (differ.bit_length() + 7) // 8
        known += len(x)
    return n


class LoserTree:
    """Merges sorted runs of ``(string, prefix shared with the one before in its run, payload)``."""

    def __init__(self, runs: list[Iterator[tuple[bytes, int, object]]]):
        self.runs = [iter(r) for r in runs]
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.heads: list = [next(r, None) for r in self.runs] + [None] * (self.size - len(runs))
        # A head's prefix shared with the string that left the tree last; -1 where a run has ended.
        self.shared = [0 if head is not None else -1 for head in self.heads]
        self.losers = [0] * self.size

    def _match(self, one: int, other: int) -> tuple[int, int]:
        """Winner and loser; the loser's length becomes that of the prefix it shares with the winner."""
        h, g = self.shared[one], self.shared[other]
        if h != g:
            return (one, other) if h > g else (other, one)
        if h < 0:
            return one, other
        a, b = self.heads[one][0], self.heads[other][0]
        both = common_prefix(a, b, h)
        if a[both : both + 1] <= b[both : both + 1]:
            self.shared[other] = both
            return one, other
        self.shared[one] = both
        return other, one

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.losers[node] = self._match(self._play(2 * node), self._play(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[bytes, int, object]]:
        winner = self._play(1) if self.size > 1 else 0
        while self.heads[winner] is not None:
            string, _, payload = self.heads[winner]
            yield string, self.shared[winner], payload
            following = next(self.runs[winner], None)
            self.heads[winner] = following
            self.shared[winner] = -1 if following is None else following[1]
            node = (winner + self.size) >> 1
            while node:
                winner, self.losers[node] = self._match(winner, self.losers[node])
                node >>= 1


def repeats(suffixes: list[tuple[bytes, int, bytes]], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """For sorted ``(right, shared, left reversed)``: least and greatest o whose stretch is repeated, -1 where none is."""
    n = len(suffixes)
    first, last = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    right = np.array([s[1] for s in suffixes], dtype=np.int64)
    group = np.cumsum(right < shape.shared)
    order = sorted(range(n), key=lambda i: (group[i], suffixes[i][2]))
    left = np.full(n, -1, dtype=np.int64)
    for place in range(1, n):
        a, b = order[place - 1], order[place]
        if group[a] == group[b]:
            left[place] = common_prefix(suffixes[a][2], suffixes[b][2])
    order = np.array(order, dtype=np.int64)
    by_left = np.empty(n, dtype=np.int64)
    for o in range(shape.window):
        by_left[order] = np.cumsum(left < o)
        key = np.cumsum(right < shape.least - o) * (n + 1) + by_left
        along = np.argsort(key, kind="stable")
        same = key[along][1:] == key[along][:-1]
        found = np.zeros(n, dtype=bool)
        found[along[1:][same]] = True
        found[along[:-1][same]] = True
        last[found] = o
        first[found & (first < 0)] = o
    return first, last


_RUN = "part int, run long, seq int, shared int, rest binary, before binary, k long, k2 long, pos int"


def _sorted_runs(texts: DataFrame, shape: Shape, splitters: list[bytes], subs: int) -> DataFrame:
    """Front-coded runs from ``(k, k2, text, cold)``; a run starts anew in each range."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple[bytes, bytes, int, int, int]] = []
        size, seen = 0, set()

        def handed() -> Iterator[pa.RecordBatch]:
            rows = []
            for right, before, k, k2, pos in held:
                head = right[: shape.shared]
                part = bisect_right(splitters, head)
                rows.append((part * subs + xxhash.xxh3_64_intdigest(head) % subs, right, before, k, k2, pos))
            rows.sort()
            previous, coded = (-1, b""), []
            for seq, (part, right, before, k, k2, pos) in enumerate(rows):
                shared = common_prefix(previous[1], right) if previous[0] == part else 0
                coded.append((part, (task << 32) + number, seq, shared, right[shared:], before, k, k2, pos))
                previous = part, right
            for start in range(0, len(coded), 20_000):
                columns = zip(*coded[start : start + 20_000])
                kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in _RUN.split(", ")])

        for batch in batches:
            for k, k2, text, places in zip(*[batch.column(c).to_pylist() for c in ("k", "k2", "text", "cold")]):
                # Copies of a text are removed whole; their suffixes count once.
                if (k, k2) in seen:
                    continue
                seen.add((k, k2))
                for pos in places:
                    right, before = text[pos : pos + shape.least], text[max(0, pos - shape.window + 1) : pos]
                    held.append((right, before, k, k2, pos))
                    size += len(right) + len(before)
                if size > RUN_BYTES:
                    yield from handed()
                    held.clear()
                    seen.clear()
                    size, number = 0, number + 1
        yield from handed()

    return texts.select("k", "k2", "text", "cold").mapInArrow(sort, _RUN)


def _merged(runs: DataFrame, shape: Shape, parts: int) -> DataFrame:
    """``(k, k2, start, end)``: what the suffixes of each range remove."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def decided(of_run: dict[int, list]) -> pa.RecordBatch:
            merged = list(LoserTree(list(of_run.values())))
            first, last = repeats([(right, shared, p[0]) for right, shared, p in merged], shape)
            keep = np.flatnonzero(last >= 0)
            k, k2, pos = (np.array([merged[i][2][c] for i in keep], dtype=np.int64) for c in (1, 2, 3))
            columns = [k, k2, pos - last[keep], pos - first[keep] + shape.least]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", "k2", "start", "end"])

        at, of_run, seen = None, {}, set()
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("part", "run", "shared", "rest", "before", "k", "k2", "pos")]):
                part, run, shared, rest, before, k, k2, pos = row
                if part != at:
                    if of_run:
                        yield decided(of_run)
                    at, of_run, seen, whole, passed, before_run = part, {}, set(), b"", 0, None
                if run != before_run:
                    before_run, passed = run, 0
                    whole, skipped = b"", False
                    of_run[run] = []
                whole = whole[:shared] + rest
                # The prefix shared with the last suffix that was not left out.
                passed = min(passed, shared) if skipped else shared
                skipped = (k, k2, pos) in seen
                if not skipped:
                    seen.add((k, k2, pos))
                    of_run[run].append((whole, passed, (before[::-1], k, k2, pos)))
        if of_run:
            yield decided(of_run)

    ordered = runs.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "run", "seq")
    return ordered.mapInArrow(merge, "k long, k2 long, start long, end long")


def _digests(texts: DataFrame, shape: Shape) -> DataFrame:
    """``(d1, d2, k, k2, start)`` for each stretch around the hot suffixes of ``(k, k2, text, hot)``."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, k2, text, places in zip(*[batch.column(c).to_pylist() for c in ("k", "k2", "text", "hot")]):
                starts = sorted({s for p in places for s in range(max(0, p - shape.window + 1), min(p, len(text) - shape.least) + 1)})
                both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(text[s : s + shape.least]) for s in starts), dtype=">i8").astype(np.int64)
                columns = [both[0::2], both[1::2], np.full(len(starts), k), np.full(len(starts), k2), np.array(starts, dtype=np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["d1", "d2", "k", "k2", "start"])

    found = texts.select("k", "k2", "text", "hot").mapInArrow(digest, "d1 long, d2 long, k long, k2 long, start long")
    found = materialize(found, "digests")
    place = F.xxhash64("k", "k2", "start")
    twice = found.groupBy("d1", "d2").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("lo <> hi").select("d1", "d2")
    known = attach(found, materialize(twice, "twice"), ["d1", "d2"], ["k", "start"], "inner")
    return known.select("k", "k2", "start", (F.col("start") + shape.least).alias("end"))


def _cuts(texts: DataFrame, shape: Shape, hot: int) -> DataFrame:
    """``(k, k2, start, end)``: parts of the texts ``(k, k2, text)`` that are to go; they may overlap."""
    samples = _samples(texts, shape)
    place = F.xxhash64("k", "pos")
    shared = samples.groupBy("h").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.count(F.lit(1)).alias("n")).where("lo <> hi")
    marked = attach(samples, materialize(shared.select("h", "n"), "shared"), ["h"], ["k", "pos"], "inner")
    # At most as many positions as a text has.
    lists = marked.groupBy("k").agg(
        F.array_sort(F.collect_set(F.when(F.col("n") <= hot, F.col("pos")))).alias("cold"),
        F.array_sort(F.collect_set(F.when(F.col("n") > hot, F.col("pos")))).alias("hot"),
    )
    lists = materialize(lists, "lists")
    size = lists.agg(F.sum(F.size("cold")).alias("cold"), F.sum(F.size("hot")).alias("hot")).first()
    listed = attach(texts, lists, ["k"], ["k2"], "inner")
    ranges = max(1, math.ceil((size["cold"] or 0) / RANGE))
    subs = math.ceil(ranges / RANGES)
    ranges = math.ceil(ranges / subs)
    splitters: list[bytes] = []
    if ranges > 1:
        # About ``ranges * SAMPLES`` beginnings of suffixes reach the driver.
        every = max(1, size["cold"] // (ranges * SAMPLES))
        few = lists.select("k", F.explode("cold").alias("pos")).where(F.pmod(F.xxhash64("k", "pos"), F.lit(every)) == 0)
        few = materialize(few, "sampled")
        joined = texts.join(F.broadcast(few) if within_limit(few) else few, "k")
        heads = sorted({bytes(r[0]) for r in joined.select(F.expr(f"substring(text, pos + 1, {shape.shared})")).collect()})
        splitters = [heads[len(heads) * i // ranges] for i in range(1, ranges)] if heads else []
    found = _merged(_sorted_runs(listed, shape, splitters, subs), shape, (len(splitters) + 1) * subs)
    if size["hot"]:
        found = found.unionByName(_digests(listed.where(F.size("hot") > 0), shape))
    return found


def _apply(text: Column, cuts: Column) -> Column:
    """``(spans, kept)``: disjoint removed runs in order, and the bytes that remain; null where there are no cuts."""

    @F.arrow_udf("spans array<struct<start: long, end: long>>, kept binary")
    def cut(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        found = []
        for whole, parts in zip(texts.to_pylist(), cuts.to_pylist()):
            if parts is None:
                found.append(None)
                continue
            spans: list[list[int]] = []
            for part in sorted(parts, key=lambda p: p["start"]):
                if spans and part["start"] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], part["end"])
                else:
                    spans.append([part["start"], part["end"]])
            edges = [0, *[e for s in spans for e in s], len(whole)]
            kept = b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2]))
            found.append({"spans": [{"start": s, "end": e} for s, e in spans], "kept": kept})
        kind = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
        return pa.array(found, kind)

    return cut(F.when(cuts.isNotNull(), text), cuts)


def without_repeats(docs: DataFrame, text_col: str = "text", least: int = LEAST, hot: int = HOT) -> DataFrame:
    """All rows as ``doc`` with ``n_bytes``, ``spans`` (removed, disjoint, in order) and ``kept`` (bytes)."""
    shape = Shape.of(least)
    text = text_of(f"doc.`{text_col}`").cast("binary")
    rows = wrapped(docs).withColumn("text", text)
    keys = {"k": F.xxhash64("text"), "k2": F.xxhash64("text", F.lit(7))}
    texts = rows.select("text").where(F.octet_length("text") >= least).withColumns(keys)
    copies = texts.groupBy("k", "k2").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("size")).where("n > 1")
    whole = copies.select("k", "k2", F.lit(0).cast("long").alias("start"), F.col("size").cast("long").alias("end"))
    cuts = _cuts(texts, shape, hot).unionByName(whole)
    # At most a few for each picked position of a text.
    cuts = materialize(cuts.groupBy("k", "k2").agg(F.collect_set(F.struct("start", "end")).alias("cuts")), "cuts")
    cut = attach(rows.withColumns(keys), cuts, ["k", "k2"], ["k"]).withColumn("cut", _apply(F.col("text"), F.col("cuts")))
    spans = F.coalesce("cut.spans", F.expr("cast(array() AS array<struct<start: bigint, end: bigint>>)"))
    kept = F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.col("cut.kept"))
    return cut.select("doc", F.octet_length("text").cast("long").alias("n_bytes"), spans.alias("spans"), kept.alias("kept"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc.doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), digest)


# Strings at every byte are beyond SQL on whole tables; tests hold the query against brute force.
SQL: dict[str, str] = {}
QUERIES = {"op13_suffix_dedup": op13_suffix_dedup}
