"""Near duplicates by bottom-k sketches from one hash function.

Each text is the set of its hashed word shingles; the ``SKETCH`` smallest values are its sketch.

1. Texts with equal sets form a class and go on as one representative.
2. Inverted lists of the ``LISTED`` smallest values generate overlaps. A list of at most ``LIST`` members
   yields its pairs. Longer lists belong to text that many documents share. A representative with
   too few values in short lists is listed again by its ``DEEPER`` smallest values
   among its like: that finds documents that hold a common passage beside text of their own. (With as
   many values as :func:`enough` asks for, the chance that none is shared with a linked document is below ``MISSED``. A
   set that is listed whole needs so many that one is in the list of every linked document, however long.)
3. What has too few such values even then consists of common text. It is grouped by pairs of minima of
   the whole sets under other hashes (a pair at 0.80 agrees in none with a chance of 6e-7). Large groups compare all members with their most central one. Members that link to
   it are in one component and are not compared with each other; all that remains is compared in
   blocks of bounded size on the full sets: the unlinked with each other, and those of them that are
   close enough to the centre with its linked members. A block returns a spanning forest of its links.
4. The sketch of the union estimates the similarity and drops pairs more than ``MARGIN`` below the
   threshold (five standard deviations).
5. Pairs are confirmed on the full sets, likely ones first; a pair within a component found so far
   cannot change it and is left out.

No link between different components is lost but by the chances stated. Only representatives travel,
so a class of copies costs one row, and no list is expanded beyond ``LIST`` squared.

Texts without a word (null, empty, white space) link with nothing; fewer words than a shingle count as one
shingle. A text of any length is one set of hashes, read whole. The first of a component is its smallest id (null ids last, of
equal ids one row). Pairs at exactly the threshold link. Empty tables give empty results. Other columns are carried along.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.llm.common import prepared, table, text_of, unwrapped, wrapped
from hardwood.llm.components import components
from hardwood.operators.balance import attach, within_limit
from hardwood.session import materialize

SKETCH, LISTED, DEEPER, LIST = 48, 12, 64, 64
MISSED = 1e-6
BANDS, BLOCK = 14, 512
MARGIN = 30  # hundredths


@dataclass(frozen=True)
class Near:
    """Words per shingle, and the similarity of linked sets in hundredths."""

    words: int = 5
    percent: int = 80


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes, words: int, known: dict[bytes, int]) -> np.ndarray:
    """The sorted set of hashed shingles; ``known`` keeps the hashes of words between texts."""
    found = text.lower().split()
    if not found:
        return np.empty(0, dtype=np.int64)
    hashes = np.empty(len(found), dtype=np.uint64)
    for i, word in enumerate(found):
        h = known.get(word)
        if h is None:
            h = known[word] = xxhash.xxh3_64_intdigest(word)
        hashes[i] = h
    width = min(words, len(found))
    n = len(found) - width + 1
    value = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        value = _mixed(value * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return np.unique(value.view(np.int64))


def _sketched(rows: DataFrame, words: int) -> DataFrame:
    """``(row, size, h1, h2, sketch, listed)`` from ``(row, text)``; equal sets have equal ``size, h1, h2``.

    The sketch holds the upper halves of its values, which keep their order; lists need whole values.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[bytes, int] = {}
            size, h1, h2, low, listed = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                values = shingle_set(text, words, known)
                digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                size.append(len(values))
                h1.append(int.from_bytes(digest[:8], "little", signed=True))
                h2.append(int.from_bytes(digest[8:], "little", signed=True))
                low.append((values[:SKETCH] >> 32).astype(np.int32))
                listed.append(values[:LISTED])
            numbers = [pa.array(c, pa.int64()) for c in (size, h1, h2)]
            lists = [pa.array(low, pa.list_(pa.int32())), pa.array(listed, pa.list_(pa.int64()))]
            names = ["row", "size", "h1", "h2", "sketch", "listed"]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *numbers, *lists], names)

    return rows.mapInArrow(sketch, "row long, size long, h1 long, h2 long, sketch array<int>, listed array<long>")


def _full_sets(rows: DataFrame, words: int) -> DataFrame:
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[bytes, int] = {}
            sets = [shingle_set(text, words, known) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sets, pa.list_(pa.int64()))], ["row", "shingles"])

    return rows.mapInArrow(full, "row long, shingles array<long>")


def _side(df: DataFrame, name: str, key: list[str], more: tuple[str, ...] = ()) -> DataFrame:
    """``rep, size, sketch`` and more as one side of a self-join."""
    return df.select(*key, *[F.col(c).alias(f"{c}_{name}") for c in ("rep", "size", "sketch", *more)])


def _estimated(joined: DataFrame, percent: int) -> DataFrame:
    """``joined`` with ``estimate``, where sizes and the union's sketch allow ``percent`` hundredths.

    The estimate is the share of the union's smallest values that both sets have.
    """
    small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    shared = F.array_intersect("sketch_a", "sketch_b")
    floor = (percent - MARGIN) / 100
    # The union's sketch is no shorter than the longer set, up to its length.
    possible = (100 * small >= percent * large) & (F.size(shared) >= floor * F.least(large, F.lit(SKETCH)))
    taken = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, SKETCH)
    estimate = F.when(possible, F.size(F.array_intersect(taken, shared)) / F.size(taken))
    return joined.withColumn("estimate", estimate).where(F.col("estimate") >= floor)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b"), "estimate")


def _within(members: DataFrame, key: list[str], percent: int) -> DataFrame:
    """Close pairs of each group; only for groups of bounded size."""
    left, right = _side(members, "a", key), _side(members, "b", key)
    return _pairs(_estimated(left.join(right, key).where(F.col("rep_a") < F.col("rep_b")), percent))


def _sized(members: DataFrame, key: list[str]) -> DataFrame:
    """``members`` of groups of at least two, with the group's size ``n``."""
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return members.join(sizes, key)


def forest(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """A spanning forest of the links between the two sides of a block, or within its one side."""
    frame = frame.sort_values(["side", "rep"], kind="stable")
    sets = [np.asarray(v, dtype=np.int64) for v in frame["shingles"]]
    side, rep = frame["side"].to_numpy(), frame["rep"].to_numpy()
    size = np.array([len(v) for v in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), size)
    often = times[column] > 1  # what one set alone has is in no intersection
    owner, column = owner[often], column[often]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        low, high = np.searchsorted(column, [start, start + 2048])
        part = np.zeros((len(sets), 2048), dtype=np.float32)
        part[owner[low:high], column[low:high] - start] = 1.0
        common += part @ part.T
    linked = 100.0 * common >= percent * (size[:, None] + size[None, :] - common)
    if side.min() != side.max():
        linked &= side[:, None] != side[None, :]
    links, seen = [], np.zeros(len(sets), dtype=bool)
    for root in range(len(sets)):
        waiting = [] if seen[root] else [root]
        seen[root] = True
        while waiting:
            new = np.flatnonzero(linked[waiting.pop()] & ~seen)
            seen[new] = True
            waiting.extend(new.tolist())
            links.extend((rep[root], rep[i]) for i in new)
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _neighbourhoods(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` of large groups, given as ``(g, rep, size, sketch, weight)``: enough to join all that link."""
    heaviest = members.groupBy("g").agg(F.max("weight").alias("weight"))
    centre = members.join(heaviest, ["g", "weight"]).groupBy("g").agg(F.min("rep").alias("rep"))
    centre = materialize(members.join(centre, ["g", "rep"], "left_semi"), "centres")
    other = members.select("g", *[F.col(c).alias(f"{c}_b") for c in ("rep", "size", "sketch")])
    # Two links in a row cannot lead further from the centre than this.
    close = _estimated(other.join(_side(centre, "a", ["g"]), "g"), 2 * percent - 100)
    close = close.where(F.col("rep_a") != F.col("rep_b")).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    met = _compared(close, sets).where(_reaches(2 * percent - 100))
    met = materialize(met.select("a", "b", _reaches(percent).alias("linked")), "met")
    named = centre.select("g", F.col("rep").alias("a"))
    state = members.select("g", F.col("rep").alias("b")).join(named, "g").where(F.col("a") != F.col("b")).join(met, ["a", "b"], "left")
    # Unlinked, of these close to the centre, and linked.
    state = state.select("g", F.col("b").alias("rep"), F.coalesce("linked", F.lit(False)).alias("linked"), F.col("linked").isNotNull().alias("near"))
    loose, near = ~F.col("linked"), ~F.col("linked") & F.col("near")
    parts = lambda rows: F.greatest(F.lit(1), F.ceil(F.sum(rows.cast("int")) / F.lit(BLOCK)).cast("int"))
    counts = state.groupBy("g").agg(parts(loose).alias("n_loose"), parts(near).alias("n_near"), parts(F.col("linked")).alias("n_linked"))
    state = materialize(state.join(counts, "g"), "state")
    own = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def sent(rows: DataFrame, what: int, mine: str, others: str, side: int) -> DataFrame:
        return rows.select("g", "rep", F.lit(what).alias("what"), own(mine).alias("m"), each(others).alias("o"), F.lit(side).alias("side"))

    among = sent(state.where(loose), 0, "n_loose", "n_loose", 0)
    swap = F.col("m") > F.col("o")
    among = among.select("g", "rep", "what", F.least("m", "o").alias("i"), F.greatest("m", "o").alias("j"), swap.cast("int").alias("side"))
    asking = sent(state.where(near), 1, "n_near", "n_linked", 0).withColumnsRenamed({"m": "i", "o": "j"})
    asked = sent(state.where("linked"), 1, "n_linked", "n_near", 1).withColumnsRenamed({"m": "j", "o": "i"})
    blocks = among.unionByName(asking).unionByName(asked).join(sets.withColumnRenamed("row", "rep"), "rep")
    found = blocks.groupBy("g", "what", "i", "j").applyInPandas(lambda frame: forest(frame, percent), "a long, b long")
    return materialize(met.where("linked").select("a", "b").union(found).distinct(), "sure")


def enough(listed: int, percent: int) -> int:
    """Of ``listed`` random values, so many that all being in one set of a linked pair only is rarer than ``MISSED``."""
    alone = 1 - percent / 100
    tail, least = 0.0, listed + 1
    while least > 1:
        tail += math.comb(listed, least - 1) * alone ** (least - 1) * (1 - alone) ** (listed - least + 1)
        if tail > MISSED:
            break
        least -= 1
    return least


def _listed(reps: DataFrame, values: Column, listed: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Close pairs from the short inverted lists of ``values``, at most ``listed`` of a set, and the representatives with too few of them."""
    posted = reps.select("rep", "size", F.size(values).alias("values"), F.explode(values).alias("v"))
    lists = posted.groupBy("v").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = materialize(posted.join(lists, "v"), "shared")
    with_sketch = shared.where(F.col("n") <= LIST).select("v", "rep").join(reps.select("rep", "size", "sketch"), "rep")
    pairs = _within(with_sketch, ["v"], percent)
    heavy = shared.where(F.col("n") > LIST).groupBy("rep").agg(
        F.count(F.lit(1)).alias("heavy"), F.sum("n").alias("weight"), F.first("size").alias("of"), F.first("values").alias("values")
    )
    # Of a whole set, at most so many values are not in a linked one, and so many beyond the end of its list.
    absent = F.floor(F.col("of") * F.lit((100 - percent) / 100) + F.lit(1e-9))
    beyond = F.greatest(F.floor(F.col("of") * F.lit(100 / percent) + F.lit(1e-9)) - listed, F.lit(0))
    whole = absent + beyond + 1
    table = F.array(*[F.lit(enough(n, percent)) for n in range(1, DEEPER + 1)])
    needed = F.when(F.col("values") == F.col("of"), whole).otherwise(F.element_at(table, F.col("values")))
    few = heavy.where(F.col("values") - F.col("heavy") < needed).select("rep", "weight")
    return pairs, materialize(few, "few")


def _candidates(reps: DataFrame, sets_for: Callable, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """``(a, b, estimate)`` of close representatives, and the links of large groups."""
    pairs, few = _listed(reps, F.col("listed"), LISTED, percent)
    if few.isEmpty():
        return pairs, None
    sets = sets_for(few.select(F.col("rep").alias("row"))).withColumnRenamed("row", "rep")
    again = materialize(reps.select("rep", "size", "sketch").join(sets, "rep"), "again")
    more, common = _listed(again, F.slice("shingles", 1, DEEPER), DEEPER, percent)
    pairs = pairs.unionByName(more)
    if common.isEmpty():
        return pairs, None

    def least(seed: int) -> Column:
        # Over the whole set: minima over a sketch agree less often than the sets do.
        return F.array_min(F.transform("shingles", lambda x: F.xxhash64(x, F.lit(seed))))

    keys = F.array(*[F.xxhash64(F.lit(j), least(2 * j), least(2 * j + 1)) for j in range(BANDS)])
    found = again.join(common, "rep").select("rep", "size", "sketch", "weight", F.explode(keys).alias("g"))
    grouped = materialize(_sized(found, ["g"]), "bands")
    pairs = pairs.unionByName(_within(grouped.where(F.col("n") <= LIST), ["g"], percent))
    large = grouped.where(F.col("n") > LIST).drop("n")
    if large.isEmpty():
        return pairs, None
    return pairs, _neighbourhoods(large, sets.withColumnRenamed("rep", "row"), percent)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` with the sizes of both full sets and of what they have in common."""
    left = sets.select(F.col("row").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("row").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.select("a", "b", common.alias("common"), F.size("of_a").alias("n_a"), F.size("of_b").alias("n_b"))


def _reaches(percent: int) -> Column:
    return 100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    return _compared(pairs, sets).where(_reaches(percent)).select("a", "b")


def _crossing(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs of different components."""
    for side in ("a", "b"):
        named = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        pairs = pairs.join(named, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs.where(F.col("root_a") != F.col("root_b"))


def _linked(reps: DataFrame, rows: DataFrame, text_col: str, near: Near) -> DataFrame:
    """``(node, root)`` of the representatives that link with another."""

    def sets_for(ids: DataFrame) -> DataFrame:
        ids = materialize(ids.distinct(), "wanted")
        small = F.broadcast(ids) if within_limit(ids) else ids
        texts = rows.join(small, "row", "left_semi").select("row", text_of(f"doc.`{text_col}`").cast("binary").alias("text"))
        return materialize(_full_sets(texts, near.words), "sets")

    pairs, sure = _candidates(reps, sets_for, near.percent)
    pairs = materialize(pairs.groupBy("a", "b").agg(F.max("estimate").alias("estimate")), "pairs")
    sets = sets_for(pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))))
    # First the partner most alike, and the first partner that is likely to be linked.
    ends = pairs.union(pairs.select("b", "a", "estimate")).toDF("x", "y", "estimate")
    best = ends.groupBy("x").agg(
        F.min_by("y", F.struct(-F.col("estimate"), F.col("y"))).alias("likely"),
        F.min(F.when(F.col("estimate") >= near.percent / 100, F.col("y"))).alias("first"),
    )
    first = best.select("x", F.explode(F.array_distinct(F.array("likely", "first"))).alias("y")).where("y IS NOT NULL")
    first = first.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    links = _confirmed(first, sets, near.percent)
    links = materialize(links.union(sure) if sure is not None else links, "confirmed")
    roots = materialize(components(links), "roots")
    rest = materialize(_crossing(pairs, roots).select("a", "b").join(first, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = materialize(links.union(_confirmed(rest, sets, near.percent)), "confirmed")
        roots = materialize(components(links), "roots")
    return roots


def _labelled(docs: DataFrame, id_col: str, text_col: str, near: Near) -> tuple[DataFrame, DataFrame]:
    """The stored rows ``(row, doc)``, and ``(row, id, size, component_id, keep_row)`` for all of them."""
    prepared(docs.sparkSession)
    rows = materialize(wrapped(docs).withColumn("row", F.monotonically_increasing_id()), "documents")
    texts = rows.select("row", text_of(f"doc.`{text_col}`").cast("binary").alias("text"))
    sketches = materialize(_sketched(texts, near.words), "sketches")
    same = ["size", "h1", "h2"]
    with_words = sketches.where(F.col("size") > 0)
    classes = with_words.groupBy(*same).agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = materialize(classes.where(F.col("n") > 1).drop("n"), "classes")
    named = attach(sketches.select("row", *same), classes, same, ["row"])
    members = materialize(named.select("row", "size", F.coalesce("rep", "row").alias("rep")), "members")
    copies = members.where(F.col("row") != F.col("rep")).select("row")
    reps = with_words.join(copies, "row", "left_anti").select(F.col("row").alias("rep"), "size", "sketch", "listed")
    roots = _linked(reps, rows, text_col, near)
    ids = rows.select("row", F.col(f"doc.`{id_col}`").alias("id"))
    known = members.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").join(ids, "row")
    known = materialize(known.select("row", "id", "size", F.coalesce("root", "rep").alias("root")), "labelled")
    groups = known.groupBy("root").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    groups = materialize(groups.where(F.col("n") > 1).drop("n"), "groups")
    grouped = attach(known, groups.withColumn("_grouped", F.lit(True)), ["root"], ["row"])
    # Of equal smallest ids, the first row is kept.
    heads = grouped.where(F.col("_grouped") & F.col("id").eqNullSafe(F.col("component_id")))
    heads = materialize(heads.groupBy("root").agg(F.min("row").alias("keep_row")), "heads")
    whole = attach(grouped, heads, ["root"], ["row"])
    component = F.when(F.col("_grouped"), F.col("component_id")).otherwise(F.col("id"))
    return rows, whole.select("row", "id", "size", component.alias("component_id"), F.coalesce("keep_row", "row").alias("keep_row"))


def near_duplicates(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, component_id, kept)``, one row per document."""
    _, whole = _labelled(docs, id_col, text_col, near)
    return whole.select("id", "size", "component_id", (F.col("row") == F.col("keep_row")).alias("kept"))


def one_of_each(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first document of every component, with its columns."""
    rows, whole = _labelled(docs, id_col, text_col, near)
    dropped = materialize(whole.where(F.col("row") != F.col("keep_row")).select("row"), "dropped")
    small = F.broadcast(dropped) if within_limit(dropped) else dropped
    return unwrapped(rows.join(small, "row", "left_anti"))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, Near(words=3, percent=85))
    return found.select(
        F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), "component_id", "kept"
    )


SQL: dict[str, str] = {}
QUERIES = {"op6_near_dedup": op6_near_dedup}
