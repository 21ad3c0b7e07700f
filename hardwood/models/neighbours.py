"""Exact k-nearest-neighbour regression by pivots.

The references are assigned to their nearest pivot. Triangle inequality then gives, for
each query, an upper bound on the distance of its k-th neighbour and a lower bound on
the distance to everything near a pivot, so a query only meets pivots whose references
can hold a neighbour. Pivots close to each other form a cell of about a block of rows;
larger cells are cut into blocks by hash, queries likewise. A task sees one block of
references with one block of queries and returns at most k rows per query. No pair is
ever emitted that is not among the k best of its block.

A query travels once to each block it visits, and a block of references once to each
chunk of queries that asks for it. There are ``SIDES`` blocks and chunks, whatever the
number of rows, until a block reaches ``BLOCK_BYTES``; so what is shuffled grows with
the input, and beyond with its square where pivots rule out nothing.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hardwood.operators.balance import attach, profile
from hardwood.session import materialize

# Python functions travel to the executors with their code; nothing is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a block: a share of the rows, between a least number and what a task can hold.
BLOCK = 800
SIDES = 12
BLOCK_BYTES = 64 * 1024 * 1024
SLICE = 256
# Copies of one vector beyond which it is searched for once.
COPIES = 20_000
# Queries and references whose distances are looked at together.
TILE = 1_024, 4_096
# Of squared lengths: what products of doubles can be off by, for vectors of some thousand components.
_SLACK = 1e-12


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, dtype=np.float64) for v in column])


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squared = (points**2).sum(1)[:, None] + (centres**2).sum(1)[None, :] - 2.0 * points @ centres.T
    return np.sqrt(np.maximum(squared, 0.0))


def _visits(away: np.ndarray, bound: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which pivots' references, at ``low`` to ``high`` from them, may be within ``bound``."""
    least = np.maximum(np.maximum(away - high[None, :], low[None, :] - away), 0.0)
    return least <= bound[:, None] * (1 + 1e-9) + 1e-6


def _smallest(kept: np.ndarray, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """``kept`` (rows x k) with the ``values`` of ``rows``, which ascend, taken in."""
    count = np.bincount(rows, minlength=len(kept))
    more = np.full((len(kept), count.max()), np.inf)
    more[rows, np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)] = values
    k = kept.shape[1]
    return np.partition(np.concatenate([kept, more], axis=1), k - 1, axis=1)[:, :k]


def _block_best(q: pd.DataFrame, r: pd.DataFrame, k: int, not_self: bool, centres: np.ndarray, low: np.ndarray, high: np.ndarray) -> pd.DataFrame:
    """The k nearest references of one block for each query, ties by reference id."""
    empty = pd.DataFrame({"qid": [], "rid": [], "dist": [], "y": []}).astype({"qid": "int64", "rid": "int64"})
    if q.empty or r.empty:
        return empty
    r = r.sort_values(["pivot", "rid"], kind="stable")
    vectors, rid, y, pivot = _matrix(r["vec"]), r["rid"].to_numpy(), r["y"].to_numpy(dtype=np.float64), r["pivot"].to_numpy()
    asked, qid, bound = _matrix(q["vec"]), q["qid"].to_numpy(), q["bound"].to_numpy(dtype=np.float64)
    # Squared distance without the query's own square, in one product.
    squares = (vectors**2).sum(1)
    folded = np.concatenate([-2.0 * vectors, squares[:, None]], axis=1)
    here, starts = np.unique(pivot, return_index=True)
    ends = np.append(starts[1:], len(pivot))
    found = []
    for start in range(0, len(qid), TILE[0]):
        part, ids, most = asked[start : start + TILE[0]], qid[start : start + TILE[0]], bound[start : start + TILE[0]]
        own = (part**2).sum(1)
        slack = _SLACK * (own + squares.max())
        visited = _visits(_distances(part, centres[here]), most, low[here], high[here])
        # Squared bound of each query: first the routed one, then the k-th best seen in this block.
        limit = (most * (1 + 1e-9) + 1e-6) ** 2 + slack
        nearest_yet = np.full((len(part), k), np.inf)
        ones = np.concatenate([part, np.ones((len(part), 1))], axis=1)
        seen = []
        for region in np.argsort(-visited.sum(0), kind="stable"):
            at = np.flatnonzero(visited[:, region])
            if not len(at):
                break
            for first in range(starts[region], ends[region], TILE[1]):
                last = min(first + TILE[1], ends[region])
                near = ones[at] @ folded[first:last].T
                close = near <= (limit - own)[at][:, None]
                rows, cols = np.nonzero(close)
                if not_self:
                    other = rid[first + cols] != ids[at[rows]]
                    rows, cols = rows[other], cols[other]
                if len(rows) > 4 * k * len(at):
                    # Too many: only those up to the k-th of this tile.
                    for row in range(0, len(at), SLICE):
                        some = slice(*np.searchsorted(rows, [row, row + SLICE]))
                        full = np.full((len(at[row : row + SLICE]), last - first), np.inf)
                        full[rows[some] - row, cols[some]] = near[rows[some], cols[some]]
                        kth = np.partition(full, min(k, last - first) - 1, axis=1)[:, min(k, last - first) - 1]
                        if last - first >= k:
                            of = at[row : row + SLICE]
                            limit[of] = np.minimum(limit[of], kth + own[of] + 2 * slack[of])
                    few = near[rows, cols] <= (limit - own)[at][rows]
                    rows, cols = rows[few], cols[few]
                if len(rows):
                    squared = near[rows, cols] + own[at[rows]]
                    seen.append((at[rows], first + cols, squared))
                    nearest_yet[at] = _smallest(nearest_yet[at], rows, squared)
                    limit = np.minimum(limit, nearest_yet[:, k - 1] + 2 * slack)
        if not seen:
            continue
        rows, cols, squared = (np.concatenate(x) for x in zip(*seen))
        within = squared <= limit[rows]
        rows, cols = rows[within], cols[within]
        exact = np.sqrt(((part[rows] - vectors[cols]) ** 2).sum(1))
        order = np.lexsort((rid[cols], exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        count = np.bincount(rows, minlength=len(part))
        first_k = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count) < k
        rows, cols, exact = rows[first_k], cols[first_k], exact[first_k]
        found.append(pd.DataFrame({"qid": ids[rows], "rid": rid[cols], "dist": exact, "y": y[cols]}))
    return pd.concat(found) if found else empty


def _cells(centres: np.ndarray, size: np.ndarray, block: int) -> np.ndarray:
    """The cell of every pivot: halves by the two pivots far apart, until a cell has about ``block`` rows."""
    cell = np.zeros(len(size), dtype=np.int64)
    waiting, made = [(np.arange(len(size)), max(1, round(size.sum() / block)))], 0
    while waiting:
        members, parts = waiting.pop()
        if parts == 1 or len(members) == 1:
            cell[members] = made
            made += 1
            continue
        far = members[_distances(centres[members], centres[members[:1]])[:, 0].argmax()]
        end = members[_distances(centres[members], centres[[far]])[:, 0].argmax()]
        away = _distances(centres[members], centres[[far, end]])
        members = members[np.argsort(away[:, 0] - away[:, 1], kind="stable")]
        rows = np.cumsum(size[members])
        cut = int(np.clip(np.searchsorted(rows, rows[-1] * (parts // 2) / parts), 0, len(members) - 2)) + 1
        share = int(np.clip(round(parts * rows[cut - 1] / rows[-1]), 1, parts - 1))
        waiting += [(members[:cut], share), (members[cut:], parts - share)]
    return cell


def nearest(
    queries: DataFrame,
    references: DataFrame,
    k: int = 10,
    not_self: bool = False,
    pivots: int | None = None,
    block: int | None = None,
) -> DataFrame:
    """``(qid, rid, dist, y)``: the k nearest references of every query, ties by ``rid``.

    ``queries(qid long, vec array<double>)``, ``references(rid long, vec, y double)``. With
    ``not_self`` a reference with the query's own id is skipped. A vector with more than
    ``block`` copies (``COPIES`` by default) is searched for only once, and one with more than k + 1 is kept as
    reference only as often as it matters.
    """
    if _most_copies(references) > k + 1:
        # Of equal vectors the k + 1 smallest ids are all that can be among k others.
        rank = F.dense_rank().over(Window.partitionBy(F.xxhash64("vec"), "vec").orderBy("rid"))
        references = references.withColumn("_copy", rank).where(F.col("_copy") <= k + 1).drop("_copy")
    if _most_copies(queries) <= (block or COPIES):
        return _search(queries, references, k, not_self, pivots, block)
    vectors = materialize(queries.groupBy("vec").agg(F.min("qid").alias("qid")), "vectors")
    found = _search(vectors, references, k + 1, False, pivots, block)
    # At most k + 1 rows per vector.
    lists = found.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("dist", "rid", "y"))).alias("near"))
    known = materialize(vectors.join(lists, "qid").select("vec", "near"), "near")
    near = F.col("near")
    if not_self:
        near = F.filter(near, lambda n: n["rid"] != F.col("qid"))
    joined = attach(queries.select("qid", "vec"), known, ["vec"], ["qid"], "inner")
    return joined.select("qid", F.inline(F.slice(near, 1, k))).select("qid", "rid", "dist", "y")


def _most_copies(df: DataFrame) -> int:
    return profile(df.select(F.xxhash64("vec").alias("h")), ["h"]).largest


def _search(
    queries: DataFrame, references: DataFrame, k: int, not_self: bool, pivots: int | None, block: int | None
) -> DataFrame:
    n_refs = references.count()
    wanted = pivots or min(256, max(1, int(math.sqrt(n_refs) / 4)))
    # A bounded number of vectors reaches the driver: at most ``wanted``.
    chosen = references.select("vec").orderBy(F.xxhash64("rid"), "rid").limit(wanted).collect()
    if not chosen:
        return queries.sparkSession.createDataFrame([], "qid long, rid long, dist double, y double")
    centres = np.array([np.asarray(row["vec"], dtype=np.float64) for row in chosen])

    width = 8 * max(1, centres.shape[1])

    def rows_of_block(n: int) -> int:
        return block or min(max(BLOCK, -(-n // SIDES)), max(1, BLOCK_BYTES // width))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                away = _distances(_matrix(batch["vec"]), centres)
                batch["pivot"] = away.argmin(1).astype("int32")
                batch["ring"] = away.min(1)
                yield batch

    assigned = references.select("rid", "vec", "y").mapInPandas(
        assign, "rid long, vec array<double>, y double, pivot int, ring double"
    )
    cells = materialize(assigned, "cells")
    # Per pivot: size, ring limits and the k + 1 smallest rings of different ids; a few rows per pivot.
    stats = cells.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("ring").alias("lo"), F.max("ring").alias("hi")).collect()
    single = cells.groupBy("rid").agg(F.min(F.struct("pivot", "ring")).alias("at")).select("at.*")
    ranked = single.select("pivot", "ring", F.row_number().over(Window.partitionBy("pivot").orderBy("ring")).alias("i"))
    inner = ranked.where(F.col("i") <= k + 1).select("pivot", "ring").collect()
    used = np.array([s["pivot"] for s in stats])
    size = np.array([s["n"] for s in stats])
    low, high = np.full(len(centres), np.inf), np.full(len(centres), -np.inf)
    low[used], high[used] = [s["lo"] for s in stats], [s["hi"] for s in stats]
    rows = rows_of_block(n_refs)
    groups = _cells(centres[used], size, rows)
    slots = np.maximum(1, np.round(np.bincount(groups, size) / rows)).astype("int64")
    cell_of = np.full(len(centres), -1)
    cell_of[used] = groups
    # Columns of the pivots, ordered by cell.
    by_cell = used[np.argsort(groups, kind="stable")]
    cell_starts = np.flatnonzero(np.diff(np.sort(groups), prepend=-1))
    ring_pivot = np.array([r["pivot"] for r in inner])
    ring_dist = np.array([r["ring"] for r in inner])

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The cell of the nearest pivot, the cells to visit, and the bound of the k-th distance."""
        for whole in batches:
            for start in range(0, len(whole), SLICE * 4):
                batch = whole.iloc[start : start + SLICE * 4]
                away = _distances(_matrix(batch["vec"]), centres)
                bound = np.full(len(batch), np.inf)
                if len(ring_pivot) > k:
                    bound = np.partition(away[:, ring_pivot] + ring_dist[None, :], k, axis=1)[:, k]
                meets = np.logical_or.reduceat(_visits(away[:, by_cell], bound, low[by_cell], high[by_cell]), cell_starts, axis=1)
                at_home = cell_of[used[away[:, used].argmin(1)]].astype("int32")
                yield batch.assign(home=at_home, cells=[np.flatnonzero(m).astype("int32") for m in meets], bound=bound)

    # Queries near one cell visit the same few cells, so they are cut into blocks by cell.
    at_home = queries.select("qid", "vec").mapInPandas(home, "qid long, vec array<double>, home int, cells array<int>, bound double")
    at_home = materialize(at_home, "queries")
    homes = at_home.groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()
    if not homes:
        return queries.sparkSession.createDataFrame([], "qid long, rid long, dist double, y double")
    chunk_rows = rows_of_block(sum(r["n"] for r in homes))
    n_parts = _lookup({r["home"]: max(1, round(r["n"] / chunk_rows)) for r in homes}, "home")
    chunk = F.concat_ws("-", "home", F.pmod(F.xxhash64("qid", F.lit(1)), n_parts))
    routed = at_home.select("qid", "vec", "bound", chunk.alias("chunk"), F.explode("cells").alias("cell"))
    n_slots = _lookup(dict(enumerate(slots)), "cell")
    # A cell of several blocks is visited block by block.
    routed = routed.withColumn("slot", F.explode(F.sequence(F.lit(0), (n_slots - 1).cast("int"))))
    # References move by cell; pivots tell the parts of a block that a query may leave out.
    placed = F.element_at(F.array(*[F.lit(int(c)) for c in cell_of]), F.col("pivot") + 1)
    blocks = cells.drop("ring").withColumn("cell", placed)
    blocks = blocks.withColumn("slot", F.pmod(F.xxhash64("rid", F.lit(2)), n_slots).cast("int"))
    # A block of references goes to the chunks that ask for it, and to no other.
    blocks = blocks.join(materialize(asked_blocks(routed), "asked"), ["cell", "slot"])
    keys = ["cell", "slot", "chunk"]
    best = (
        routed.groupBy(*keys)
        .cogroup(blocks.groupBy(*keys))
        .applyInPandas(lambda q, r: _block_best(q, r, k, not_self, centres, low, high), "qid long, rid long, dist double, y double")
    )
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("dist", "rid"))
    return best.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def _lookup(values: dict, key: str) -> Column:
    return F.element_at(F.create_map(*[F.lit(int(x)) for pair in values.items() for x in pair]), F.col(key))


def asked_blocks(routed: DataFrame) -> DataFrame:
    """``(cell, slot, chunk)``: the blocks of references that some query of a chunk visits."""
    return routed.select("cell", "slot", "chunk").distinct()


def knn_regression(queries: DataFrame, references: DataFrame, k: int = 10, **options) -> DataFrame:
    """``(qid, n_neighbours, y_pred)``: mean target of the k nearest references."""
    return nearest(queries, references, k, **options).groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_neighbours"), F.avg("y").alias("y_pred")
    )
