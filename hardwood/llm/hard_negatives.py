"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction (spherical k-means on at most ``CLUSTERS`` centres). For a cluster with centre c
whose members lie within the angle t of it, no member u has a larger inner product with a row i than
``|u| * |i| * cos(max(0, angle(i, c) - t))``. The last two factors do not depend on the member, so all rows are
sorted by them once for each cluster, and every member walks that list from the top until the bound falls below
what it still needs: then no row further down can matter, and its result is certified.

A list is cut into levels, each ``GROWTH`` times the length of the one before. A round deals a level's rows to blocks of at most
about ``BLOCK_ROWS`` rows, each with at most ``BLOCK_ANCHORS`` members of the cluster that are not certified yet; a task walks
its block in strides, and rounds end when all members are certified. Anchors walk the list twice: once for the
positives, once for every positive's negatives. Bounds only save work; where vectors point everywhere, as random ones do,
they save little, and the walk is a comparison in blocks.

Rows with a null id, label or vector or a null or non-finite component take no part. Of rows that share an id the
one with the least label counts, then the least vector. Shorter vectors are filled with zeros; an empty vector
scores 0 with everything. Ties go to the smaller id. A table without anchors, or an empty one, gives an empty
result; an anchor without other rows of its label has no positives and no result. Scores are exact inner
products of integers; vectors so long that a product may pass 2^53 are an error. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hardwood.llm.common import prepared, table
from hardwood.operators.balance import within_limit
from hardwood.session import materialize

CLUSTERS, ROUNDS = 16, 3
BLOCK_ANCHORS, BLOCK_ROWS, STRIDE = 512, 8_192, 1_024
# Rows of a list's first level, and how much longer every next level is.
FIRST_LEVEL, GROWTH = 16_384, 4
# For rounding in angles; bounds are raised, never lowered.
SLACK = 1e-6

_ROW = "id long, label long, v array<long>, norm double"
_ASK = "anchor long, positive long, label long, v array<long>, norm double, cluster int, block int, low double, high double, need double"


def _matrix(column: pd.Series, width: int = 0) -> np.ndarray:
    """One row per vector, filled with zeros."""
    width = max([width, *map(len, column)], default=0)
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _angles(vectors: np.ndarray, norms: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of every vector to every centre of length one; 0 for a vector of zeros."""
    size = max(vectors.shape[1], centres.shape[1])
    cosine = np.pad(vectors, ((0, 0), (0, size - vectors.shape[1]))) @ np.pad(centres, ((0, 0), (0, size - centres.shape[1]))).T
    cosine = np.divide(cosine, norms[:, None], out=np.ones_like(cosine, dtype=np.float64), where=norms[:, None] > 0)
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _products(asked: np.ndarray, rows: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products, none larger than ``most``."""
    if most >= 2**53:
        raise OverflowError("an inner product may pass 2^53; take a smaller scale")
    return asked.astype(np.float64) @ rows.astype(np.float64).T


@dataclass(frozen=True)
class Model:
    """At most ``CLUSTERS`` centres, the widest angle and the number of members of each, and the cuts of its list."""

    centres: np.ndarray
    reach: np.ndarray
    members: np.ndarray
    cuts: np.ndarray


def integer_vectors(df: DataFrame, id_col: str, label: Column, vector_col: str, scale: int = 256) -> DataFrame:
    """``(id, label, v, norm)``: the rows that take part, one for each id."""
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = df.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & vector.isNotNull() & finite)
    rows = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.struct(label.cast("long").alias("label"), whole.alias("v")).alias("row"))
    rows = rows.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.v")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return materialize(rows.withColumn("norm", F.sqrt(square)), "vectors")


def _centres(anchors: DataFrame, clusters: int) -> np.ndarray:
    """Centres of length one; at most ``clusters`` vectors reach the driver in a round."""
    seeds = anchors.where("norm > 0").orderBy(F.xxhash64("id"), "id").limit(clusters).select("v", "norm").toPandas()
    if seeds.empty:
        return np.zeros((1, 1))
    centres = _matrix(seeds["v"]) / seeds["norm"].to_numpy()[:, None]
    for _ in range(ROUNDS):
        known = centres

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((len(known), 0))
            for batch in batches:
                vectors, norms = _matrix(batch["v"], total.shape[1]), batch["norm"].to_numpy(np.float64)
                nearest = _angles(vectors, norms, known).argmin(1)
                total = np.pad(total, ((0, 0), (0, vectors.shape[1] - total.shape[1])))
                np.add.at(total, nearest, vectors / np.maximum(norms, 1e-300)[:, None])
            cluster, place = np.indices(total.shape)
            yield pd.DataFrame({"cluster": cluster.ravel(), "place": place.ravel(), "x": total.ravel()})

        found = anchors.select("v", "norm").mapInPandas(sums, "cluster int, place int, x double")
        found = found.groupBy("cluster", "place").agg(F.sum("x").alias("x")).toPandas()
        moved = np.zeros((len(centres), max(centres.shape[1], found["place"].max() + 1 if len(found) else 0)))
        moved[found["cluster"], found["place"]] = found["x"]
        length = np.sqrt((moved**2).sum(1))
        centres = moved[length > 0] / length[length > 0][:, None]
    return centres


def _assigned(anchors: DataFrame, centres: np.ndarray) -> DataFrame:
    """Anchors with ``cluster`` and ``away``, their angle to its centre."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                angles = _angles(_matrix(batch["v"]), batch["norm"].to_numpy(np.float64), centres)
                yield batch.assign(cluster=angles.argmin(1).astype("int32"), away=np.where(batch["norm"] > 0, angles.min(1), 0.0))

    return materialize(anchors.mapInPandas(assign, f"{_ROW}, cluster int, away double"), "anchors")


def _listed(rows: DataFrame, centres: np.ndarray, reach: np.ndarray) -> DataFrame:
    """Rows with ``bounds``: for every cluster, what no member's inner product passes, divided by the member's length."""

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                norms = batch["norm"].to_numpy(np.float64)
                angles = _angles(_matrix(batch["v"]), norms, centres)
                least = np.maximum(0.0, angles - reach[None, :] - SLACK)
                yield batch.assign(bounds=list(norms[:, None] * (np.cos(least) + SLACK)))

    return materialize(rows.mapInPandas(bound, f"{_ROW}, bounds array<double>"), "lists")


def _cuts(listed: DataFrame, n_rows: int, clusters: int) -> np.ndarray:
    """For every cluster, the falling bounds at which its list is cut into levels."""
    shares, length = [], FIRST_LEVEL
    while length < n_rows:
        shares.append(1.0 - length / n_rows)
        length += FIRST_LEVEL * GROWTH ** len(shares)
    if not shares:
        return np.zeros((clusters, 0))
    each = [F.percentile_approx(F.col("bounds")[c], shares).alias(f"c{c}") for c in range(clusters)]
    return np.array([list(v) for v in listed.agg(*each).first()])


def _walk_block(asks: pd.DataFrame, rows: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
    """The ``k`` best of a block's rows for each ask, walking down by ``bound`` until all are certified."""
    empty = pd.DataFrame({"anchor": [], "positive": [], "id": [], "score": []}).astype("int64")
    if asks.empty or rows.empty:
        return empty
    rows = rows.sort_values("bound", ascending=False, kind="stable")
    width = max(map(len, [*asks["v"], *rows["v"]]))
    ids, labels = rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
    bounds, vectors = rows["bound"].to_numpy(np.float64), _matrix(rows["v"], width)
    # Several asks may come from one anchor.
    anchors, at = np.unique(asks["anchor"].to_numpy(np.int64), return_index=True)
    asked, of = _matrix(asks["v"].iloc[at], width), np.searchsorted(anchors, asks["anchor"].to_numpy(np.int64))
    own, norms = asks["label"].to_numpy(np.int64), asks["norm"].to_numpy(np.float64)
    low, high = asks["low"].to_numpy(np.float64), asks["high"].to_numpy(np.float64)
    need = asks["need"].to_numpy(np.float64).copy()
    most = float(norms.max()) * float(rows["norm"].max()) * (1 + SLACK)
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(asks)
    for start in range(0, len(ids), STRIDE):
        open_ = np.flatnonzero(norms * bounds[start] + 1.0 >= need)
        if not len(open_):
            break
        part = slice(start, start + STRIDE)
        used, where = np.unique(of[open_], return_inverse=True)
        scores = _products(asked[used], vectors[part], most)
        for ask, line in zip(open_, scores[where]):
            mine = labels[part] == own[ask] if same else labels[part] != own[ask]
            fits = np.flatnonzero(mine & (line >= max(need[ask], low[ask])) & (line <= high[ask]) & (ids[part] != anchors[of[ask]]))
            if len(fits):
                score = np.concatenate([best[ask][0], line[fits].astype(np.int64)])
                found = np.concatenate([best[ask][1], ids[part][fits]])
                order = np.lexsort((found, -score))[:k]
                best[ask] = score[order], found[order]
                if len(order) == k:
                    need[ask] = max(need[ask], score[order[-1]])
    each = [len(s) for s, _ in best]
    if not sum(each):
        return empty
    out = {c: np.repeat(asks[c].to_numpy(np.int64), each) for c in ("anchor", "positive")}
    return pd.DataFrame(out | {"id": np.concatenate([i for _, i in best]), "score": np.concatenate([s for s, _ in best])})


def _walk(asks: DataFrame, listed: DataFrame, model: Model, k: int, same: bool) -> DataFrame:
    """``(anchor, positive, id, score)``: for each of ``asks`` the ``k`` best rows from ``low`` to ``high``."""
    spark = asks.sparkSession
    found = spark.createDataFrame([], "anchor long, positive long, id long, score long")
    ask = ["anchor", "positive"]
    n_levels = model.cuts.shape[1] + 1
    edges = np.concatenate([np.full((len(model.cuts), 1), np.inf), model.cuts, np.full((len(model.cuts), 1), -np.inf)], axis=1)
    for level in range(n_levels):
        above, below = edges[:, level], edges[:, level + 1]
        if level:
            # Certified: nothing from here on reaches what is needed. One row out for each cluster.
            top = F.element_at(F.array(*[F.lit(float(a)) for a in above]), F.col("cluster") + 1)
            asks = asks.where(F.col("norm") * top + 1.0 >= F.col("need"))
        asks = materialize(asks, "asks")
        blocks = {r["cluster"]: r["blocks"] for r in asks.groupBy("cluster").agg((F.max("block") + 1).alias("blocks")).collect()}
        if not blocks:
            break
        # A row goes to the blocks of the clusters in whose list it stands at this level.
        inside = [
            F.when((F.col("bounds")[c] < F.lit(float(above[c]))) & (F.col("bounds")[c] >= F.lit(float(below[c]))),
                   F.struct(F.lit(c).alias("cluster"), F.col("bounds")[c].alias("bound"), F.lit(n).alias("blocks")))
            for c, n in sorted(blocks.items())
        ]
        placed = listed.select("id", "label", "v", "norm", F.explode(F.filter(F.array(*inside), lambda s: s.isNotNull())).alias("at"))
        counts = {r["cluster"]: r["n"] for r in placed.groupBy(F.col("at.cluster").alias("cluster")).agg(F.count(F.lit(1)).alias("n")).collect()}
        slots = F.element_at(F.array(*[F.lit(math.ceil(counts.get(c, 0) / BLOCK_ROWS)) for c in range(len(above))]), F.col("cluster") + 1)
        rows = placed.select("id", "label", "v", "norm", "at.*", F.explode(F.sequence(F.lit(0), F.col("at.blocks") - 1)).alias("block"))
        rows = rows.withColumn("slot", F.pmod(F.xxhash64("id"), slots).cast("int")).drop("blocks")
        asking = asks.where(slots > 0).withColumn("slot", F.explode(F.sequence(F.lit(0), slots - 1)))
        keys = ["cluster", "block", "slot"]
        best = asking.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(
            lambda a, r: _walk_block(a, r, k, same), "anchor long, positive long, id long, score long"
        )
        order = Window.partitionBy(*ask).orderBy(F.col("score").desc(), "id")
        every = found.unionByName(best).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        found = materialize(every.drop("place"), "found")
        # With k found, only rows as good as the last of them are needed.
        last = found.groupBy(*ask).agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("last"))
        known = asks.join(last, ask, "left")
        full = (F.col("n") >= k) & (F.col("last") > F.col("need"))
        asks = known.withColumn("need", F.when(full, F.col("last")).otherwise(F.col("need"))).drop("n", "last")
    return found


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10,
    lower: int = 30, upper: int = 90, clusters: int = CLUSTERS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` as made by :func:`integer_vectors`; ``anchors`` are some of them. A negative's score lies between
    ``lower`` and ``upper`` percent of the positive's.
    """
    n_anchors, n_rows = anchors.count(), rows.count()
    wanted = min(clusters, max(1, math.isqrt(n_anchors) // 4))
    centres = _centres(anchors, wanted)
    members = _assigned(anchors, centres)
    shape = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("reach")).collect()
    reach, sizes = np.zeros(len(centres)), np.zeros(len(centres), dtype=int)
    for r in shape:
        reach[r["cluster"]], sizes[r["cluster"]] = r["reach"], r["n"]
    listed = _listed(rows, centres, reach)
    model = Model(centres, reach, sizes, _cuts(listed, n_rows, len(centres)))

    parts = F.element_at(F.array(*[F.lit(max(1, math.ceil(int(n) / BLOCK_ANCHORS))) for n in sizes]), F.col("cluster") + 1)
    member = members.select(
        F.col("id").alias("anchor"), "label", "v", "norm", "cluster", F.pmod(F.xxhash64("id", F.lit(1)), parts).cast("int").alias("block")
    )
    least, most = F.lit(float("-inf")), F.lit(float("inf"))
    asks = member.withColumns({"positive": F.col("anchor"), "low": least, "high": most, "need": least})
    near = _walk(asks, listed, model, positives, True).select("anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    near = materialize(near, "positives")
    # Whole numbers from lower to upper percent of the score.
    low, high = (F.col("positive_score") * F.lit(p).cast("long") for p in (lower, upper))
    low, high = ((c / F.lit(100)).cast("long") for c in (low + F.pmod(-low, F.lit(100)), high - F.pmod(high, F.lit(100))))
    bands = near.withColumns({"low": low.cast("double"), "high": high.cast("double")}).where("low <= high")
    bands = bands.join(F.broadcast(member) if within_limit(member) else member, "anchor").withColumn("need", F.col("low"))
    far = _walk(bands.drop("positive_score"), listed, model, negatives, False)
    rank = F.row_number().over(Window.partitionBy("anchor", "positive").orderBy(F.col("score").desc(), "id"))
    return far.join(near, ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), rank.alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = integer_vectors(table(spark, sf_dir, "embeddings"), "vec_id", label, "embedding")
    return hard_negatives(rows, rows.where(F.col("id") % 100 == 0))


SQL = {
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (
            SELECT a.id AS anchor_id, r.id AS id, a.label = r.label AS same,
                list_inner_product(a.v, r.v)::BIGINT AS score
            FROM v a JOIN v r ON a.id % 100 = 0 AND a.id <> r.id),
        p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
        n AS (
            SELECT p.*, s.id AS negative_id, s.score AS negative_score,
                row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
            FROM p JOIN s USING (anchor_id)
            WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
    """
}
QUERIES = {"op12_hard_negatives": op12_hard_negatives}
