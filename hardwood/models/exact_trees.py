"""Regression trees with exact thresholds and no limit of depth.

While a node has more than ``local_rows`` rows, its best split is searched for on the cluster: rows are added up in bins, and
bounds of the gain rule out bins without the best threshold. Rows of the others are added up per value, the values are range-sorted, and running sums over a partition, with what the partitions before
it add, give the loss of every threshold between two neighbouring values. All nodes of a level are split at once. A
smaller node's rows make a subtree in one task, by the same rule.

A split is the one that lowers the squared error most, to twelve digits of the error before; ties go to the first
feature, then to the smallest threshold, halfway between two values. Nodes end when their labels or all their features are equal,
at ``max_depth``, or below ``min_rows`` rows.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hardwood.operators.balance import attach
from hardwood.session import materialize

# Python functions travel to the executors with their code; nothing is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOCAL_ROWS = 10_000
# Bins of a feature's values, over all nodes of a level.
BINS = 65_536
BIN_ROWS = 64
# Rows that one task scores with one subtree.
SCORED_ROWS = 100_000
ROOT = "r"
_DIGITS = 12
# Of the sum of squares: what is left of it in a node of equal labels.
_NOTHING = 1e-14
# Of the error before: a bin whose bound is this close to the best is looked at.
_NEAR = 1e-9

TOP = "node string, depth int, feature int, threshold double, n long, value double"
SUBTREE = "anchor string, place int, depth int, feature int, threshold double, left int, right int, n long, value double"


@dataclass(frozen=True)
class ExactTree:
    """``top``: nodes split on the cluster, and leaves among them; ``subtrees``: nodes below, by the node they hang from."""

    features: tuple[str, ...]
    top: DataFrame
    subtrees: DataFrame

    def depth(self) -> int:
        deepest = [t.agg(F.max("depth")).first()[0] for t in (self.top, self.subtrees)]
        return max(d for d in deepest if d is not None)


def best_splits(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(node, feature, threshold)`` for the nodes of ``rows(node, x array, y)`` that can be split.

    ``sizes`` has what :func:`_sizes` gives for these nodes; other nodes are left out. Values are first added up in
    bins. Within a bin the sum of the left labels is bounded, and the gain is convex in the left rows and their sum, so a corner
    of what is possible bounds the gain of all its thresholds. Only bins that may hold the best one are looked at value by value.
    """
    nodes = sizes.select("node", "n", "s", "q", "ymin", "ymax", "lo", "hi")
    error = F.col("q") - F.col("s") * F.col("s") / F.col("n")
    shape = nodes.agg(F.count("node").alias("nodes"), F.sum("n").alias("rows")).first()
    bins = min(BINS, (shape["rows"] or 0) // BIN_ROWS) // max(1, shape["nodes"])
    if bins > 1:
        within, kept = _promising(rows, nodes, error, bins)
    else:
        # Too few rows for bins to tell anything: one bin for each feature.
        within = attach(rows, nodes.select("node"), ["node"], ["y"], "inner")
        within = within.select("node", "y", F.posexplode("x").alias("feature", "v")).withColumn("bin", F.lit(0))
        kept = None
    values = within.groupBy("node", "feature", "bin", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"))
    order = ["node", "feature", "bin", "v"]
    ranged = values.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    # Ranges are sampled, so the partitions must not change once they are summed up.
    stored = materialize(ranged, "values").withColumn("_part", F.shiftright("_id", 33))
    keys = ["_part", "node", "feature", "bin"]
    inside = Window.partitionBy(*keys).orderBy("v")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    stored = stored.withColumns({"_ln": F.sum("n").over(running), "_ls": F.sum("s").over(running), "_next": F.lead("v").over(inside)})
    parts = stored.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("v").alias("v"))
    # At most one row for each partition and bin.
    along = Window.partitionBy("node", "feature", "bin").orderBy("_part")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(
        *keys, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_cn"), F.coalesce(F.sum("s").over(earlier), F.lit(0.0)).alias("_cs"),
        F.lead("v").over(along).alias("_first"),
    )
    if kept is not None:
        carried = carried.join(kept, ["node", "feature", "bin"])
        carried = carried.select(*keys, (F.col("_cn") + F.col("ln")).alias("_cn"), (F.col("_cs") + F.col("ls")).alias("_cs"), F.coalesce("_first", "after").alias("_first"))
    joined = attach(stored.drop("n", "s"), materialize(carried, "carried"), keys, ["v"], "inner")
    joined = attach(joined, nodes.drop("lo", "hi"), ["node"], ["feature", "v"], "inner")
    following = F.coalesce("_next", "_first")
    middle = (F.col("v") + following) / 2
    gained = _gain(F.col("_cn") + F.col("_ln"), F.col("_cs") + F.col("_ls"))
    possible = joined.where(following.isNotNull() & (error > _NOTHING * F.col("q"))).select(
        "node", "feature", F.when(middle < following, middle).otherwise(F.col("v")).alias("threshold"), F.round(gained / error, _DIGITS).alias("gain")
    )
    possible = possible.where("gain > 0")
    rank = F.struct("gain", -F.col("feature"), -F.col("threshold"))
    return possible.groupBy("node").agg(F.max_by(F.struct("feature", "threshold"), rank).alias("s")).select("node", "s.feature", "s.threshold")


def _promising(rows: DataFrame, nodes: DataFrame, error: Column, bins: int) -> tuple[DataFrame, DataFrame]:
    """``(node, feature, bin, v, y)`` of the bins that may hold a node's best split, and what lies before and after these bins."""
    cells = attach(rows, nodes.select("node", "lo", "hi"), ["node"], ["y"], "inner")
    cells = cells.select("node", "y", "lo", "hi", F.posexplode("x").alias("feature", "v"))
    low, high = (F.element_at(c, F.col("feature") + 1) for c in ("lo", "hi"))
    # Halves, as a difference may be beyond all doubles. Any bin is right that does not fall while the value grows.
    place = F.try_divide(F.col("v") / 2 - low / 2, high / 2 - low / 2) * bins
    place = F.when(low < high, F.least(F.floor(F.coalesce(F.nanvl(place, F.lit(0.0)), F.lit(0.0))).cast("int"), F.lit(bins - 1))).otherwise(F.lit(0))
    cells = cells.select("node", "y", "feature", "v", place.alias("bin"))
    binned = cells.groupBy("node", "feature", "bin").agg(F.count(F.lit(1)).alias("bn"), F.sum("y").alias("bs"), F.min("v").alias("first"))
    # At most BINS rows for each feature.
    row = Window.partitionBy("node", "feature").orderBy("bin")
    before = row.rowsBetween(Window.unboundedPreceding, -1)
    begun = {"ln": F.coalesce(F.sum("bn").over(before), F.lit(0)), "ls": F.coalesce(F.sum("bs").over(before), F.lit(0.0)), "after": F.lead("first").over(row)}
    found = attach(materialize(binned, "bins").withColumns(begun), nodes.drop("lo", "hi"), ["node"], ["feature", "bin"], "inner")
    found = found.where(error > _NOTHING * F.col("q"))
    spread = F.col("ymax") - F.col("ymin")
    # Rows of the bin with the least or the largest labels that go left at the two other corners.
    most = F.try_divide(F.col("bs") - F.col("bn") * F.col("ymin"), spread)
    least = F.col("bn") - most
    corners = [_gain(F.col("ln") + m, F.col("ls") + t) for m, t in ((F.lit(0), F.lit(0.0)), (F.col("bn"), F.col("bs")), (most, most * F.col("ymax")), (least, least * F.col("ymin")))]
    reached = F.when(F.col("after").isNotNull(), corners[1]).otherwise(F.lit(0.0))
    found = found.select(
        "node", "feature", "bin", "ln", "ls", "after", (F.greatest(*corners) / error).alias("most"), (reached / error).alias("reached"),
        (_NEAR + _NOTHING * F.col("q") / error).alias("near"),
    )
    found = found.withColumn("best", F.max("reached").over(Window.partitionBy("node")))
    # A bound that is no number rules out nothing.
    kept = materialize(found.where(~(F.col("most") < F.col("best") - F.col("near"))).select("node", "feature", "bin", "ln", "ls", "after"), "kept")
    within = attach(cells, kept.select("node", "feature", "bin"), ["node", "feature", "bin"], ["v", "y"], "inner")
    return within, kept


def _gain(left: Column, left_sum: Column) -> Column:
    """What ``left`` of a node's ``n`` rows, with this sum of labels, take off its squared error."""
    left, total, right_sum = left.cast("double"), F.col("n").cast("double"), F.col("s") - left_sum
    share = F.when(left > 0, left_sum * left_sum / left).otherwise(F.lit(0.0))
    rest = F.when(left < total, right_sum * right_sum / (total - left)).otherwise(F.lit(0.0))
    return share + rest - F.col("s") * F.col("s") / total


def _sizes(rows: DataFrame, width: int) -> DataFrame:
    """Rows, mean, sums and limits of the labels, and limits of the features, of every node."""
    y = F.col("y")
    limits = [F.array(*[side(F.element_at("x", i + 1)) for i in range(width)]).alias(name) for name, side in (("lo", F.min), ("hi", F.max))]
    return rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("value"), F.sum("y").alias("s"), F.sum(y * y).alias("q"), F.min("y").alias("ymin"), F.max("y").alias("ymax"), *limits
    )


def _best_here(x: np.ndarray, y: np.ndarray) -> tuple[int, float] | None:
    """The same for the rows of one node."""
    n, total, squares = len(y), y.sum(), (y * y).sum()
    error = squares - total * total / n
    if not error > _NOTHING * squares:
        return None
    best = None
    for feature in range(x.shape[1]):
        order = np.argsort(x[:, feature], kind="stable")
        v, s = x[order, feature], np.cumsum(y[order])
        ends = np.flatnonzero(v[1:] > v[:-1])
        if not len(ends):
            continue
        left, left_sum = ends + 1.0, s[ends]
        right_sum = total - left_sum
        gained = left_sum * left_sum / left + right_sum * right_sum / (n - left) - total * total / n
        gain = np.round(gained / error, _DIGITS)
        at = int(np.argmax(gain))
        if gain[at] > 0 and (best is None or gain[at] > best[0]):
            middle = (v[ends[at]] + v[ends[at] + 1]) / 2
            best = gain[at], feature, middle if middle < v[ends[at] + 1] else v[ends[at]]
    return None if best is None else best[1:]


def _subtree(rows: pd.DataFrame, min_rows: int, max_depth: int | None) -> pd.DataFrame:
    """All nodes below one node, numbered from 0."""
    x = np.array(rows["x"].tolist(), dtype=np.float64)
    y = rows["y"].to_numpy(np.float64)
    depth = int(rows["depth"].iloc[0])
    nodes: list[list] = []
    waiting = [(np.arange(len(y)), depth, -1, "")]
    while waiting:
        at, level, parent, side = waiting.pop()
        if parent >= 0:
            nodes[parent][3 if side == "left" else 4] = len(nodes)
        stop = len(at) < min_rows or max_depth is not None and level >= max_depth
        split = None if stop else _best_here(x[at], y[at])
        nodes.append([level, None, None, None, None, len(at), y[at].mean()])
        if split is not None:
            feature, threshold = split
            nodes[-1][1:3] = feature, threshold
            below = x[at, feature] <= threshold
            here = len(nodes) - 1
            waiting += [(at[~below], level + 1, here, "right"), (at[below], level + 1, here, "left")]
    out = pd.DataFrame(nodes, columns=["depth", "feature", "threshold", "left", "right", "n", "value"])
    out = out.astype({c: "Int32" for c in ("feature", "left", "right")}).astype({"threshold": "Float64"})
    out.insert(0, "place", np.arange(len(out), dtype=np.int32))
    out.insert(0, "anchor", pd.Series([rows["node"].iloc[0]] * len(out), dtype=object))
    return out


def fit_exact_tree(
    df: DataFrame, features: Sequence[str], label: str, min_rows: int = 2, max_depth: int | None = None, local_rows: int = LOCAL_ROWS
) -> ExactTree:
    """Grow a tree on the rows that have all features and the label."""
    known = [F.col(f"`{c}`").cast("double") for c in [*features, label]]
    complete = df.where(~F.exists(F.array(*known), lambda v: v.isNull() | F.isnan(v)))
    rows = complete.select(F.lit(ROOT).alias("node"), F.array(*known[:-1]).alias("x"), known[-1].alias("y"))
    spark = df.sparkSession
    top, small, depth = [], [], 0
    rows = materialize(rows, "rows")
    while True:
        sizes = materialize(_sizes(rows, len(features)).withColumn("_big", F.col("n") > local_rows), "sizes")
        marked = attach(rows, sizes.select("node", "_big"), ["node"], ["y"], "inner")
        # A level without small nodes is not read for them.
        if not sizes.where(~F.col("_big")).isEmpty():
            small.append(marked.where(~F.col("_big")).drop("_big").withColumn("depth", F.lit(depth)))
        big = sizes.where("_big").select("node", "n", "value")
        if big.isEmpty():
            break
        open_ = marked.where("_big").drop("_big")
        if max_depth is not None and depth >= max_depth:
            splits = spark.createDataFrame([], "node string, feature int, threshold double")
        else:
            enough = sizes.where(F.col("_big") & (F.col("n") >= min_rows))
            splits = materialize(best_splits(open_, enough), "splits")
        nodes = materialize(attach(big, splits, ["node"], ["n"]).withColumn("depth", F.lit(depth)), "top")
        top.append(nodes.select(*[c.split()[0] for c in TOP.split(", ")]))
        moved = attach(open_, splits, ["node"], ["y"], "inner")
        side = F.when(F.element_at("x", F.col("feature") + 1) <= F.col("threshold"), "L").otherwise("R")
        rows = materialize(moved.select(F.concat("node", side).alias("node"), "x", "y"), "rows")
        depth += 1
    below = rows.where("false").withColumn("depth", F.lit(0))
    for part in small:
        below = below.unionByName(part)
    subtrees = below.groupBy("node").applyInPandas(lambda r: _subtree(r, min_rows, max_depth), SUBTREE)
    whole = spark.createDataFrame([], TOP)
    for part in top:
        whole = whole.unionByName(part)
    return ExactTree(tuple(features), materialize(whole, "top"), materialize(subtrees, "subtrees"))


def predict_exact_tree(tree: ExactTree, df: DataFrame, prediction: str = "y_pred") -> DataFrame:
    """All rows of ``df`` with the mean label of their leaf; null where a feature is missing."""
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in tree.features])
    known = ~F.exists(values, lambda v: v.isNull() | F.isnan(v))
    rows = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), F.when(known, values).alias("x"))
    rows = materialize(rows.withColumn("node", F.when(F.col("x").isNotNull(), F.lit(ROOT))).withColumn("_id", F.monotonically_increasing_id()), "asked")
    for depth in range((tree.top.agg(F.max("depth")).first()[0] if not tree.top.isEmpty() else -1) + 1):
        splits = tree.top.where((F.col("depth") == depth) & F.col("feature").isNotNull()).select("node", "feature", "threshold")
        met = attach(rows, splits, ["node"], ["_id"])
        side = F.when(F.element_at("x", F.col("feature") + 1) <= F.col("threshold"), "L").otherwise("R")
        node = F.when(F.col("feature").isNotNull(), F.concat("node", side)).otherwise(F.col("node"))
        rows = met.withColumn("node", node).drop("feature", "threshold")
    leaves = tree.top.where(F.col("feature").isNull()).select("node", F.col("value").alias("_leaf"))
    rows = materialize(attach(rows, leaves, ["node"], ["_id"]), "routed")
    ended = rows.where(F.col("_leaf").isNotNull() | F.col("x").isNull()).select("row.*", F.col("_leaf").alias(prediction))
    going = rows.where(F.col("_leaf").isNull() & F.col("x").isNotNull())
    sizes = going.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / F.lit(SCORED_ROWS)).cast("int").alias("_slots"))
    sizes = materialize(sizes, "sizes")
    dealt = attach(going, sizes, ["node"], ["_id"], "inner").withColumn("_slot", F.pmod(F.xxhash64("_id"), F.col("_slots")).cast("int"))
    repeated = tree.subtrees.withColumnRenamed("anchor", "node").join(sizes, "node")
    repeated = repeated.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)))
    keys = ["node", "_slot"]

    def score(asked: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        if asked.empty:
            return pd.DataFrame({"_id": np.zeros(0, np.int64), "_value": np.zeros(0)})
        nodes = nodes.sort_values("place")
        feature = nodes["feature"].fillna(-1).to_numpy(np.int64)
        threshold = nodes["threshold"].to_numpy(np.float64)
        left, right = (nodes[c].fillna(-1).to_numpy(np.int64) for c in ("left", "right"))
        x = np.array(asked["x"].tolist(), dtype=np.float64)
        at = np.zeros(len(x), dtype=np.int64)
        moving = np.flatnonzero(feature[at] >= 0)
        while len(moving):
            here = at[moving]
            below = x[moving, feature[here]] <= threshold[here]
            at[moving] = np.where(below, left[here], right[here])
            moving = moving[feature[at[moving]] >= 0]
        return pd.DataFrame({"_id": asked["_id"], "_value": nodes["value"].to_numpy(np.float64)[at]})

    asked = dealt.select("_id", "x", *keys).groupBy(*keys)
    found = asked.cogroup(repeated.groupBy(*keys)).applyInPandas(score, "_id long, _value double")
    scored = going.select("_id", "row").join(found, "_id").select("row.*", F.col("_value").alias(prediction))
    return ended.unionByName(scored)
