"""Boosted regression trees that go on from round to round.

Features are cut into bins once. Rows with the same bins have the same prediction in every round, so they are added up to one:
how many they are, the mean of their labels, and the squares around it. These with their prediction so far are a stored table,
which is never larger than the rows. A round grows one tree on
what is left to explain: for each level the tasks add up rows and residuals per (node, feature, bin), so at most
``2 ** depth * features * bins`` sums reach the driver whatever the number of rows. Then the next state is written with the tree's
values added, and the losses of both parts are summed up in the same pass. Nothing is fitted twice: training
stops when the validation loss does, and the model is the trees up to its best round.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hardwood.models.trees import best_round
from hardwood.session import remove_path, work_path

# Python functions travel to the executors with their code; nothing is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_BINS = 256
# Gains are compared to twelve digits of the error, so the order in which tasks end does not matter.
_DIGITS = 12


@dataclass
class Tree:
    """Nodes in the order they were made; ``feature`` -1 is a leaf, and rows with ``bin`` or less go left."""

    feature: list[int]
    bin: list[int]
    left: list[int]
    right: list[int]
    value: list[float]

    def nodes_of(self, binned: np.ndarray) -> np.ndarray:
        feature, bins, left, right = (np.array(c, dtype=np.int64) for c in (self.feature, self.bin, self.left, self.right))
        at = np.zeros(len(binned), dtype=np.int64)
        moving = np.flatnonzero(feature[at] >= 0)
        while len(moving):
            here = at[moving]
            at[moving] = np.where(binned[moving, feature[here]] <= bins[here], left[here], right[here])
            moving = moving[feature[at[moving]] >= 0]
        return at

    def values(self, binned: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes_of(binned)]


@dataclass
class Boosted:
    """``base`` plus the values of all trees; ``edges`` are the last values of each feature's bins but the last."""

    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Boosted:
        known = json.loads(text)
        return Boosted(**{**known, "trees": [Tree(**t) for t in known["trees"]]})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Boosted:
        return Boosted.from_json(spark.read.text(path).first()["value"])

    def predict(self, df: DataFrame, prediction: str = "y_pred") -> DataFrame:
        """All rows of ``df`` with a prediction; null where a feature is missing."""
        values = F.array(*[F.col(f"`{c}`").cast("double") for c in self.features])
        known = ~F.exists(values, lambda v: v.isNull() | F.isnan(v))

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            there = x.notna().to_numpy()
            out = np.full(len(x), np.nan)
            if there.any():
                binned = _binned(np.array(x[there].tolist(), dtype=np.float64), self.edges)
                out[there] = self.base + sum((t.values(binned) for t in self.trees), np.zeros(int(there.sum())))
            return pd.Series(out)

        found = score(F.when(known, values))
        return df.withColumn(prediction, F.when(known, found))


def _binned(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    return np.stack([np.searchsorted(np.array(e, dtype=np.float64), x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


def _opened(batch: pd.DataFrame, n_features: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch["bins"]), dtype=np.uint8).reshape(-1, n_features)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """At most ``bins - 1`` rising edges of each feature: its values where they are that few, else quantiles."""
    shares = [i / bins for i in range(1, bins)]
    columns = {c: F.col(f"`{c}`").cast("double") for c in features}
    each = [F.percentile_approx(c, shares, 100 * bins).alias(f"e{i}") for i, c in enumerate(columns.values())]
    last = [F.max(c).alias(f"m{i}") for i, c in enumerate(columns.values())]
    about = [F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(columns.values())]
    found = df.agg(*each, *last, *about).first()
    edges = []
    for i, column in enumerate(columns.values()):
        # A count within a few percent decides whether it is worth looking for the values themselves.
        few = [r[0] for r in df.select(column).distinct().limit(bins + 1).collect()] if found[f"n{i}"] <= 2 * bins else None
        cuts = sorted(few)[:-1] if few is not None and len(few) <= bins else [e for e in found[f"e{i}"] or [] if e < found[f"m{i}"]]
        edges.append(sorted(set(cuts)))
    return edges


def _grown(state: DataFrame, n_features: int, bins: int, depth: int, rate: float) -> Tree:
    """One tree on the residuals of the training rows."""
    tree = Tree([-1], [0], [-1], [-1], [0.0])
    level = [0]
    for step in range(depth + 1):
        open_ = {node: i for i, node in enumerate(level)}

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            place = np.full(len(tree.feature), -1)
            place[list(open_)] = list(open_.values())
            n, s = (np.zeros(len(open_) * n_features * bins) for _ in range(2))
            squares = 0.0
            for batch in batches:
                if not len(batch):
                    continue
                binned, each = _opened(batch, n_features), batch["n"].to_numpy()
                rest = (batch["y"] - batch["pred"]).to_numpy()
                squares += float((batch["around"].to_numpy() + each * rest * rest).sum())
                node = place[tree.nodes_of(binned)]
                inside = node >= 0
                for feature in range(n_features):
                    at = (node[inside] * n_features + feature) * bins + binned[inside, feature]
                    n += np.bincount(at, weights=each[inside], minlength=len(n))
                    s += np.bincount(at, weights=(each * rest)[inside], minlength=len(s))
            there = np.flatnonzero(n)
            yield pd.DataFrame({"at": [-1, *there], "n": [0.0, *n[there]], "s": [squares, *s[there]]})

        training = state.where("training").select("n", "y", "around", "pred", "bins")
        found = training.mapInPandas(sums, "at long, n double, s double").groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas()
        n, s = (np.zeros(len(open_) * n_features * bins) for _ in range(2))
        counted = found[found["at"] >= 0]
        squares = float(found.loc[found["at"] == -1, "s"].sum())
        n[counted["at"]], s[counted["at"]] = counted["n"], counted["s"]
        n, s = n.reshape(len(open_), n_features, bins), s.reshape(len(open_), n_features, bins)
        below: list[int] = []
        for node, i in open_.items():
            rows, total = n[i, 0].sum(), s[i, 0].sum()
            if rows:
                tree.value[node] = float(rate * total / rows)
            if step == depth or not rows:
                continue
            left, left_sum = np.cumsum(n[i], axis=1)[:, :-1], np.cumsum(s[i], axis=1)[:, :-1]
            right, right_sum = rows - left, total - left_sum
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left_sum**2 / left + right_sum**2 / right - total**2 / rows
            gain = np.round(np.where((left > 0) & (right > 0), gain, 0.0) / (squares or 1.0), _DIGITS)
            feature, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
            if gain[feature, cut] > 0:
                here = len(tree.feature)
                tree.feature[node], tree.bin[node], tree.left[node], tree.right[node] = int(feature), int(cut), here, here + 1
                for column, empty in ((tree.feature, -1), (tree.bin, 0), (tree.left, -1), (tree.right, -1), (tree.value, 0.0)):
                    column += [empty, empty]
                below += [here, here + 1]
        if not below:
            break
        level = below
    return tree


def fit_boosted(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    label: str,
    rounds: int = 100,
    patience: int = 10,
    min_delta: float = 0.0,
    depth: int = 4,
    bins: int = 32,
    rate: float = 0.1,
) -> tuple[Boosted, DataFrame]:
    """(the model of the best round, ``(round, loss, val_loss)`` of all rounds made).

    Rows without a feature or the label take no part. Training stops after ``patience`` rounds that do not lower the
    validation loss by more than ``min_delta``. A first state lost with its folder costs the fit, a lost executor a task.
    """
    if not 2 <= bins <= MAX_BINS:
        raise ValueError(f"bins from 2 to {MAX_BINS}")
    spark, n_features = train.sparkSession, len(features)
    columns = [F.col(f"`{c}`").cast("double") for c in [*features, label]]
    parts = []
    for part, training in ((train, True), (validation, False)):
        known = part.where(~F.exists(F.array(*columns), lambda v: v.isNull() | F.isnan(v)))
        parts.append(known.select(F.array(*columns[:-1]).alias("x"), columns[-1].alias("y"), F.lit(training).alias("training")))
    edges = bin_edges(parts[0].select(*[F.col("x")[i].alias(c) for i, c in enumerate(features)]), features, bins)
    base = parts[0].agg(F.avg("y")).first()[0]
    if base is None:
        raise ValueError("no training row has all features and the label")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                binned = _binned(np.array(batch["x"].tolist(), dtype=np.float64), edges)
                yield pd.DataFrame({"training": batch["training"], "y": batch["y"], "bins": [r.tobytes() for r in binned]})

    kind = "training boolean, bins binary, n double, y double, around double, pred double"

    def stored(rows: DataFrame) -> tuple[DataFrame, str, float, float | None]:
        """The next state, where it is, and its losses."""
        seen, path = Observation(), work_path(spark, "boosted")
        error = F.col("around") + F.col("n") * (F.col("y") - F.col("pred")) * (F.col("y") - F.col("pred"))
        part = {"loss": F.col("training"), "val_loss": ~F.col("training")}
        means = [(F.sum(F.when(p, error)) / F.sum(F.when(p, F.col("n")))).alias(c) for c, p in part.items()]
        rows.observe(seen, *means).write.parquet(path)
        return spark.read.schema(kind).parquet(path), path, seen.get["loss"], seen.get["val_loss"]

    binned = parts[0].unionByName(parts[1]).mapInPandas(cut, "training boolean, y double, bins binary")
    # The squares come from the deviations of the labels, so nothing cancels out.
    count = F.count(F.lit(1)).cast("double")
    alike = binned.groupBy("training", "bins").agg(count.alias("n"), F.avg("y").alias("y"), (F.var_pop("y") * count).alias("around"))
    state, path, _, _ = stored(alike.withColumn("pred", F.lit(float(base))).select(*[c.split()[0] for c in kind.split(", ")]))
    trees: list[Tree] = []
    curve: list[tuple[int, float, float]] = []
    while len(trees) < rounds:
        tree = _grown(state, n_features, bins, depth, rate)

        def moved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    yield batch.assign(pred=batch["pred"] + tree.values(_opened(batch, n_features)))

        earlier = path
        state, path, loss, val_loss = stored(state.mapInPandas(moved, kind))
        remove_path(spark, earlier)
        trees.append(tree)
        curve.append((len(trees), loss, val_loss))
        # Without validation rows nothing stops training before its last round.
        best, stopped = best_round([v for _, _, v in curve], patience, min_delta) if val_loss is not None else (len(trees), False)
        if stopped:
            break
    remove_path(spark, path)
    model = Boosted(list(features), edges, float(base), trees[:best])
    return model, spark.createDataFrame(curve, "round int, loss double, val_loss double")
