"""Linear fits: one pooled model, and one model per entity from sums."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.operators.balance import attach

# Python functions travel to the executors with their code; nothing is installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def known_features(features: Sequence[str], prediction: str = "y_pred") -> SQLTransformer:
    """A last stage that keeps every row and gives a null prediction where a feature is missing."""
    missing = " OR ".join(f"`{f}` IS NULL OR isnan(`{f}`)" for f in features)
    return SQLTransformer(
        statement=f"SELECT * EXCEPT (`{prediction}`), CASE WHEN {missing} THEN NULL ELSE `{prediction}` END AS `{prediction}` FROM __THIS__"
    )


def linear_pipeline(features: Sequence[str], label: str, prediction: str = "y_pred") -> Pipeline:
    """Least squares without regularisation; fit it with :func:`fit_complete`."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
            LinearRegression(featuresCol="features", labelCol=label, predictionCol=prediction, solver="normal", regParam=0.0),
            known_features(features, prediction),
        ]
    )


def fit_complete(pipeline: Pipeline, df: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Fit, or fail if a feature or the label is missing: to drop or to fill such rows is the caller's choice."""
    gaps = [F.count(F.when(F.col(f"`{c}`").isNull() | F.isnan(F.col(f"`{c}`").cast("double")), 1)).alias(c) for c in [*features, label]]
    missing = {c: n for c, n in df.agg(*gaps).first().asDict().items() if n}
    if missing:
        raise ValueError(f"rows without a value: {missing}")
    return pipeline.fit(df)


def coefficients(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """``(feature, weight)`` with the intercept as its own row."""
    fitted = next(s for s in model.stages if isinstance(s, LinearRegressionModel))
    rows = [(f, float(w)) for f, w in zip(features, fitted.coefficients)] + [("(intercept)", float(fitted.intercept))]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, weight double")


def simple_regression(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Slope and intercept of y on x, per group; combined before the shuffle."""
    return df.groupBy(*by).agg(
        F.regr_count(F.col(y), F.col(x)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
    )


def fit_per_entity(df: DataFrame, entity: Sequence[str], features: Sequence[str], label: str) -> DataFrame:
    """One least-squares fit per entity: ``(entity, n, status, weights)``.

    ``weights`` is [intercept, w1, ...]. Means, variances and covariances are ordinary
    aggregates, combined before the shuffle, so the length of a series does not matter, and they
    are centred, so the magnitude of the values does not, either. Python only solves
    the small systems of correlations. A feature without variance gets weight 0. Entities with fewer
    rows than features + 2 are listed as ``too short``.
    """
    value = lambda c: F.col(f"`{c}`").cast("double")
    complete = df.dropna("any", subset=[*features, label])
    names = [*features, label]
    sums = [F.avg(value(a)).alias(f"m_{i}") for i, a in enumerate(names)]
    for i, a in enumerate(names):
        sums += [F.covar_pop(value(a), value(b)).alias(f"c_{i}_{j}") for j, b in enumerate(names) if j >= i]
    totals = complete.groupBy(*entity).agg(F.count(F.lit(1)).alias("n"), *sums)
    size = len(features)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = len(batch)
            means = np.array([batch[f"m_{i}"] for i in range(size + 1)], dtype=float).T
            cov = np.empty((rows, size + 1, size + 1))
            for i in range(size + 1):
                for j in range(i, size + 1):
                    cov[:, i, j] = cov[:, j, i] = batch[f"c_{i}_{j}"].to_numpy(dtype=float)
            enough = batch["n"].to_numpy() >= size + 2
            cov[~enough] = 0.0
            spread = np.sqrt(np.einsum("rii->ri", cov)[:, :size])
            flat = ~(spread > 1e-12 * np.maximum(np.abs(means[:, :size]), 1e-300))
            scale = np.where(flat, 1.0, spread)
            system = cov[:, :size, :size] / (scale[:, :, None] * scale[:, None, :])
            right = cov[:, :size, size] / scale
            system[flat[:, :, None] | flat[:, None, :]] = 0.0
            right[flat] = 0.0
            # Minimum-norm solution where features depend on each other.
            slopes = np.einsum("rij,rj->ri", np.linalg.pinv(system, rcond=1e-10, hermitian=True), right) / scale
            intercept = means[:, size] - (slopes * means[:, :size]).sum(1)
            whole = np.column_stack([intercept, slopes])
            out = batch[[*entity, "n"]].copy()
            out["status"] = np.where(enough, "fitted", "too short")
            out["weights"] = [w.tolist() if ok else None for w, ok in zip(whole, enough)]
            yield out

    kinds = dict(df.dtypes)
    schema = ", ".join([f"`{e}` {kinds[e]}" for e in entity] + ["n long", "status string", "weights array<double>"])
    return totals.mapInPandas(solve, schema)


def predict_per_entity(df: DataFrame, fits: DataFrame, entity: Sequence[str], features: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Apply each entity's own weights."""
    joined = attach(df, fits.select(*entity, "weights"), entity, spread_by)
    prediction = F.element_at("weights", 1)
    for i, f in enumerate(features):
        prediction = prediction + F.element_at("weights", i + 2) * F.col(f)
    return joined.withColumn("y_pred", prediction).drop("weights")


# Entities whose sums a task holds before it hands them on.
HELD_ENTITIES = 5_000


def fit_best_order(df: DataFrame, entity: Sequence[str], lags: Sequence[str], label: str, validation: str) -> DataFrame:
    """The number of lags that predicts each entity's validation rows best: ``(entity, n, n_validation, order, mse, weights)``.

    ``lags`` are in order, the latest game first; model k uses the first k of them, and all models are fitted on the rows that have
    all lags. ``validation`` names a boolean column. One matrix of sums per entity and part holds every model: its leading
    blocks are the models' normal equations, and one Cholesky factor of the whole, row by row, is that of all blocks. The
    validation sums give each model's error without another look at the rows. Ties go to the shorter model. ``weights``
    is [intercept, w1, ...]. Values are taken from the entity's mean, so their magnitude does not matter. A lag that
    depends on earlier ones gets weight 0. Entities with fewer training rows than lags + 2, or without validation
    rows, have a null order.
    """
    names = [*lags, label]
    complete = df.dropna("any", subset=[*names, validation])
    centre = complete.groupBy(*entity).agg(F.avg(F.col(f"`{label}`").cast("double")).alias("_centre"))
    value = [(F.col(f"`{c}`").cast("double") - F.col("_centre")).alias(f"_{i}") for i, c in enumerate(names)]
    rows = attach(complete, centre, entity, names, "inner")
    rows = rows.select(*entity, "_centre", F.col(validation).alias("_v"), F.array(*value).alias("_x"))
    size = len(names) + 1
    entity = list(entity)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, list] = {}

        def handed() -> pd.DataFrame:
            found = pd.DataFrame([k for k in held], columns=entity)
            found["_centre"] = [v[0] for v in held.values()]
            for i, c in enumerate(("_train", "_validation"), 1):
                found[c] = [v[i].ravel().tolist() for v in held.values()]
            return found

        for batch in batches:
            if not len(batch):
                continue
            x = np.column_stack([np.ones(len(batch)), np.array(batch["_x"].tolist(), dtype=np.float64)])
            inside = batch["_v"].to_numpy(dtype=bool)
            for key, at in batch.groupby(entity, dropna=False, sort=False).indices.items():
                key = key if isinstance(key, tuple) else (key,)
                if key not in held:
                    held[key] = [float(batch["_centre"].iloc[at[0]]), np.zeros((size, size)), np.zeros((size, size))]
                for i, part in ((1, at[~inside[at]]), (2, at[inside[at]])):
                    held[key][i] += x[part].T @ x[part]
            if len(held) > HELD_ENTITIES:
                yield handed()
                held.clear()
        if held:
            yield handed()

    kinds = dict(df.dtypes)
    keys = ", ".join(f"`{e}` {kinds[e]}" for e in entity)
    parts = rows.mapInPandas(sums, f"{keys}, _centre double, _train array<double>, _validation array<double>")

    def choose(parts: pd.DataFrame) -> pd.DataFrame:
        train, judged = (np.sum([np.array(m) for m in parts[c]], axis=0).reshape(size, size) for c in ("_train", "_validation"))
        n, n_judged = int(round(train[0, 0])), int(round(judged[0, 0]))
        out = parts[entity].iloc[:1].copy()
        out["n"], out["n_validation"] = n, n_judged
        best = None
        if n >= size and n_judged:
            scale = np.sqrt(np.maximum(np.diag(train), 1e-300))
            system = train / np.outer(scale, scale)
            factor, used, solved = np.zeros((size - 1, size - 1)), [], np.zeros(size - 1)
            for k in range(size - 1):
                # The next row of the factor; the rows before stay as they are.
                row = np.zeros(size - 1)
                for j in used:
                    row[j] = (system[k, j] - row[:j] @ factor[j, :j]) / factor[j, j]
                left = system[k, k] - row @ row
                if left > 1e-10:
                    row[k] = np.sqrt(left)
                    factor[k] = row
                    solved[k] = (system[k, size - 1] - row[:k] @ solved[:k]) / row[k]
                    used.append(k)
                if k == 0:
                    continue
                weights = np.zeros(size)
                for j in reversed(used):
                    weights[j] = (solved[j] - factor[:, j] @ weights[:-1]) / factor[j, j]
                weights[:-1] *= scale[size - 1] / scale[:-1]
                weights[-1] = -1.0
                mse = float(weights @ judged @ weights) / n_judged
                # An improvement below what the sums can resolve is a tie.
                if best is None or mse < best[1] - 1e-12 * judged[-1, -1] / n_judged:
                    best = k, mse, weights[: k + 1].copy()
        out["order"] = pd.array([best[0] if best else None], dtype="Int32")
        out["mse"] = [best[1] if best else None]
        centre = float(parts["_centre"].iloc[0])
        weights = None
        if best:
            weights = best[2].tolist()
            weights[0] += centre * (1 - sum(weights[1:]))
        out["weights"] = [weights]
        return out

    schema = f"{keys}, n long, n_validation long, order int, mse double, weights array<double>"
    return parts.groupBy(*entity).applyInPandas(choose, schema)
