"""Tree regressors, and boosting that stops when the validation loss does."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession

from hardwood.models.linear import fit_complete, known_features


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")


def tree_pipeline(
    features: Sequence[str], label: str, prediction: str = "y_pred", depth: int = 30, bins: int = 32, seed: int = 10
) -> Pipeline:
    """One regression tree, as deep as MLlib allows; ``bins`` candidates per feature. Fit it with ``fit_complete``."""
    tree = DecisionTreeRegressor(
        featuresCol="features", labelCol=label, predictionCol=prediction, maxDepth=depth, maxBins=bins, seed=seed
    )
    return Pipeline(stages=[_assembler(features), tree, known_features(features, prediction)])


def boosted_pipeline(
    features: Sequence[str], label: str, prediction: str = "y_pred", rounds: int = 20, depth: int = 4, bins: int = 32, seed: int = 10
) -> Pipeline:
    """``rounds`` boosted trees."""
    boosted = GBTRegressor(
        featuresCol="features", labelCol=label, predictionCol=prediction, maxIter=rounds, maxDepth=depth, maxBins=bins, seed=seed
    )
    return Pipeline(stages=[_assembler(features), boosted, known_features(features, prediction)])


def best_round(losses: Sequence[float], patience: int, min_delta: float) -> tuple[int, bool]:
    """(the round, from 1, that is kept; whether training stopped before the last round).

    A round counts as better if it lowers the least loss so far by more than ``min_delta``;
    after ``patience`` rounds that do not, training stops.
    """
    best, at, waited = float("inf"), 1, 0
    for number, loss in enumerate(losses, 1):
        if loss < best - min_delta:
            best, at, waited = loss, number, 0
        else:
            waited += 1
            if waited >= patience:
                return at, True
    return at, False


def fit_with_patience(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    label: str,
    rounds: int = 100,
    patience: int = 10,
    min_delta: float = 0.0,
    depth: int = 4,
    bins: int = 32,
    seed: int = 10,
) -> tuple[PipelineModel, DataFrame]:
    """(the model of the best round, the loss curve of all rounds fitted).

    The validation rows must be neither fitted nor scored afterwards; take them out of the training
    part. Boosting is deterministic, so twice as many rounds are tried while training has not
    stopped, and the best round is fitted again with as many rounds.
    """

    def fitted(number: int) -> PipelineModel:
        return fit_complete(boosted_pipeline(features, label, rounds=number, depth=depth, bins=bins, seed=seed), train, features, label)

    tried = min(rounds, 2 * patience)
    while True:
        model = fitted(tried)
        curve = loss_curve(model, train, validation)
        losses = [r["val_loss"] for r in curve.orderBy("round").collect()]  # one row per round
        best, stopped = best_round(losses, patience, min_delta)
        if stopped or tried == rounds:
            return (model if best == tried else fitted(best)), curve
        tried = min(rounds, 2 * tried)


def loss_curve(model: PipelineModel, train: DataFrame, validation: DataFrame) -> DataFrame:
    """``(round, loss, val_loss)``: squared loss after each round."""
    assembler = model.stages[0]
    boosted = next(s for s in model.stages if isinstance(s, GBTRegressionModel))
    train_loss = boosted.evaluateEachIteration(assembler.transform(train), "squared")
    val_loss = boosted.evaluateEachIteration(assembler.transform(validation), "squared")
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(train_loss, val_loss))]
    return SparkSession.getActiveSession().createDataFrame(rows, "round int, loss double, val_loss double")


def score_saved(path: str, df: DataFrame) -> DataFrame:
    """Load a saved pipeline and score ``df``: as many rows as it has."""
    return PipelineModel.load(path).transform(df)
