"""Whose next score is hardest to predict?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.functions.clean import minutes_dotted
from hardwood.operators.evaluate import metrics
from hardwood.operators.impute import complete_rows, fill_series_mean
from hardwood.operators.series import GameSeries, lagged, mean_of_previous
from hardwood.operators.splits import chronological_split


def naive_predictions(
    games: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    target: str,
    n: int = 2,
    lags: int = 3,
    train_share: float = 0.85,
    digits: int | None = 2,
    block_rows: int | None = None,
) -> DataFrame:
    """Impute, add lags and the mean of the previous ``n`` games as prediction, and split.

    While every entity fits a block, the whole plan has one exchange and one sort.
    """
    series = GameSeries.of(games, entity, order, block_rows)
    series = fill_series_mean(series, [target], digits)
    features = {f"{target}_{k}": lagged(target, k) for k in range(1, lags + 1)}
    series = series.neighbours(max(n, lags), 0, y_pred=mean_of_previous(target, n), **features)
    series = chronological_split(series, train_share)
    wanted = [target, "y_pred", *features]
    return complete_rows(series.result(), wanted)


def scored_text(sentinel: Column, value: Column) -> Column:
    """A score column as it is read: a number, or a did-not-play text."""
    return F.when(sentinel, F.lit("Did Not Play")).otherwise(F.format_string("%.2f", value))


def player_difficulty(games: DataFrame, entity: str, order: Sequence[str], text: str, **options) -> DataFrame:
    """Error of the naive prediction per entity, on the test games."""
    cleaned = games.withColumn("y", minutes_dotted(F.col(text)))
    predicted = naive_predictions(cleaned, [entity], order, "y", **options)
    return metrics(predicted.where(F.col("split") == "test"), "y", "y_pred", by=[entity])
