"""Two sources merged, averaged over the previous games, fitted and judged."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.models.linear import fit_complete, linear_pipeline
from hardwood.operators.evaluate import metrics
from hardwood.operators.impute import complete_rows, nonzero_target, originals_first
from hardwood.operators.scaling import minmax
from hardwood.operators.series import GameSeries, previous_means
from hardwood.operators.splits import random_split
from hardwood.session import materialize

MERGE_KEYS = ("GameID", "Name", "Team", "Date")


def feed_side(feed: DataFrame) -> DataFrame:
    """The feed's columns of the merge, by their merged names."""
    return feed.select(
        "GameID", F.col("First  Last").alias("Name"), "Date", "Team", F.col("FDP").cast("double").alias("FDP"),
        F.col("FD Sal").cast("double").alias("FDS"), F.col("FD Change").cast("double").alias("FD_change"),
        F.col("FD pos").alias("FD_pos"),
    )


def box_side(box: DataFrame) -> DataFrame:
    """Box scores with lower-case keys."""
    return box.withColumns({c: F.lower(c) for c in ("Team", "OPP", "GameID")})


def merged_averages(feed: DataFrame, box: DataFrame, columns: Sequence[str], games: int = 2, block_rows: int | None = None) -> DataFrame:
    """Inner merge, then the mean of the previous games for every column, derived last.

    A game and player is one row on either side, so a plain join is balanced, and each side is computed once.
    """
    merged = feed_side(feed).join(box_side(box), list(MERGE_KEYS))
    merged = materialize(merged, "merged")
    series = GameSeries.of(merged, ["Name"], ["Date", "GameID"], block_rows)
    averaged = previous_means(series, columns, games).result()
    return originals_first(averaged, [f"{games}_{c}" for c in columns])


def linear_on_averages(
    averaged: DataFrame, columns: Sequence[str], target: str = "FDP", games: int = 2, key: str = "row_key", scale: bool = False
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, test predictions, metrics) of a linear fit with a random 80/20 split."""
    features = [f"{games}_{c}" for c in columns]
    ready = nonzero_target(complete_rows(averaged, [*features, target]), target)
    split = random_split(ready, key)
    if scale:
        split = minmax(split, features, [key])
    split = materialize(split, "fit")
    model = fit_complete(linear_pipeline(features, target), split.where(F.col("split") == "train"), features, target)
    predicted = model.transform(split.where(F.col("split") == "test")).drop("features")
    return model, predicted, metrics(predicted, target, "y_pred")
