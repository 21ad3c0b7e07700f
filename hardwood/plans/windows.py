"""Cleaned box scores -> sliding windows, per player or per player and season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.fixed_values import NOT_FEATURES
from hardwood.functions.scores import book_score
from hardwood.operators.balance import profile
from hardwood.operators.categories import apply_index, first_seen_index, global_index
from hardwood.operators.impute import feature_columns, flag_and_zero_fill, only_entity
from hardwood.operators.scaling import standardize_series
from hardwood.operators.series import GameSeries, sliding_windows
from hardwood.operators.splits import chronological_split

UNSCALED = ("Team", "Against", "Home", "Date")


def player_windows(
    box: DataFrame,
    timestep: int,
    train_share: float = 0.92,
    player: str = "all",
    order: Sequence[str] = ("Date", "GameLink"),
    block_rows: int | None = None,
) -> DataFrame:
    """Score, zero-fill, index teams per player, split by time, scale on train, window."""
    scored = only_entity(box, "Player", player).withColumn("FDP", book_score("FDP"))
    numbers = feature_columns(scored, (), numeric_only=True)
    filled = scored.fillna(0, subset=numbers)
    index = first_seen_index(filled, ["Player"], order, ["Team", "Against"])
    for column in ("Team", "Against"):
        coded = apply_index(filled, index, ["Player"], column, "_idx", order)
        filled = coded.drop(column).withColumnRenamed("_idx", column)
    ignore = [*NOT_FEATURES, *[c for c in order if c != "Date"], "season"]
    features = [c for c in feature_columns(filled, ignore, numeric_only=True) if c != "Date"]
    # The lengths are counted before the joins, which do not change them.
    largest = profile(scored, ["Player"]).largest
    series = chronological_split(GameSeries.of(filled, ["Player"], order, block_rows, largest), train_share)
    scaled = standardize_series(series, [c for c in features if c not in UNSCALED], F.col("split") == "train")
    return sliding_windows(scaled, features, "FDP", "Date", timestep, ["split"])


def season_windows(
    box: DataFrame,
    columns: Sequence[str],
    timestep: int,
    train_share: float = 0.85,
    book: str = "FDP",
    order: Sequence[str] = ("Date", "GameLink"),
    scale: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """Pooled windows: split and windowed inside each (player, season).

    Teams get one index for all players; a team that never appears as ``Team`` gets 0.
    """
    scored = box.withColumn("book", book_score(book))
    index = global_index(scored, "Team")
    for column in ("Team", "Against"):
        coded = apply_index(scored, index, [], column, "_idx", ["Player", *order], unmatched=0)
        scored = coded.drop(column).withColumnRenamed("_idx", column)
    # Any null of the row counts as a missed game, also a percentage without an attempt.
    flagged = flag_and_zero_fill(scored, scored.columns)
    kept = flagged.select("Player", "season", *[c for c in order], *[c for c in columns if c not in order], "book")
    largest = profile(box, ["Player", "season"]).largest
    series = chronological_split(GameSeries.of(kept, ["Player", "season"], order, block_rows, largest), train_share)
    to_scale = [c for c in columns if c not in (*UNSCALED, "injured")]
    series = standardize_series(series, to_scale, F.col("split") == "train", enabled=scale)
    return sliding_windows(series, list(columns), "book", "Date", timestep, ["split"])
