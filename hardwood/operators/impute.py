"""Missing values: group means, zero fill, row drops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.functions.clean import any_null, injured_flag
from hardwood.operators.balance import attach
from hardwood.operators.series import GameSeries
from hardwood.session import materialize


def _filled(column: str, mean: Column, digits: int | None) -> Column:
    return F.coalesce(F.col(column), mean if digits is None else F.round(mean, digits))


def group_means(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per group; null where the group has no value at all."""
    return df.groupBy(*group).agg(*[F.avg(c).alias(c) for c in columns])


def fill_group_mean(
    df: DataFrame, group: Sequence[str], columns: Sequence[str], spread_by: Sequence[str], digits: int | None = 2
) -> DataFrame:
    """Null -> mean of the row's group (player, or season and player).

    The means are combined before the shuffle and brought back by :func:`attach`, so
    the rows themselves stay where they are while the groups fit a broadcast.
    """
    means = group_means(df, group, columns).withColumnsRenamed({c: f"_mean_{c}" for c in columns})
    joined = attach(df, materialize(means, "means"), group, spread_by)
    filled = joined.withColumns({c: _filled(c, F.col(f"_mean_{c}"), digits) for c in columns})
    return filled.select(*df.columns)


def fill_series_mean(series: GameSeries, columns: Sequence[str], digits: int | None = 2) -> GameSeries:
    """The same for a series, sharing the exchange of its other features."""
    with_means = series.aggregate(**{f"_mean_{c}": F.avg(c) for c in columns})
    filled = with_means.with_columns(**{c: _filled(c, F.col(f"_mean_{c}"), digits) for c in columns})
    return filled.drop(*[f"_mean_{c}" for c in columns])


def rows_with_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(any_null(columns))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without null in ``columns``. A whole-row check would lose every row, because
    some columns of the feed are blank throughout."""
    return df.dropna("any", subset=list(columns))


def flag_and_zero_fill(df: DataFrame, columns: Sequence[str], flag: str = "injured") -> DataFrame:
    """Flag rows with a null first, then fill the numeric nulls with 0."""
    return df.withColumn(flag, injured_flag(columns)).fillna(0, subset=list(columns))


def nonzero_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target) != 0)


def feature_columns(df: DataFrame, ignore: Sequence[str], numeric_only: bool = False) -> list[str]:
    """All columns but the ignored ones, optionally only numbers."""
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return [
        name
        for name, kind in df.dtypes
        if name not in ignore and (not numeric_only or kind.startswith(numbers))
    ]


def only_entity(df: DataFrame, column: str, entity) -> DataFrame:
    """Rows of one entity; ``"all"`` keeps everything."""
    return df if entity == "all" else df.where(F.col(column) == entity)


def originals_first(df: DataFrame, derived: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in derived], *derived)
