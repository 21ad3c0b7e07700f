"""Scaling fitted per group, on the training rows only unless asked otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.operators.balance import attach
from hardwood.operators.series import GameSeries
from hardwood.session import materialize


def _fit(column: str, fit_on: Column | None) -> Column:
    return F.col(column) if fit_on is None else F.when(fit_on, F.col(column))


def _unit(scale: Column) -> Column:
    return F.when(scale == 0, F.lit(1.0)).otherwise(scale)


def standard_parameters(
    df: DataFrame, group: Sequence[str], columns: Sequence[str], fit_on: Column | None = None
) -> DataFrame:
    """Mean and population deviation per group, wide: ``mean_c``, ``scale_c``."""
    parts = []
    for c in columns:
        parts += [F.avg(_fit(c, fit_on)).alias(f"mean_{c}"), _unit(F.stddev_pop(_fit(c, fit_on))).alias(f"scale_{c}")]
    return df.groupBy(*group).agg(*parts)


def parameter_table(parameters: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long form ``(group, feature, mean, scale)`` to store next to a model."""
    items = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"mean_{c}").alias("mean"), F.col(f"scale_{c}").alias("scale")) for c in columns]
    )
    return parameters.select(*group, F.inline(items))


def standardize(
    df: DataFrame,
    group: Sequence[str],
    columns: Sequence[str],
    spread_by: Sequence[str],
    fit_on: Column | None = None,
    enabled: bool = True,
) -> DataFrame:
    """(x - mean) / deviation with the group's parameters; a constant column becomes 0."""
    if not enabled:
        return df
    parameters = materialize(standard_parameters(df, group, columns, fit_on), "scaling")
    joined = attach(df, parameters, group, spread_by)
    scaled = joined.withColumns({c: (F.col(c) - F.col(f"mean_{c}")) / F.col(f"scale_{c}") for c in columns})
    return scaled.select(*df.columns)


def standardize_series(
    series: GameSeries, columns: Sequence[str], fit_on: Column | None = None, enabled: bool = True
) -> GameSeries:
    """The same inside a series, on the exchange its windows already need."""
    if not enabled:
        return series
    parts = {}
    for c in columns:
        parts[f"_mean_{c}"] = F.avg(_fit(c, fit_on))
        parts[f"_dev_{c}"] = F.stddev_pop(_fit(c, fit_on))
    fitted = series.aggregate(**parts)
    scaled = fitted.with_columns(
        **{c: (F.col(c) - F.col(f"_mean_{c}")) / _unit(F.col(f"_dev_{c}")) for c in columns}
    )
    return scaled.drop(*parts)


def minmax(
    df: DataFrame,
    columns: Sequence[str],
    spread_by: Sequence[str],
    split: str = "split",
    fit_scope: str = "train",
) -> DataFrame:
    """(x - min) / (max - min), a zero range counts as 1.

    ``fit_scope="train"`` uses the training rows for all; ``"split"`` fits every split
    on itself, which lets test rows see their own range.
    """
    if fit_scope not in ("train", "split"):
        raise ValueError(f"fit_scope {fit_scope!r}")
    per_split = fit_scope == "split"
    fit_on = None if per_split else F.col(split) == "train"
    parts = []
    for c in columns:
        value = _fit(c, fit_on)
        parts += [F.min(value).alias(f"min_{c}"), _unit(F.max(value) - F.min(value)).alias(f"range_{c}")]
    if per_split:
        joined = attach(df, df.groupBy(split).agg(*parts), [split], spread_by)
    else:
        # One row of ranges: a broadcast of fixed size.
        ranges = df.agg(*parts).withColumn("_one", F.lit(1))
        joined = df.withColumn("_one", F.lit(1)).join(F.broadcast(ranges), "_one")
    scaled = joined.withColumns({c: (F.col(c) - F.col(f"min_{c}")) / F.col(f"range_{c}") for c in columns})
    return scaled.select(*df.columns)


def single_step(columns: Sequence[str]) -> Column:
    """Features as a one-step sequence: [[f1, f2, ...]]."""
    return F.array(F.array(*[F.col(c).cast("double") for c in columns]))
