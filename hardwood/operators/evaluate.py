"""Residuals, error metrics, tags, histograms and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.session import materialize


def residual(actual: str, predicted: str, sign: str = "actual-predicted") -> Column:
    a, p = F.col(actual), F.col(predicted)
    if sign == "actual-predicted":
        return a - p
    if sign == "predicted-actual":
        return p - a
    raise ValueError(f"sign {sign!r}")


def metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), tolerance: float = 3.0) -> DataFrame:
    """MSE, MAE, and how many predictions are over or under by ``tolerance``; one pass."""
    gap = residual(actual, predicted, "predicted-actual")
    return df.groupBy(*by).agg(
        F.count(gap).alias("n"),
        F.avg(gap * gap).alias("mse"),
        F.avg(F.abs(gap)).alias("mae"),
        F.count_if(gap >= tolerance).alias("over"),
        F.count_if(gap <= -tolerance).alias("under"),
    )


def good_prediction(actual: str, predicted: str, lower: float | None = -4.0, tolerance: float = 7.0) -> Column:
    """``good`` within the tolerance and, with ``lower``, where actual - predicted is above it."""
    gap = residual(actual, predicted)
    ok = F.abs(gap) <= tolerance
    if lower is not None:
        ok = ok & (gap > lower)
    return F.when(ok, "good").otherwise("bad")


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over the column's range; the maximum belongs to the last bin.

    The range is one row, joined back by broadcast.
    """
    value = F.col(column)
    limits = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")).withColumn("_one", F.lit(1))
    placed = df.select(value.alias("_x")).where(F.col("_x").isNotNull()).withColumn("_one", F.lit(1)).join(F.broadcast(limits), "_one")
    width = F.col("_hi") - F.col("_lo")
    step = F.floor(F.lit(float(bins)) * (F.col("_x") - F.col("_lo")) / F.when(width == 0, F.lit(1.0)).otherwise(width))
    number = F.least(step, F.lit(bins - 1)) + 1
    return placed.groupBy(number.cast("int").alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n")).select(
        "bin",
        (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("low"),
        "n",
    )


def best_and_worst(per_entity: DataFrame, entity: str, loss: str = "mse", games: str = "n", k: int = 3, at_least: int = 10) -> DataFrame:
    """The ``k`` entities with the lowest and the highest loss among those with enough games."""
    # Both ends read the losses, one row per entity, which are computed once.
    enough = materialize(per_entity.where(F.col(games) >= at_least), "losses")
    best = enough.orderBy(F.col(loss).asc(), entity).limit(k).withColumn("side", F.lit("best"))
    worst = enough.orderBy(F.col(loss).desc(), entity).limit(k).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
