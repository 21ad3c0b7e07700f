"""Train / validation / test splits that a repartition cannot change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.operators.series import GameSeries


def hash_percent(key: Column, salt: str = "") -> Column:
    """Bucket 0..99 of a row key; the same row always gets the same bucket."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100


def random_split(df: DataFrame, key: str, train_percent: int = 80, salt: str = "") -> DataFrame:
    bucket = hash_percent(F.col(key), salt)
    return df.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))


def nested_split(df: DataFrame, key: str, train_percent: int = 80, fit_percent: int = 90, salt: str = "s10") -> DataFrame:
    """Test first, then validation out of the rest: 72 / 8 / 20 with the defaults."""
    outer = hash_percent(F.col(key), salt + "a")
    inner = hash_percent(F.col(key), salt + "b")
    split = F.when(outer >= train_percent, "test").when(inner < fit_percent, "train").otherwise("val")
    return df.withColumn("split", split)


def chronological_split(series: GameSeries, train_share: float) -> GameSeries:
    """First floor(share x n) games of an entity are train, the later ones test."""
    counted = series.aggregate(position="_pos", _n=F.count(F.lit(1)))
    last_train = F.floor(F.lit(float(train_share)) * F.col("_n"))
    marked = counted.with_columns(split=F.when(F.col("_pos") <= last_train, "train").otherwise("test"))
    return marked.drop("_pos", "_n")


def shuffled(df: DataFrame, key: str, salt: str = "") -> DataFrame:
    """A repeatable random order: by salted hash, then key."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(salt))), key)


def features_and_label(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return df.select(*features, F.col(label).alias("label"))
