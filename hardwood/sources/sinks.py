"""Writers. ``rebalance`` lets Spark split large and merge small output partitions."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.session import open_writers

OPEN_FILES = 16
PLAYER_BUCKETS = 256
PAGE_ROWS = 2_000


def _balanced(df: DataFrame, *keys: str) -> DataFrame:
    return df.hint("rebalance", *keys)


def write_seasons(df: DataFrame, path: str, season: str = "season", mode: str = "overwrite") -> None:
    """One folder per season. Overwriting replaces only the seasons that ``df`` holds."""
    _balanced(df, season).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(season).parquet(path)


def write_combined(df: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite") -> None:
    """Everything in one dataset."""
    writer = df.write.mode(mode)
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)


def write_players(
    df: DataFrame, path: str, player: str = "player", order: Sequence[str] = (), buckets: int = PLAYER_BUCKETS, page_rows: int = PAGE_ROWS
) -> None:
    """Rows of a player lie together in one of ``buckets`` folders, sorted.

    A folder per player would mean millions of tiny files; sorted buckets let readers of one player skip the rest: a
    Bloom filter rules out row groups, and the bounds of pages of ``page_rows`` rows all others but the player's own.
    """
    placed = df.withColumn("player_bucket", F.pmod(F.xxhash64(player), F.lit(buckets)).cast("int"))
    _balanced(placed, "player_bucket").sortWithinPartitions("player_bucket", player, *order).write.mode("overwrite").option(
        f"parquet.bloom.filter.enabled#{player}", "true"
    ).option("parquet.page.row.count.limit", page_rows).partitionBy("player_bucket").parquet(path)


def read_player(spark: SparkSession, path: str, player: str, name: str, buckets: int = PLAYER_BUCKETS) -> DataFrame:
    """One player's rows; only the player's bucket is read."""
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(name)), F.lit(buckets)).cast("int")).first()[0]
    return spark.read.parquet(path).where((F.col("player_bucket") == bucket) & (F.col(player) == name)).drop("player_bucket")


def write_prepared(df: DataFrame, path: str, keys: Sequence[str] = ("timestep", "split"), mode: str = "overwrite") -> None:
    """Prepared sets, partitioned so that a reader opens one timestep and one split."""
    _balanced(df, *keys).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def read_prepared(spark: SparkSession, path: str, timestep: int, split: str | None = None) -> DataFrame:
    """One prepared set; the partition filters prune the rest."""
    rows = spark.read.parquet(path).where(F.col("timestep") == timestep)
    return rows if split is None else rows.where(F.col("split") == split)


def rebuild(df: DataFrame, path: str, keys: Sequence[str] = (), together: bool = False) -> None:
    """Replace the whole output, including partitions that ``df`` no longer has.

    Where rows of a key already lie ``together``, as in tables read file by file, each task writes its few keys and nothing is
    shuffled; a task with more than ``OPEN_FILES`` keys sorts the rest.
    """
    writer = (_balanced(df, *keys) if keys and not together else df).write.mode("overwrite").option("partitionOverwriteMode", "static")
    with open_writers(df.sparkSession, OPEN_FILES) if together else nullcontext():
        (writer.partitionBy(*keys) if keys else writer).parquet(path)


def write_errors(errors: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Quarantine table ``(URL, Error)`` of a run; a rerun replaces it."""
    errors.select("URL", "Error").write.mode(mode).parquet(path)


def write_losses(losses: DataFrame, path: str, kind: str = "parquet") -> None:
    """Per-player losses, best first."""
    write_combined(losses.orderBy("mse", *[c for c in losses.columns if c != "mse"]), path, kind)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
