"""Feed files -> cleaned seasons -> imputed -> lag sets with nested splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hardwood.operators.impute import fill_series_mean
from hardwood.operators.series import GameSeries, lag_depth, lag_set
from hardwood.operators.splits import nested_split
from hardwood.session import small_disk, work_scope
from hardwood.sources.delimited import checked_feed, parsed_feed
from hardwood.sources.sinks import rebuild, write_combined, write_errors


def clean_feed_folder(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Clean all complete files; write combined, per season, and what was rejected.

    Files that lack a column, lines that do not parse and cells that cannot be read are rows of the errors table; such
    files and lines are absent from the clean output. Files are parsed once, in the pass that reads their cells; a rerun gives
    the same tables. What that pass stores goes before the seasons are written; as each file is of one season, these need no
    shuffle.
    """
    with small_disk(spark):
        with work_scope(spark):
            raw, rejected = parsed_feed(spark, folder)
            account = checked_feed(raw, F.col("_path"))
            cleaned = account.clean
            write_combined(cleaned, f"{target}/combined")
            write_errors(rejected.unionByName(account.errors), f"{target}/errors")
        combined = spark.read.schema(cleaned.schema).parquet(f"{target}/combined")
        rebuild(combined, f"{target}/seasons", ["season"], together=True)
    return combined


def shifted_sets(
    feed: DataFrame, steps: int = 20, column: str = "FDP", digits: int | None = 2, block_rows: int | None = None
) -> DataFrame:
    """Impute per (season, player), lag up to ``steps`` games, and split 72 / 8 / 20.

    One row per game; ``depth`` tells which sets it belongs to. A game is in the same
    split in all sets, so a longer history never leaks a test game of a shorter one.
    """
    series = GameSeries.of(feed, ["season", "Player"], ["Date", "GameID"], block_rows)
    series = fill_series_mean(series, [column, "FDSal"], digits)
    key = F.concat_ws("|", "season", "Player", F.col("Date").cast("string"), "GameID")
    return nested_split(lag_depth(series, [column], steps).withColumn("row_key", key), "row_key")


def prepare_shifted(feed: DataFrame, target: str, steps: int = 20) -> None:
    """Write the sets once, partitioned by depth and split; sets of an earlier run go."""
    rebuild(shifted_sets(feed, steps), target, ("depth", "split"))


def read_shifted(spark: SparkSession, path: str, timestep: int, split: str | None = None, column: str = "FDP") -> DataFrame:
    """The set with ``timestep`` lags; shallower partitions and other splits are not read."""
    rows = spark.read.parquet(path)
    return lag_set(rows if split is None else rows.where(F.col("split") == split), [column], timestep)
