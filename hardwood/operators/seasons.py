"""Features kept up load by load: a new season is added without reading the old ones.

A store holds, below one folder and for each load, the features of that load's games, the *tail* of every entity (its last
``reach`` games) and its totals. A load reads its own games and the last load's tails and totals, nothing else: frames
that look at most ``reach`` games back are exact with the tail in front.

A load is written under its number, features last; a load that was broken off is done again and replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hardwood.operators.balance import attach
from hardwood.operators.series import GameSeries
from hardwood.session import materialize


@dataclass(frozen=True)
class SeasonStore:
    """``features`` adds columns to a series whose frames reach at most ``reach`` games back."""

    path: str
    entity: tuple[str, ...]
    order: tuple[str, ...]
    columns: tuple[str, ...]
    reach: int
    features: Callable[[GameSeries], GameSeries]

    def _part(self, name: str, load: int) -> str:
        return f"{self.path.rstrip('/')}/{name}/load={load}"

    def add(self, games: DataFrame, load: int, block_rows: int | None = None) -> DataFrame:
        """Add load ``load`` (from 0 on, one after the other) and return its features.

        Beside those of ``features``: ``games_before`` and, for each of ``columns``, ``{c}_before``, the entity's
        sum over all earlier loads. Games must be later than the entity's games of earlier loads; a load
        with others is refused, as features already written could not be right.
        """
        spark = games.sparkSession
        keys, kept = list(self.entity), games.columns
        games = materialize(games, "load")
        rows = games.withColumn("_new", F.lit(True))
        if load:
            tail = spark.read.parquet(self._part("tails", load - 1))
            place = F.struct(*self.order)
            last = tail.groupBy(*keys).agg(F.max(place).alias("_last"))
            late = attach(games, materialize(last, "last"), keys, self.order, "inner").where(place <= F.col("_last"))
            if not late.isEmpty():
                raise ValueError(f"load {load} has games that are not later than those of earlier loads")
            rows = rows.unionByName(tail.withColumn("_new", F.lit(False)))
            totals = spark.read.parquet(self._part("totals", load - 1))
        rows = materialize(rows, "rows")
        built = self.features(GameSeries.of(rows, self.entity, self.order, block_rows)).result().where("_new").drop("_new")
        if load:
            built = attach(built, totals, keys, self.order)
        else:
            built = built.withColumns({"games_before": F.lit(None).cast("long")} | {f"{c}_before": F.lit(None).cast("double") for c in self.columns})
        filled = {"games_before": F.coalesce("games_before", F.lit(0).cast("long"))}
        filled |= {f"{c}_before": F.coalesce(f"{c}_before", F.lit(0.0)) for c in self.columns}
        # The limit of a rank is applied before rows are exchanged, so a long series sends no more than its tail.
        latest = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in self.order]))
        tails = rows.select(*kept, latest.alias("_back")).where(F.col("_back") <= self.reach).drop("_back")
        tails.write.mode("overwrite").parquet(self._part("tails", load))
        sums = [F.sum(F.col(c).cast("double")).alias(f"{c}_before") for c in self.columns]
        added = games.groupBy(*keys).agg(F.count(F.lit(1)).alias("games_before"), *sums)
        if load:
            added = totals.unionByName(added).groupBy(*keys).agg(F.sum("games_before").alias("games_before"), *[F.sum(f"{c}_before").alias(f"{c}_before") for c in self.columns])
        added.write.mode("overwrite").parquet(self._part("totals", load))
        built.withColumns(filled).write.mode("overwrite").parquet(self._part("features", load))
        return spark.read.parquet(self._part("features", load))

    def read(self, spark: SparkSession) -> DataFrame:
        """The features of all loads, with ``load``."""
        return spark.read.parquet(f"{self.path.rstrip('/')}/features")
