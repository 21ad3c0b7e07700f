"""Category indexes and dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.operators.balance import attach
from hardwood.operators.series import GameSeries, numbered
from hardwood.session import limit, materialize


# Places of rows below this fit beside the column's number in one long.
_PLACES = 1 << 48


def first_seen_index(
    df: DataFrame, entity: Sequence[str], order: Sequence[str], columns: Sequence[str], block_rows: int | None = None
) -> DataFrame:
    """``(entity, category, idx)``: 1-based, in order of first appearance.

    All values of the first column come before values that only later columns have. Rows are reduced
    to one number per (entity, category), the column and the row's place in its order, which
    is combined before the shuffle; ``order`` must end with unique columns.
    """
    rows = GameSeries.of(df.select(*entity, *order, *columns), entity, order, block_rows).position("_place").result()
    sources = F.array(
        *[
            F.struct((F.lit(i * _PLACES) + F.col("_place")).alias("first"), F.col(c).cast("string").alias("category"))
            for i, c in enumerate(columns)
        ]
    )
    seen = rows.select(*entity, F.explode(sources).alias("s")).select(*entity, "s.*")
    first = materialize(seen.groupBy(*entity, "category").agg(F.min("first").alias("first")), "first")
    ranked = GameSeries.of(first, entity, ["first"], block_rows).position("idx").result()
    return materialize(ranked.select(*entity, "category", F.col("idx").cast("int").alias("idx")), "categories")


def global_index(df: DataFrame, column: str) -> DataFrame:
    """``(category, idx)``: 1-based by name over the distinct categories, numbered by range-sorted partitions."""
    distinct = df.select(F.col(column).cast("string").alias("category")).where(F.col("category").isNotNull()).distinct()
    places = numbered(distinct, ["category"], limit(df.sparkSession, "hardwood.blockRows"))
    return places.select("category", (F.col("_g") + 1).alias("idx"))


def apply_index(
    df: DataFrame,
    index: DataFrame,
    on: Sequence[str],
    column: str,
    output: str,
    spread_by: Sequence[str],
    unmatched: int | None = None,
) -> DataFrame:
    """Replace a category by its index; ``on`` holds the entity columns, if any."""
    renamed = index.withColumnsRenamed({"category": column, "idx": output})
    joined = attach(df, renamed, [*on, column], spread_by)
    if unmatched is not None:
        joined = joined.fillna(unmatched, subset=[output])
    return joined


def lookup(
    df: DataFrame, dim: DataFrame, column: str, key: str, value: str, output: str, spread_by: Sequence[str]
) -> DataFrame:
    """Left lookup of one attribute; unmatched rows get null."""
    renamed = dim.select(F.col(key).alias(column), F.col(value).alias(output))
    return attach(df, renamed, [column], spread_by)


def dim_table(spark, pairs: dict[str, str], key: str, value: str) -> DataFrame:
    """A dimension of fixed values as a DataFrame."""
    return spark.createDataFrame(list(pairs.items()), f"{key} string, {value} string")
