"""Merging and comparing sources, coverage checks, set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hardwood.fixed_values import MONTH_PAGE, SEASON_MONTHS
from hardwood.operators.balance import attach, drop_known, keep_known


def merge_sources(
    left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Inner equi-join of two sources, balanced for a key that is frequent on the left.

    ``order`` should end with unique columns, so that a range sort can cut any group.
    """
    merged = attach(left, right, on, spread_by, "inner")
    return merged.orderBy(*order) if order else merged


def count_by_source(left: DataFrame, right: DataFrame, season: str) -> DataFrame:
    """Row counts of both sources side by side, per season."""
    sizes = [df.groupBy(season).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "n_left"), (right, "n_right"))]
    both = sizes[0].join(sizes[1], season, "full_outer").fillna(0, subset=["n_left", "n_right"])
    return both.withColumn("diff", F.col("n_left") - F.col("n_right"))


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys that only one source has. Both sides are reduced to distinct keys first."""
    marked = [df.select(*on).distinct().withColumn("side", F.lit(n)) for df, n in ((left, "left"), (right, "right"))]
    both = marked[0].unionByName(marked[1])
    per_key = both.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.first("side").alias("side"))
    return per_key.where(F.col("_n") == 1).drop("_n")


def shared(df: DataFrame, other: DataFrame, on: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Rows whose key the other source has too."""
    return keep_known(df, other, on, spread_by)


def only_new(df: DataFrame, loaded: DataFrame, on: Sequence[str], spread_by: Sequence[str]) -> DataFrame:
    """Rows whose key is not loaded yet."""
    return drop_known(df, loaded, on, spread_by)


def expected_months(seasons: DataFrame, season: str = "season", kind: str = "scrape_type") -> DataFrame:
    """Season x month grid with page address.

    Each season row carries its month list and is exploded, which needs no join.
    """
    months = F.create_map(*[x for k, v in SEASON_MONTHS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    grid = seasons.withColumn("month", F.explode(F.element_at(months, F.col(kind))))
    year = F.concat(F.lit("20"), F.substring_index(F.col(season), "-", -1))
    return grid.withColumn("page", F.format_string(MONTH_PAGE, year, F.col("month")))


def append(*tables: DataFrame, source: str | None = None) -> DataFrame:
    """Bag union by column name; a column a table lacks is null there."""
    marked = tables
    if source:
        marked = [t.withColumn(source, F.lit(i)) for i, t in enumerate(tables)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def distinct_of_columns(df: DataFrame, columns: Sequence[str], name: str = "value") -> DataFrame:
    """Set union of several columns in one scan."""
    values = F.explode(F.array(*[F.col(c).cast("string") for c in columns]))
    return df.select(values.alias(name)).distinct()


def without(df: DataFrame, column: str, ignore: Sequence) -> DataFrame:
    """Rows whose value is not in a fixed list."""
    return df.where(~F.col(column).isin(list(ignore)))


def matched_or_quarantine(df: DataFrame, found: Column) -> tuple[DataFrame, DataFrame]:
    """Split by a condition: (good, quarantine). Null counts as not found."""
    ok = F.coalesce(found, F.lit(False))
    return df.where(ok), df.where(~ok)
