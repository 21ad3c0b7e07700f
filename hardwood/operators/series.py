"""Time-ordered features per entity, balanced for any distribution of entities.

A ``GameSeries`` is a table with an entity key and a total order inside each entity.
Its rows lie in one or two parts that give the same results:

* *whole*: entities of at most ``spark.hardwood.blockRows`` rows. All features use windows
  over the entity, so they share one exchange and one sort. One counting job over the
  entity column shows whether there are longer ones; mostly this is the only part.
* *blocked*: the longer entities. The rows are range-partitioned and sorted by
  (entity, order), written once, and numbered. Cutting the numbering every
  ``blockRows`` rows gives blocks of equal size, independent of how rows spread over
  entities or over time. Frames of bounded length look at most a few rows back or
  ahead, so each block also receives copies of its neighbours' edge rows; features
  that depend on the whole entity come from per-(block, entity) summaries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hardwood.operators.balance import profile, within_limit
from hardwood.session import limit, materialize

Feature = Callable[[WindowSpec], Column]


@dataclass(frozen=True)
class _Whole:
    """Rows of entities that fit a task."""

    rows: DataFrame
    entity: tuple[str, ...]
    order: tuple[str, ...]

    def _window(self, within: Sequence[str]) -> WindowSpec:
        return Window.partitionBy(*self.entity, *within).orderBy(*self.order)

    def neighbours(self, before: int, after: int, within: Sequence[str], features: dict[str, Feature]) -> DataFrame:
        window = self._window(within)
        return self.rows.withColumns({n: f(window) for n, f in features.items()})

    def aggregate(self, within: Sequence[str], position: str | None, aggregates: dict[str, Column]) -> DataFrame:
        # The order is not needed for the values; naming it lets all features share one sort.
        window = self._window(within)
        group = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        columns = {n: a.over(group) for n, a in aggregates.items()}
        if position:
            columns[position] = F.row_number().over(window).cast("long")
        return self.rows.withColumns(columns)

    def last_known(self, column: str, name: str, within: Sequence[str]) -> DataFrame:
        earlier = self._window(within).rowsBetween(Window.unboundedPreceding, -1)
        return self.rows.withColumn(name, F.last(column, ignorenulls=True).over(earlier))


@dataclass(frozen=True)
class _Blocked:
    """Numbered rows in blocks of ``size``."""

    rows: DataFrame
    entity: tuple[str, ...]
    size: int

    def neighbours(self, before: int, after: int, within: Sequence[str], features: dict[str, Feature]) -> DataFrame:
        # A row goes to all blocks that its frame reaches, however long the frame is.
        place = F.pmod(F.col("_g"), F.lit(self.size))
        ahead = F.floor((place + before) / F.lit(self.size))
        back = F.floor((F.lit(after - 1) - place) / F.lit(self.size)) + 1
        targets = F.sequence(F.col("_block") - back, F.col("_block") + ahead)
        copies = self.rows.withColumn("_at", F.explode(targets))
        window = Window.partitionBy("_at", *self.entity, *within).orderBy("_g")
        done = copies.withColumns({n: f(window) for n, f in features.items()})
        return done.where(F.col("_at") == F.col("_block")).drop("_at")

    def aggregate(self, within: Sequence[str], position: str | None, aggregates: dict[str, Column]) -> DataFrame:
        keys = [*self.entity, *within]
        totals = self.rows.groupBy(*keys).agg(F.min("_g").alias("_start"), *[a.alias(n) for n, a in aggregates.items()])
        # Brought back by (block, entity), a key no longer than a block.
        pairs = self.rows.select("_block", *keys).distinct()
        rows = _join(self.rows, _join(pairs, totals, keys), ["_block", *keys])
        if position:
            rows = rows.withColumn(position, F.col("_g") - F.col("_start") + 1)
        # Rows feed both sides of the join; writing them keeps chains of steps linear.
        return materialize(rows.drop("_start"), "totals")

    def last_known(self, column: str, name: str, within: Sequence[str]) -> DataFrame:
        keys = [*self.entity, *within]
        earlier = (Window.unboundedPreceding, -1)
        summary = self.rows.groupBy("_block", *keys).agg(
            F.max_by(column, F.when(F.col(column).isNotNull(), F.col("_g"))).alias("_seen")
        )
        carry = Window.partitionBy(*keys).orderBy("_block").rowsBetween(*earlier)
        summary = summary.select("_block", *keys, F.last("_seen", ignorenulls=True).over(carry).alias("_carry"))
        inside = Window.partitionBy("_block", *keys).orderBy("_g").rowsBetween(*earlier)
        rows = _join(self.rows, summary, ["_block", *keys]).withColumn(
            name, F.coalesce(F.last(column, ignorenulls=True).over(inside), F.col("_carry"))
        )
        return rows.drop("_carry")


@dataclass(frozen=True)
class GameSeries:
    parts: tuple[_Whole | _Blocked, ...]
    entity: tuple[str, ...]

    @staticmethod
    def of(
        df: DataFrame,
        entity: Sequence[str],
        order: Sequence[str],
        block_rows: int | None = None,
        largest: int | None = None,
    ) -> GameSeries:
        """``order`` must be unique within an entity. ``largest`` skips the size check."""
        entity, order = tuple(entity), tuple(order)
        size = limit(df.sparkSession, "hardwood.blockRows", block_rows)
        if largest is None:
            largest = profile(df, entity).largest
        if largest <= size:
            return GameSeries((_Whole(df, entity, order),), entity)
        sizes = df.groupBy(*entity).agg(F.count(F.lit(1)).alias("_n"))
        long = materialize(sizes.where(F.col("_n") > size).select(*entity, F.lit(True).alias("_long")), "long")
        if not within_limit(long):
            return GameSeries((_Blocked(numbered(df, [*entity, *order], size), entity, size),), entity)
        marked = _join(df, F.broadcast(long), entity)
        short_rows = marked.where(F.col("_long").isNull()).drop("_long")
        long_rows = marked.where(F.col("_long")).drop("_long")
        blocked = _Blocked(numbered(long_rows, [*entity, *order], size), entity, size)
        return GameSeries((_Whole(short_rows, entity, order), blocked), entity)

    def _each(self, change: Callable) -> GameSeries:
        return replace(self, parts=tuple(replace(p, rows=change(p)) for p in self.parts))

    def with_columns(self, **columns: Column) -> GameSeries:
        return self._each(lambda p: p.rows.withColumns(columns))

    def drop(self, *columns: str) -> GameSeries:
        return self._each(lambda p: p.rows.drop(*columns))

    def result(self) -> DataFrame:
        """All rows with their features."""
        return reduce(DataFrame.unionByName, [p.rows.drop("_g", "_block") for p in self.parts])

    def neighbours(self, before: int, after: int = 0, within: Sequence[str] = (), **features: Feature) -> GameSeries:
        """Add features whose frames reach ``before`` rows back and ``after`` rows ahead.

        ``within`` names columns that cut an entity further (split, season); each cut
        must be contiguous in the entity's order.
        """
        return self._each(lambda p: p.neighbours(before, after, within, features))

    def aggregate(self, within: Sequence[str] = (), position: str | None = None, **aggregates: Column) -> GameSeries:
        """Add per-entity aggregates, and the 1-based place in the order, to every row."""
        return self._each(lambda p: p.aggregate(within, position, aggregates))

    def position(self, name: str = "pos", within: Sequence[str] = ()) -> GameSeries:
        return self.aggregate(within, position=name)

    def last_known(self, column: str, name: str, within: Sequence[str] = ()) -> GameSeries:
        """Latest non-null value of an earlier row."""
        return self._each(lambda p: p.last_known(column, name, within))


def _join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join whose keys may be null."""
    renamed = right.withColumnsRenamed({k: f"_r_{i}" for i, k in enumerate(on)})
    condition = [F.col(k).eqNullSafe(F.col(f"_r_{i}")) for i, k in enumerate(on)]
    joined = left.join(renamed, condition, "left")
    return joined.drop(*[f"_r_{i}" for i in range(len(on))])


def numbered(df: DataFrame, keys: Sequence[str], block_rows: int) -> DataFrame:
    """Add ``_g``, the row's place in the order of ``keys``, and ``_block``.

    The sorted table is written before it is numbered: partition-dependent ids must
    not change when a lost partition is computed again. What reaches the driver is one
    count per partition.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_id", 33)
    sizes = {r["p"]: r["n"] for r in stored.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, seen = [], 0
    for p in sorted(sizes):
        offsets.append((p, seen))
        seen += sizes[p]
    starts = df.sparkSession.createDataFrame(offsets, "_p long, _offset long")
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.withColumn("_p", part)
        .join(F.broadcast(starts), "_p")
        .withColumn("_g", F.col("_offset") + place)
        .withColumn("_block", F.floor(F.col("_g") / F.lit(block_rows)).cast("long"))
        .drop("_p", "_offset", "_id")
    )


# -- features for ``neighbours`` ----------------------------------------------------


def lagged(column: str, steps: int) -> Feature:
    return lambda w: F.lag(column, steps).over(w)


def led(column: str, steps: int) -> Feature:
    return lambda w: F.lead(column, steps).over(w)


def full_history(steps: int) -> Feature:
    """True where ``steps`` earlier rows exist."""
    return lambda w: F.count(F.lit(1)).over(w.rowsBetween(-steps, -1)) == steps


def mean_of_previous(column: str, games: int) -> Feature:
    """Mean of the previous ``games`` rows without the current one; null until they exist.

    Nulls inside the frame are skipped.
    """

    def build(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-games, -1)
        return F.when(F.count(F.lit(1)).over(frame) == games, F.avg(column).over(frame))

    return build


def window_of_previous(columns: Sequence[str], steps: int) -> Feature:
    """array<struct> of the previous ``steps`` rows, oldest first; null until they exist."""

    def build(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-steps, -1)
        return F.when(
            F.count(F.lit(1)).over(frame) == steps,
            F.collect_list(F.struct(*columns)).over(frame),
        )

    return build


# -- whole operators ------------------------------------------------------------------


def lag_features(series: GameSeries, columns: Sequence[str], steps: int) -> GameSeries:
    """``{column}_{k}`` for k = 1..steps, all from one window."""
    features = {f"{c}_{k}": lagged(c, k) for c in columns for k in range(1, steps + 1)}
    return series.neighbours(steps, 0, **features)


def lag_depth(series: GameSeries, columns: Sequence[str], steps: int) -> DataFrame:
    """All lags 1..steps of the rows with a value, and ``depth``: how many of them are there.

    The set for n lags is every row with ``depth >= n``, so one wide table holds all sets
    and no row is repeated for each.
    """
    wide = lag_features(series, columns, steps).result().dropna("any", subset=list(columns))
    missing = [F.when(any_missing(columns, k), k - 1) for k in range(1, steps + 1)]
    return wide.withColumn("depth", F.coalesce(*missing, F.lit(steps)))


def any_missing(columns: Sequence[str], k: int) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"{c}_{k}").isNull() for c in columns])


def lag_set(wide: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The rows with ``n`` complete lags, without the deeper ones."""
    deeper = [c for c in wide.columns for base in columns if c.startswith(f"{base}_") and c[len(base) + 1 :].isdigit() and int(c[len(base) + 1 :]) > n]
    return wide.where(F.col("depth") >= n).drop("depth", *deeper).withColumn("timestep", F.lit(n))


def lag_sets(series: GameSeries, columns: Sequence[str], depths: Sequence[int]) -> DataFrame:
    """One set of complete rows per depth, marked by ``timestep``; deeper lags are null.

    This repeats a row once per set it belongs to. To store sets, keep :func:`lag_depth`.
    """
    wide = lag_depth(series, columns, max(depths))
    wanted = F.filter(F.array(*[F.lit(d) for d in depths]), lambda d: d <= F.col("depth"))
    sets = wide.withColumn("timestep", F.explode(wanted)).drop("depth")
    return sets.withColumns(
        {f"{c}_{k}": F.when(F.col("timestep") >= k, F.col(f"{c}_{k}")) for c in columns for k in range(1, max(depths) + 1)}
    )


def lead_features(series: GameSeries, columns: Sequence[str], steps: int) -> GameSeries:
    """``{column}_{k}`` = value k rows later. Future values: for labels only."""
    features = {f"{c}_{k}": led(c, k) for c in columns for k in range(1, steps + 1)}
    return series.neighbours(0, steps, **features)


def previous_means(series: GameSeries, columns: Sequence[str], games: int) -> GameSeries:
    """``{games}_{column}`` = mean of the previous games."""
    return series.neighbours(games, 0, **{f"{games}_{c}": mean_of_previous(c, games) for c in columns})


def sliding_windows(
    series: GameSeries,
    features: Sequence[str],
    target: str,
    date: str,
    steps: int,
    within: Sequence[str] = (),
) -> DataFrame:
    """One row per target game with the ``steps`` games before it; short histories are absent.

    Only the wanted columns enter the arrays, because each row is repeated ``steps`` times.
    """
    built = series.neighbours(
        steps,
        0,
        within,
        window=window_of_previous(features, steps),
        window_dates=window_of_previous([date], steps),
    )
    return (
        built.result()
        .where(F.col("window").isNotNull())
        .select(
            *series.entity,
            *within,
            F.col(date).alias("target_date"),
            "window",
            F.col(f"window_dates.{date}").alias("window_dates"),
            F.col(target).alias("y"),
        )
    )


def window_features(windows: DataFrame, columns: Sequence[str], steps: int, window: str = "window") -> DataFrame:
    """Flatten an array of ``steps`` rows into model features: ``{column}_{i}``, the oldest row first (0)."""
    cells = {f"{c}_{i}": F.get(f"{window}.{c}", F.lit(i)).cast("double") for i in range(steps) for c in columns}
    return windows.withColumns(cells).drop(window)


def change_since_last(series: GameSeries, column: str, name: str) -> GameSeries:
    """Difference to the last listed (non-null) value."""
    known = series.last_known(column, "_last")
    return known.with_columns(**{name: F.col(column) - F.col("_last")}).drop("_last")
