"""Size checks, and a join that stays balanced whatever the key distribution."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.session import limit, materialize

# At most this many keys are treated as hot, so their table can be broadcast.
HOT_KEYS = 1_000_000


@dataclass(frozen=True)
class Profile:
    """Rows, groups and rows of the largest group."""

    rows: int
    groups: int
    largest: int


def profile(df: DataFrame, keys: Sequence[str]) -> Profile:
    """One job: counts are combined before the shuffle, one row comes back."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.sum("n").alias("rows"), F.count("n").alias("groups"), F.max("n").alias("largest")).first()
    return Profile(row["rows"] or 0, row["groups"], row["largest"] or 0)


def within_limit(df: DataFrame, rows: int | None = None) -> bool:
    """True if ``df`` is small enough to broadcast, by rows and by bytes.

    Bytes are eight per value, and the length of everything that is text or nested; they
    are only looked at when the number of rows, which a stored table knows, is small.
    """
    spark = df.sparkSession
    found = df.count()
    if found > limit(spark, "hardwood.broadcastRows", rows):
        return False
    wide = [n for n, kind in df.dtypes if kind in ("string", "binary") or "<" in kind]
    size = 8 * len(df.columns) * found
    if wide:
        length = sum((F.coalesce(F.octet_length(F.col(f"`{n}`").cast("string")), F.lit(0)) for n in wide), F.lit(0))
        size += df.agg(F.sum(length)).first()[0] or 0
    return size <= limit(spark, "hardwood.broadcastBytes")


def attach(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    rows: int | None = None,
) -> DataFrame:
    """Equi-join ``big`` to ``small`` (one row per key) without a hot partition.

    Within the broadcast limits (``rows`` overrides one), ``small`` is broadcast and ``big``
    does not move. Beyond, both sides are shuffled. If a key of ``big`` then has more rows
    than ``spark.hardwood.blockRows``, its rows are spread over as many slots as it has
    blocks, by the hash of ``spread_by`` (columns that tell the rows of one key apart),
    and only the hot keys' rows of ``small`` are repeated for each slot. Materialize a
    ``small`` that is costly to compute: it is read for the check and again for the join.
    """
    on = list(on)
    if within_limit(small, rows):
        return big.join(F.broadcast(small), on, how)
    shape = profile(big, on)
    block = max(limit(big.sparkSession, "hardwood.blockRows"), shape.rows // HOT_KEYS)
    if shape.largest <= block:
        return big.join(small, on, how)
    sizes = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
    slots = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    # Fewer than shape.rows / block <= HOT_KEYS rows.
    hot = materialize(sizes.select(*on, slots.alias("_slots")), "hot")
    salt = F.pmod(F.xxhash64(*spread_by), F.col("_slots")).cast("int")
    left = big.join(F.broadcast(hot), on, "left").withColumn("_salt", F.coalesce(salt, F.lit(0)))
    every = F.sequence(F.lit(0), F.coalesce(F.col("_slots"), F.lit(1)) - 1)
    right = small.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(every)).drop("_slots")
    return left.drop("_slots").join(right, [*on, "_salt"], how).drop("_salt")


def keep_known(big: DataFrame, keys: DataFrame, on: Sequence[str], spread_by: Sequence[str], rows: int | None = None) -> DataFrame:
    """Semi-join with the same care as :func:`attach`."""
    return attach(big, materialize(keys.select(*on).distinct(), "keys"), on, spread_by, "inner", rows)


def drop_known(big: DataFrame, keys: DataFrame, on: Sequence[str], spread_by: Sequence[str], rows: int | None = None) -> DataFrame:
    """Anti-join with the same care as :func:`attach`."""
    marked = materialize(keys.select(*on).distinct().withColumn("_known", F.lit(True)), "keys")
    return attach(big, marked, on, spread_by, "left", rows).where(F.col("_known").isNull()).drop("_known")
