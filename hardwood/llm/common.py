"""Reading of the tables, words, and small helpers that several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII white-space characters; ``bytes.split()`` gives the same.
WORD = r"[^\x20\x09-\x0D]+"

# Whole texts pass through Arrow, so a batch is bounded by rows and by bytes.
ARROW_ROWS, ARROW_BYTES = 2_000, 16 * 1024 * 1024


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings for tables of long texts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wrapped(docs: DataFrame) -> DataFrame:
    """All columns as one struct ``doc``, so that working columns cannot clash with them."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"))


def unwrapped(rows: DataFrame) -> DataFrame:
    return rows.select("doc.*")


def text_of(column: str | Column) -> Column:
    """The text, empty for null."""
    return F.coalesce(column if isinstance(column, Column) else F.col(column), F.lit(""))


def n_words(text: Column) -> Column:
    """Number of words; null counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_fraction(*parts: Column, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of the parts: the same on every run, engine and partitioning."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))
