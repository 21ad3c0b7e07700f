"""The balanced join gives the same rows with and without broadcast, also for a hot key."""

import pytest
from pyspark.sql import functions as F

from hardwood.operators import balance
from hardwood.operators.balance import attach, drop_known, keep_known, profile


@pytest.fixture(scope="module")
def big(spark):
    """A third of 30 000 rows has key 0; rows of a key are many copies."""
    return spark.range(30_000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).alias("k")
    )


def test_profile(spark, big):
    p = profile(big, ["k"])
    assert (p.rows, p.groups) == (30_000, 997)
    assert p.largest >= 10_000
    assert profile(big.where("false"), ["k"]).largest == 0


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.hardwood.blockRows", "1000")
    yield
    spark.conf.unset("spark.hardwood.blockRows")


def same(a, b):
    return sorted(map(tuple, a.select("row", "k", "v").collect())) == sorted(map(tuple, b.select("row", "k", "v").collect()))


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, big, small_blocks, how):
    small = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    salted = attach(big, small, ["k"], ["row"], how, rows=10)
    assert "_salt" in plan(salted)
    assert same(salted, big.join(small, "k", how))


def test_no_salt_without_a_hot_key(spark, big):
    small = spark.range(900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = attach(big, small, ["k"], ["row"], rows=10)
    assert "_salt" not in plan(joined) and "broadcast" not in plan(joined)
    assert same(joined, big.join(small, "k", "left"))


def test_hot_key_is_spread_evenly(spark, big):
    """Ten slots of about a thousand rows each."""
    spread = big.where("k = 0").select(F.pmod(F.xxhash64("row"), F.lit(10)).alias("s")).groupBy("s").count()
    assert spread.count() == 10 and spread.agg(F.max("count")).first()[0] < 1200


def test_semi_and_anti(spark, big, small_blocks):
    keys = spark.range(0, 500).select(F.col("id").alias("k")).union(spark.range(5).select(F.col("id").alias("k")))
    for limit in (None, 10):
        assert keep_known(big, keys, ["k"], ["row"], limit).count() == big.where("k < 500").count()
        assert drop_known(big, keys, ["k"], ["row"], limit).count() == big.where("k >= 500").count()


def test_wide_rows_are_not_broadcast(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert balance.within_limit(df)
    spark.conf.set("spark.hardwood.broadcastBytes", "50000")
    try:
        assert not balance.within_limit(df)
        assert balance.within_limit(df.select("id"))
    finally:
        spark.conf.unset("spark.hardwood.broadcastBytes")
