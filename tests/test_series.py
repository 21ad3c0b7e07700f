"""Ordered features: both layouts against a plain pandas computation, and invariants."""

import math
import random
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import rows

from hardwood.operators.impute import fill_group_mean, fill_series_mean
from hardwood.operators.series import (
    GameSeries, change_since_last, full_history, lag_features, lag_sets, lead_features, previous_means, sliding_windows,
)
from hardwood.operators.splits import chronological_split
from hardwood.operators.scaling import standardize_series

LENGTHS = {"none": 0, "one": 1, "two": 2, "three": 3, "four": 4, "hot": 90, "mid": 23}


@pytest.fixture(scope="module")
def log():
    """Seven players; one holds most of the rows, and some games share a date."""
    rng = random.Random(5)
    rows, game = [], 0
    for player, length in LENGTHS.items():
        for i in range(length):
            game += 1
            y = None if rng.random() < 0.2 else round(rng.uniform(0, 50), 1)
            rows.append((player, f"2020-01-{1 + (i // 3) % 28:02d}", i, game, y, round(rng.uniform(0, 9), 1)))
    return pd.DataFrame(rows, columns=["player", "day", "seq", "game", "y", "x"])


def frame(spark, log, seed=0, parts=5):
    shuffled = log.sample(frac=1, random_state=seed)
    data = [[None if isinstance(v, float) and math.isnan(v) else v for v in r] for r in shuffled.itertuples(index=False)]
    return spark.createDataFrame(data, "player string, day string, seq long, game long, y double, x double").repartition(parts)


def series(df, block, largest=None):
    return GameSeries.of(df, ["player"], ["seq", "game"], block, largest)


def features(df, block):
    s = series(df, block)
    s = s.aggregate(position="pos", n=F.count(F.lit(1)), mean=F.avg("y"))
    s = change_since_last(s, "y", "change")
    s = lag_features(s, ["y"], 4)
    s = lead_features(s.with_columns(z=F.col("x")), ["z"], 2)
    s = previous_means(s, ["y", "x"], 2)
    s = s.neighbours(3, 0, ready=full_history(3))
    return s.result().toPandas().sort_values("game").reset_index(drop=True)


def expected(log):
    out = []
    for _, g in log.sort_values(["player", "seq"]).groupby("player"):
        g = g.copy()
        g["pos"] = range(1, len(g) + 1)
        g["n"] = len(g)
        g["mean"] = g["y"].mean()
        g["change"] = g["y"] - g["y"].ffill().shift(1)
        for k in range(1, 5):
            g[f"y_{k}"] = g["y"].shift(k)
        for k in (1, 2):
            g[f"z_{k}"] = g["x"].shift(-k)
        for c in ("y", "x"):
            past = [g[c].iloc[max(0, i - 2) : i] for i in range(len(g))]
            g[f"2_{c}"] = [p.mean() if len(p) == 2 else None for p in past]
        g["ready"] = g["pos"] > 3
        out.append(g)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", FutureWarning)
        return pd.concat(out).sort_values("game").reset_index(drop=True)


@pytest.mark.parametrize("block", [1_000_000, 40, 5])
def test_features_match_pandas(spark, log, block):
    got, want = features(frame(spark, log), block), expected(log)
    assert len(got) == len(want)
    for column in ["pos", "n", "mean", "change", "y_1", "y_2", "y_3", "y_4", "z_1", "z_2", "2_y", "2_x"]:
        a, b = got[column].astype(float), want[column].astype(float)
        assert ((a - b).abs() < 1e-9).eq(b.notna()).all() and a.isna().eq(b.isna()).all(), column
    assert got["ready"].tolist() == want["ready"].tolist()


def test_layout_follows_the_longest_series(spark, log):
    df = frame(spark, log)
    kinds = lambda s: [type(p).__name__ for p in s.parts]
    assert kinds(series(df, 90)) == ["_Whole"]
    assert kinds(series(df, 10, largest=10)) == ["_Whole"]
    cut = series(df, 89)
    assert kinds(cut) == ["_Whole", "_Blocked"]
    assert [p.rows.count() for p in cut.parts] == [sum(LENGTHS.values()) - 90, 90]
    spark.conf.set("spark.hardwood.broadcastRows", "0")
    try:
        assert kinds(series(df, 89)) == ["_Blocked"]
    finally:
        spark.conf.unset("spark.hardwood.broadcastRows")


def test_missing_entity_is_an_entity(spark):
    """Rows without a player form one long series, too."""
    df = spark.range(60).select(F.when(F.col("id") % 3 == 0, "a").alias("player"), F.col("id").alias("seq"), F.lit(1).alias("game"))
    for block in (1_000, 30, 7):
        got = series(df, block).position("pos").result().groupBy("player").agg(F.max("pos").alias("m")).collect()
        assert {r["player"]: r["m"] for r in got} == {"a": 20, None: 40}


def test_blocks_have_equal_size(spark, log):
    blocks = series(frame(spark, log), 25).parts[-1].rows.groupBy("_block").count().collect()
    assert sorted(b["count"] for b in blocks)[1:] == [25] * (len(blocks) - 1)


@pytest.mark.parametrize("block", [1, 3, 7])
def test_frame_longer_than_block(spark, log, block):
    """A frame that spans many blocks gives what one block gives."""
    df = frame(spark, log)
    for features in (lag_features, lead_features):
        whole = features(series(df, 1_000_000), ["y"], 8).result()
        cut = features(series(df, block), ["y"], 8).result()
        assert rows(cut.select(whole.columns), *whole.columns) == rows(whole, *whole.columns)


def test_lag_sets_row_counts(spark, log):
    """Without nulls, set n holds the games after the first n of every player."""
    df = frame(spark, log).withColumn("v", F.col("x"))
    for block in (1_000_000, 30):
        sets = lag_sets(series(df, block), ["v"], [1, 2, 5])
        counts = {r["timestep"]: r["count"] for r in sets.groupBy("timestep").count().collect()}
        assert counts == {n: sum(max(0, length - n) for length in LENGTHS.values()) for n in (1, 2, 5)}
        deep = sets.where("timestep = 1 AND v_2 IS NOT NULL").count()
        assert deep == 0


@pytest.mark.parametrize("block", [1_000_000, 12])
def test_windows_stay_inside_split(spark, log, block):
    split = chronological_split(series(frame(spark, log), block), 0.92)
    windows = sliding_windows(split, ["x"], "y", "seq", 3, ["split"]).toPandas()
    for player, length in LENGTHS.items():
        train = int(0.92 * length)
        mine = windows[windows["player"] == player]
        assert (mine["split"] == "train").sum() == max(0, train - 3)
        assert (mine["split"] == "test").sum() == max(0, length - train - 3)
    x = {(r.player, r.seq): r.x for r in log.itertuples()}
    for r in windows.itertuples():
        assert list(r.window_dates) == [r.target_date - 3, r.target_date - 2, r.target_date - 1]
        assert [w["x"] for w in r.window] == [x[r.player, d] for d in r.window_dates]


@pytest.mark.parametrize("block", [1_000_000, 12])
def test_train_rows_are_standardized(spark, log, block):
    split = chronological_split(series(frame(spark, log).withColumn("same", F.lit(4.0)), block), 0.85)
    scaled = standardize_series(split, ["x", "same"], F.col("split") == "train").result()
    stats = scaled.where("split = 'train'").groupBy("player").agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"), F.stddev_pop("x").alias("s"), F.max("same").alias("c")
    )
    for r in stats.collect():
        assert abs(r["m"]) < 1e-9 and r["c"] == 0.0
        assert r["n"] == 1 or abs(r["s"] - 1) < 1e-9


def test_repartition_changes_nothing(spark, log):
    first = features(frame(spark, log, 1, 2), 20)
    second = features(frame(spark, log, 2, 9), 20)
    pd.testing.assert_frame_equal(first, second[first.columns])


def test_group_mean_is_rounded_and_null_without_values(spark, log):
    df = frame(spark, log.assign(y=lambda d: d["y"].where(d["player"] != "two")))
    plain = fill_group_mean(df, ["player"], ["y"], ["game"]).toPandas().set_index("game")["y"]
    for block in (1_000_000, 15):
        s = fill_series_mean(series(df, block), ["y"]).result().toPandas().set_index("game")["y"]
        pd.testing.assert_series_equal(plain.sort_index(), s.sort_index())
    means = log[log["player"] != "two"].groupby("player")["y"].mean().round(2)
    for r in log.itertuples():
        if r.player == "two":
            assert math.isnan(plain[r.game])
        elif math.isnan(r.y):
            assert plain[r.game] == pytest.approx(means[r.player], abs=0.011)
        else:
            assert plain[r.game] == r.y
