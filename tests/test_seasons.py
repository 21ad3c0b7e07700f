"""Features kept up load by load."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from hardwood.operators.seasons import SeasonStore
from hardwood.operators.series import GameSeries, lag_features, previous_means

FIELDS = "player string, day int, game int, pts double"


def features(series):
    return previous_means(lag_features(series, ["pts"], 4), ["pts"], 3)


def games(n=300):
    rng = random.Random(2)
    return [(rng.choice("aaaaabcd"), i // 3, i, None if rng.random() < 0.1 else float(rng.randint(0, 40))) for i in range(n)]


def store(path):
    return SeasonStore(str(path), ("player",), ("day", "game"), ("pts",), 4, features)


@pytest.mark.parametrize("block", [1_000_000, 7])
def test_loads_equal_one(spark, tmp_path, block):
    whole = games() + [("new", 99, 1_000, 1.0)]
    cuts = [0, 120, 121, 250, len(whole)]
    kept = store(tmp_path / "s")
    for load, (a, b) in enumerate(zip(cuts, cuts[1:])):
        kept.add(spark.createDataFrame(whole[a:b], FIELDS), load, block)
    names = ["player", "day", "game", "pts", "pts_1", "pts_2", "pts_3", "pts_4", "3_pts"]
    once = features(GameSeries.of(spark.createDataFrame(whole, FIELDS), ["player"], ["day", "game"])).result()
    assert rows(kept.read(spark).select(names), "game") == rows(once.select(names), "game")
    place = {g[2]: next(i for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a <= k < b) for k, g in enumerate(whole)}
    for r in kept.read(spark).collect():
        earlier = [g for g in whole if g[0] == r["player"] and place[g[2]] < place[r["game"]]]
        assert (r["games_before"], r["pts_before"]) == (len(earlier), sum(g[3] or 0.0 for g in earlier))


def test_a_load_reads_tails_and_its_own_games(spark, tmp_path):
    """Old features may be gone, and tails stay short."""
    whole = games(600)
    kept = store(tmp_path / "s")
    kept.add(spark.createDataFrame(whole[:400], FIELDS), 0)
    kept.add(spark.createDataFrame(whole[400:500], FIELDS), 1)
    for gone in ("features/load=0", "features/load=1", "tails/load=0", "totals/load=0"):
        (tmp_path / "s" / gone).rename(tmp_path / gone.replace("/", "-"))
    found = kept.add(spark.createDataFrame(whole[500:], FIELDS), 2)
    once = features(GameSeries.of(spark.createDataFrame(whole, FIELDS), ["player"], ["day", "game"])).result().where("game >= 500")
    assert rows(found.select("game", "pts_4", "3_pts"), "game") == rows(once.select("game", "pts_4", "3_pts"), "game")
    tails = spark.read.parquet(str(tmp_path / "s" / "tails" / "load=2")).groupBy("player").count()
    assert tails.agg(F.max("count")).first()[0] == 4


def test_a_load_done_again_replaces_itself(spark, tmp_path):
    whole = games(90)
    kept = store(tmp_path / "s")
    kept.add(spark.createDataFrame(whole[:50], FIELDS), 0)
    for part in (whole[50:60], whole[50:]):
        kept.add(spark.createDataFrame(part, FIELDS), 1)
    assert kept.read(spark).count() == 90


def test_earlier_games_are_refused(spark, tmp_path):
    whole = games(90)
    kept = store(tmp_path / "s")
    kept.add(spark.createDataFrame(whole[10:], FIELDS), 0)
    with pytest.raises(ValueError):
        kept.add(spark.createDataFrame(whole[:10], FIELDS), 1)
