"""Whole jobs on a small invented season."""

import random

import pytest
from pyspark.sql import functions as F

from hardwood.fixed_values import BOX_STATS
from hardwood.plans.averages import linear_on_averages, merged_averages
from hardwood.plans.windows import player_windows, season_windows

FEATURES = ["Team", "Against", "Home", "injured", "MP", "FG", "PTS"]


@pytest.fixture(scope="module")
def box(spark):
    rng = random.Random(2)
    data = []
    for player, games in (("Ann", 40), ("Bob", 12), ("Cid", 2)):
        for i in range(games):
            out = rng.random() < 0.15
            stats = [None if out else float(rng.randint(0, 20)) for _ in BOX_STATS]
            season = "2018-19" if i < games // 2 else "2019-20"
            data.append((player, f"20{18 if season == '2018-19' else 19}-11-{1 + i % 28:02d}", "X" if i % 3 else "Y", "Z" if i % 2 else "X", i % 2, *stats, f"/g/{i}", season))
    names = ["Player string", "Date string", "Team string", "Against string", "Home int", *[f"`{c}` double" for c in BOX_STATS], "GameLink string", "season string"]
    return spark.createDataFrame(data, ", ".join(names)).withColumn("Date", F.to_date("Date"))


def lengths(n, share, steps):
    train = int(share * n)
    return max(0, train - steps) + max(0, n - train - steps)


@pytest.mark.parametrize("block", [1_000_000, 10])
def test_player_windows(spark, box, block):
    windows = player_windows(box, 5, block_rows=block).toPandas()
    counts = windows.groupby("Player").size().to_dict()
    assert counts == {p: lengths(n, 0.92, 5) for p, n in (("Ann", 40), ("Bob", 12)) if lengths(n, 0.92, 5)}
    first = windows.iloc[0]["window"][0]
    assert not {"FDP", "TRB", "GameLink", "season"} & set(first if isinstance(first, dict) else first.asDict())
    assert player_windows(box, 5, player="Bob", block_rows=block).count() == counts["Bob"]


@pytest.mark.parametrize("block", [1_000_000, 9])
def test_season_windows(spark, box, block):
    windows = season_windows(box, FEATURES, 3, block_rows=block)
    got = {(r["Player"], r["season"]): r["count"] for r in windows.groupBy("Player", "season").count().collect()}
    want = {(p, s): lengths(n // 2, 0.85, 3) for p, n in (("Ann", 40), ("Bob", 12), ("Cid", 2)) for s in ("2018-19", "2019-20")}
    assert got == {k: v for k, v in want.items() if v}
    row = windows.first().asDict(recursive=True)
    assert list(row["window"][0]) == FEATURES
    assert {w["Against"] for r in windows.collect() for w in r["window"]} <= {0, 1, 2}
    scaled = season_windows(box, FEATURES, 3, scale=True, block_rows=block)
    assert scaled.count() == windows.count()


def test_unknown_book(spark, box):
    with pytest.raises(ValueError):
        season_windows(box, FEATURES, 3, book="DKP")


def test_merged_averages_and_fit(spark):
    rng = random.Random(7)
    feed, box = [], []
    for p in range(12):
        for d in range(1, 21):
            game, points = f"201911{d:02d}-abc-def", rng.randint(5, 30)
            feed.append((game, f"P {p}", f"201911{d:02d}", "abc", str(points * 1.5), "5000", "0", "1"))
            box.append((game.upper(), f"P {p}", f"201911{d:02d}", "ABC", "DEF", float(points), float(rng.randint(10, 40))))
    feed_df = spark.createDataFrame(feed, "GameID string, `First  Last` string, Date string, Team string, FDP string, `FD Sal` string, `FD Change` string, `FD pos` string")
    box_df = spark.createDataFrame(box, "GameID string, Name string, Date string, Team string, OPP string, PTS double, MP double")
    columns = ["PTS", "MP", "FDP"]
    averaged = merged_averages(feed_df, box_df, columns)
    assert averaged.columns[-3:] == ["2_PTS", "2_MP", "2_FDP"]
    assert averaged.count() == 240 and averaged.where("`2_PTS` IS NULL").count() == 24
    assert averaged.where("`2_FDP` <> `2_PTS` * 1.5").count() == 0
    keyed = averaged.withColumn("row_key", F.concat("Name", "Date"))
    for scale in (False, True):
        _, predicted, scores = linear_on_averages(keyed, ["PTS", "MP"], scale=scale)
        assert predicted.count() == scores.first()["n"] > 20
