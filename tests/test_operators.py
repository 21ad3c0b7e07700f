"""Splits, scaling, categories, reconciliation on small tables."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import rows
from hardwood.operators import categories as C
from hardwood.operators import impute as I
from hardwood.operators import reconcile as R
from hardwood.operators import scaling, splits
from hardwood.session import materialize, work_scope


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.range(5000).withColumn("x", F.rand(3) * 10)


def test_random_splits_are_disjoint_and_complete(spark, numbers):
    split = splits.random_split(numbers, "id")
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sum(counts.values()) == 5000 and 3800 < counts["train"] < 4200
    again = splits.random_split(numbers.repartition(11), "id")
    assert split.select("id", "split").exceptAll(again.select("id", "split")).count() == 0
    nested = {r["split"]: r["count"] for r in splits.nested_split(numbers, "id").groupBy("split").count().collect()}
    assert sum(nested.values()) == 5000
    assert abs(nested["train"] - 3600) < 200 and abs(nested["val"] - 400) < 100 and abs(nested["test"] - 1000) < 150


def test_shuffle_is_repeatable(spark, numbers):
    a = [r["id"] for r in splits.shuffled(numbers, "id", "q").collect()]
    b = [r["id"] for r in splits.shuffled(numbers.repartition(7), "id", "q").collect()]
    assert a == b and a != sorted(a)


def test_minmax_scopes(spark):
    data = [(1, "train", 0.0), (2, "train", 10.0), (3, "test", 20.0), (4, "test", 30.0)]
    df = spark.createDataFrame(data, "id int, split string, x double").withColumn("c", F.lit(2.0))
    train = [(r["x"], r["c"]) for r in rows(scaling.minmax(df, ["x", "c"], ["id"]), "id")]
    assert train == [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (3.0, 0.0)]
    own = [r["x"] for r in rows(scaling.minmax(df, ["x"], ["id"], fit_scope="split"), "id")]
    assert own == [0.0, 1.0, 0.0, 1.0]
    with pytest.raises(ValueError):
        scaling.minmax(df, ["x"], ["id"], fit_scope="all")


def test_standardize_by_group_and_switch(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("b", 3, 5.0), ("a", 4, None)], "g string, id int, x double")
    got = [r["x"] for r in rows(scaling.standardize(df, ["g"], ["x"], ["id"]), "id")]
    assert got == [-1.0, 1.0, 0.0, None]
    assert scaling.standardize(df, ["g"], ["x"], ["id"], enabled=False) is df
    table = scaling.parameter_table(scaling.standard_parameters(df, ["g"], ["x"]), ["g"], ["x"])
    assert [(r["g"], r["feature"], r["mean"], r["scale"]) for r in rows(table, "g")] == [("a", "x", 2.0, 1.0), ("b", "x", 5.0, 1.0)]


def test_single_step(spark):
    assert spark.createDataFrame([(1, 2.0)], "a int, b double").select(scaling.single_step(["a", "b"])).first()[0] == [[1.0, 2.0]]


def test_first_seen_index(spark):
    games = [("p", 1, "X", "Y"), ("p", 2, "Z", "X"), ("p", 3, "X", "W"), ("q", 1, "W", "X")]
    df = spark.createDataFrame(games, "player string, d int, Team string, Against string").repartition(3)
    for block in (1_000_000, 1):
        index = C.first_seen_index(df, ["player"], ["d"], ["Team", "Against"], block)
        assert [(r["player"], r["category"], r["idx"]) for r in rows(index, "player", "idx")] == [
            ("p", "X", 1), ("p", "Z", 2), ("p", "Y", 3), ("p", "W", 4), ("q", "W", 1), ("q", "X", 2),
        ]


def test_global_index(spark):
    df = spark.createDataFrame([(c,) for c in "dbacab"] + [(None,)], "t string")
    want = [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert [(r["category"], r["idx"]) for r in rows(C.global_index(df, "t"), "category")] == want
    assert dict(C.global_index(df, "t").dtypes)["idx"] == "bigint"
    coded = C.apply_index(df, C.global_index(df.where("t <> 'd'"), "t"), [], "t", "i", ["t"], unmatched=0)
    assert {(r["t"], r["i"]) for r in coded.collect()} == {("a", 1), ("b", 2), ("c", 3), ("d", 0), (None, 0)}


def test_null_handling(spark):
    df = spark.createDataFrame([(1, 2.0, None), (None, 1.0, None), (0, 4.0, None)], "y int, x double, blank double")
    assert I.complete_rows(df, ["y", "x"]).count() == 2
    assert I.nonzero_target(df, "y").count() == 1
    assert I.rows_with_missing(df, ["y", "x"]).count() == 1
    assert rows(I.flag_and_zero_fill(df, ["y", "x"]), "x") == [
        {"y": 0, "x": 1.0, "blank": None, "injured": 1}, {"y": 1, "x": 2.0, "blank": None, "injured": 0}, {"y": 0, "x": 4.0, "blank": None, "injured": 0},
    ]
    assert I.feature_columns(df.withColumn("s", F.lit("t")), ["y"], numeric_only=True) == ["x", "blank"]
    assert I.originals_first(df, ["y"]).columns == ["x", "blank", "y"]
    assert I.only_entity(df, "y", "all").count() == 3 and I.only_entity(df, "y", 1).count() == 1


def test_reconcile(spark):
    a = spark.createDataFrame([("19", 1), ("19", 2), ("20", 3)], "season string, game int")
    b = spark.createDataFrame([("19", 1), ("21", 9)], "season string, game int")
    got = [(r["season"], r["n_left"], r["n_right"], r["diff"]) for r in rows(R.count_by_source(a, b, "season"), "season")]
    assert got == [("19", 2, 1, 1), ("20", 1, 0, 1), ("21", 0, 1, -1)]
    assert [(r["game"], r["side"]) for r in rows(R.unmatched(a, b, ["season", "game"]), "game")] == [(2, "left"), (3, "left"), (9, "right")]
    assert R.shared(a, b, ["season"], ["game"]).count() == 2
    assert R.only_new(a, b, ["season"], ["game"]).count() == 1
    both = R.append(a, b.withColumn("extra", F.lit(1)), source="src")
    assert both.count() == 5 and both.where("extra IS NULL").count() == 3
    assert sorted(r["value"] for r in R.distinct_of_columns(a, ["season", "game"]).collect()) == ["1", "19", "2", "20", "3"]
    good, bad = R.matched_or_quarantine(a, F.when(F.col("game") > 1, F.col("game") > 2))
    assert (good.count(), bad.count()) == (1, 2)
    merged = R.merge_sources(a, b, ["season", "game"], ["game"], ["season", "game"])
    assert merged.count() == 1


def test_expected_months(spark):
    seasons = spark.createDataFrame([("2018-19", 0), ("2019-20", 3), ("2020-21", 4)], "season string, scrape_type int")
    grid = R.expected_months(seasons)
    counts = {r["season"]: r["count"] for r in grid.groupBy("season").count().collect()}
    assert counts == {"2018-19": 9, "2019-20": 10, "2020-21": 4}
    assert grid.where("page = '/leagues/NBA_2020_games-october-2019.html'").count() == 1


def test_work_scope_removes_its_tables(spark, tmp_path):
    kept = materialize(spark.range(5), "kept")
    with work_scope(spark):
        made = materialize(spark.range(7), "made")
        path = made.inputFiles()[0]
        assert made.count() == 7
        made.write.parquet(str(tmp_path / "out"))
    assert not os.path.exists(path.removeprefix("file://"))
    assert kept.count() == 5 and spark.read.parquet(str(tmp_path / "out")).count() == 7
