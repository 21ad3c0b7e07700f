"""Files in temporary folders: readers, the header gate, writers."""

import os

from pyspark.sql import functions as F

from helpers import rows
from hardwood.fixed_values import BOX_COLUMNS, FEED_COLUMNS, FEED_HEADER
from hardwood.plans.feed import clean_feed_folder, prepare_shifted, read_shifted, shifted_sets
from hardwood.operators import accounting
from hardwood.sources import delimited
from hardwood.sources import delimited as D
from hardwood.session import materialize, remove_work, shared_folder
from hardwood.sources import sinks as K


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def box_line(player, minutes, points):
    values = {"Player": player, "Date": "January 13 2016", "Team": "Golden St", "Against": "e Warriors", "Home": "0", "MP": minutes, "PTS": points}
    return ",".join([values.get(c, "1") for c in BOX_COLUMNS] + ["/b/1"])


def feed_line(header, **values):
    return ":".join(values.get(c, values.get(c.replace(" ", "_"), "")) for c in header)


def game(player="James, LeBron", gid="7", day="20191022", fdp="40.5", stats="30pt", sal="9000", **more):
    return {"GID": gid, "Last, First": player, "Date": day, "Team": "lal", "FDP": fdp, "Stats": stats, "FD Sal": sal, "GameID": f"{day}-a-b", "Start": "1", **more}


def test_games_of_all_seasons(spark, tmp_path):
    folder = str(tmp_path / "games")
    header = ",".join([*BOX_COLUMNS, "GameLink"])
    write(f"{folder}/2015-16.csv", header, box_line("Ann", "34:12", "20"), box_line("Bob", "Did Not Play", ""))
    write(f"{folder}/2016-17.csv", header, box_line("Ann", "0:05", "1"))
    write(f"{folder}/Combined.csv", header, box_line("Ann", "0:05", "1"))
    write(f"{folder}/cleaned/2015-16.csv", header, box_line("Zed", "1:00", "1"))
    found = rows(D.read_folder(spark, folder), "season", "Player")
    assert [(r["season"], r["Player"], r["MP"], r["PTS"]) for r in found] == [
        ("2015-16", "Ann", "34:12", "20"), ("2015-16", "Bob", "Did Not Play", None), ("2016-17", "Ann", "0:05", "1"),
    ]
    listed = [r["file_name"] for r in rows(D.listed_files(spark, folder, containing="Combined"), "file_name")]
    assert listed == ["2015-16.csv", "2016-17.csv"]
    assert len(D.listed_files(spark, folder, ignore=["2015-16.csv"]).collect()) == 2


def test_corrupt_line_is_kept_apart(spark, tmp_path):
    folder = str(tmp_path / "games")
    write(f"{folder}/2015-16.csv", ",".join([*BOX_COLUMNS, "GameLink"]), box_line("Ann", "1:00", "2"), "too,short")
    found = rows(D.read_games(spark, folder), "Player")
    assert [r["_corrupt"] is None for r in found] == [True, False]


def test_feed_reader_keeps_all_columns(spark, tmp_path):
    folder = str(tmp_path / "feed")
    write(f"{folder}/2019-20.csv", ":".join(FEED_HEADER), feed_line(FEED_HEADER, **game()))
    row = D.read_feed(spark, folder).first()
    assert row["Last, First"] == "James, LeBron" and row["First  Last"] is None and row["season"] == "2019-20"


def test_feed_gate_and_cleaning(spark, tmp_path):
    folder, out = str(tmp_path / "feed"), str(tmp_path / "out")
    pending = game("Nene", gid="9", day="20191023", fdp="", stats="")
    write(f"{folder}/2019-20.csv", ":".join(FEED_HEADER), feed_line(FEED_HEADER, **game()), feed_line(FEED_HEADER, **pending))
    swapped = FEED_HEADER[::-1]
    write(f"{folder}/2018-19.csv", ":".join(swapped), feed_line(swapped, **game("Smith, Jr., Dennis", day="20181101")))
    short = [c for c in FEED_HEADER if c != "YH Sal"]
    write(f"{folder}/2017-18.csv", ":".join(short), feed_line(short, **game(day="20171101")))
    cleaned = clean_feed_folder(spark, folder, out)
    found = rows(cleaned, "Date")
    assert [(r["Player"], str(r["Date"]), r["season"], r["FDP"], r["FDSal"], r["GID"], r["Starting"]) for r in found] == [
        ("Dennis Smith", "2018-11-01", "2018-19", 40.5, 9000.0, 7, 1),
        ("LeBron James", "2019-10-22", "2019-20", 40.5, 9000.0, 7, 1),
        ("Nene Nene", "2019-10-23", "2019-20", None, 9000.0, 9, 1),
    ]
    assert list(cleaned.columns) == [*FEED_COLUMNS.values(), "season"]
    assert found[0]["DDSal"] is None and found[0]["DDPos"] is None
    errors = rows(spark.read.parquet(f"{out}/errors"))
    assert len(errors) == 1 and errors[0]["URL"].endswith("2017-18.csv") and "YH Sal" in errors[0]["Error"]
    assert D.played_rows(cleaned).count() == 2 and D.pending_rows(cleaned).count() == 1
    assert D.in_date_range(cleaned, "20191001", "20191022").count() == 1
    assert D.in_date_range(cleaned, end="20191022").count() == 2
    assert sorted(os.listdir(f"{out}/seasons"))[-2:] == ["season=2018-19", "season=2019-20"]


def test_corrupt_lines_are_quarantined_once(spark, tmp_path):
    folder, out = str(tmp_path / "feed"), str(tmp_path / "out")
    good = feed_line(FEED_HEADER, **game())
    write(f"{folder}/2019-20.csv", ":".join(FEED_HEADER), good, "garbage", good + ":one:more")
    for _ in range(2):
        cleaned = clean_feed_folder(spark, folder, out)
        assert cleaned.count() == 1 and cleaned.where("GID IS NULL").count() == 0
        errors = rows(spark.read.parquet(f"{out}/errors"), "Error")
        assert [e["Error"][:13] for e in errors] == ["corrupt line:"] * 2
        assert any(e["Error"].endswith("garbage") for e in errors)
        assert all(e["URL"].endswith("2019-20.csv") for e in errors)
        assert spark.read.parquet(f"{out}/seasons").count() == 1


def test_gate_without_complete_file(spark, tmp_path):
    folder = str(tmp_path / "feed")
    write(f"{folder}/2017-18.csv", "GID:Date", "1:20170101")
    good, bad = D.read_checked_feed(spark, folder)
    assert good.count() == 0 and bad.count() == 1


def test_headers_of_files_with_many_lines(spark, tmp_path):
    folder = str(tmp_path / "many")
    for name in ("a", "b"):
        write(f"{folder}/{name}.csv", f"h{name}", *[f"row {i}" for i in range(5000)])
    found = {r["path"].rsplit("/", 1)[1]: r["header"] for r in D.file_headers(spark, folder).collect()}
    assert found == {"a.csv": "ha", "b.csv": "hb"}


def test_season_overwrite_is_dynamic_and_rebuild_is_not(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "season string, v int")
    K.write_seasons(df, path)
    K.write_seasons(df.where("season = 'b'").withColumn("v", F.lit(5)), path)
    assert {(r["season"], r["v"]) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 5)}
    K.rebuild(df.where("season = 'a'"), path, ["season"])
    assert {(r["season"], r["v"]) for r in spark.read.parquet(path).collect()} == {("a", 1)}


def test_player_buckets(spark, tmp_path):
    path = str(tmp_path / "players")
    df = spark.range(200).select((F.col("id") % 7).cast("string").alias("player"), F.col("id").alias("game"))
    K.write_players(df, path, order=["game"], buckets=4)
    one = K.read_player(spark, path, "player", "3", buckets=4)
    assert one.count() == df.where("player = '3'").count()
    assert "player_bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_one_player_is_read_by_pages(spark, tmp_path):
    """Of a bucket's file only the pages with the player's rows leave the scan; a player who is not there, none."""
    path = str(tmp_path / "players")
    df = spark.range(60_000).select((F.col("id") % 97).cast("string").alias("player"), F.col("id").alias("game"))
    K.write_players(df, path, order=["game"], buckets=2, page_rows=100)

    def read(name):
        one = K.read_player(spark, path, "player", name, buckets=2).select("game")
        assert [r["game"] for r in one.collect()] == (list(range(int(name), 60_000, 97)) if int(name) < 97 else [])
        one._jdf.collectToPython()  # this plan, whose counts are asked for
        return one._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().get("numOutputRows").get().value()

    assert read("13") <= 2 * (60_000 // 97 + 200)
    assert read("1000") == 0


def test_combined_csv_and_losses(spark, tmp_path):
    losses = spark.createDataFrame([("a", 2.0, 3), ("b", 1.0, 4)], "player string, mse double, n int")
    K.write_losses(losses, str(tmp_path / "l"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "l")).count() == 2


def test_prepared_sets(spark, tmp_path):
    games = [("2019-20", "Ann", f"2020-01-{d:02d}", f"g{d}", float(d) if d % 5 else None, 100.0) for d in range(1, 29)]
    games += [("2018-19", "Ann", "2019-01-01", "h1", 50.0, None)]
    feed = spark.createDataFrame(games, "season string, Player string, Date string, GameID string, FDP double, FDSal double")
    path = str(tmp_path / "sets")
    prepare_shifted(feed, path)
    assert {n: read_shifted(spark, path, n).count() for n in (1, 3, 20)} == {1: 27, 3: 25, 20: 8}
    assert shifted_sets(feed, block_rows=21).where("depth >= 3").count() == 25
    three = read_shifted(spark, path, 3)
    assert {"FDP_3"} <= set(three.columns) and not {"FDP_4", "depth"} & set(three.columns)
    assert three.where("FDP_3 IS NULL").count() == 0
    train = read_shifted(spark, path, 3, "train")
    assert 0 < train.count() < 25
    scan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(depth" in scan or "PartitionFilters: [isnotnull(split" in scan
    # A missing score is the mean of the player's own season.
    filled = next(r for r in three.collect() if r["Date"] == "2020-01-05")
    known = [d for d in range(1, 29) if d % 5]
    assert filled["FDP"] == round(sum(known) / len(known), 2)


def test_window_sets_by_timestep(spark, tmp_path):
    df = spark.range(40).select(F.col("id").alias("y"), (F.col("id") % 2 + 3).cast("int").alias("timestep"), F.when(F.col("id") < 30, "train").otherwise("test").alias("split"))
    path = str(tmp_path / "w")
    K.write_prepared(df, path)
    K.write_prepared(df.where("timestep = 3 AND split = 'test'").withColumn("y", -F.col("y")), path)
    assert K.read_prepared(spark, path, 4, "train").count() == 15
    assert K.read_prepared(spark, path, 3).where("y < 0").count() == K.read_prepared(spark, path, 3, "test").count() == 5
    plan = K.read_prepared(spark, path, 4, "train")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(timestep" in plan


def test_work_folder_is_removed(spark):
    small = materialize(spark.range(3).toDF("x"), "probe")
    folder = f"{shared_folder(spark)}/hardwood/{spark.sparkContext.applicationId}"
    assert small.count() == 3 and any(n.startswith("probe-") for n in os.listdir(folder))
    remove_work(spark)
    assert not os.path.exists(folder)
    assert materialize(spark.range(2).toDF("x"), "probe").count() == 2


def test_clean_feed_stores_no_parsed_text(spark, tmp_path, monkeypatch):
    """Lines are parsed in the pass that reads their cells; a broken line is one error and its cells are none."""
    labels, stored = [], accounting.materialize
    for module in (delimited, accounting):
        monkeypatch.setattr(module, "materialize", lambda df, label: labels.append(label) or stored(df, label))
    line = {c: "0" for c in FEED_HEADER} | {"Last, First": "No, Part", "Date": "20200102"}
    lines = [":".join(FEED_HEADER), ":".join(line.values()), ":".join((line | {"Stats": "1:2", "Minutes": "half"}).values()), ":".join((line | {"Minutes": "half"}).values())]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "2019-20.csv").write_text("\n".join(lines) + "\n")
    cleaned = clean_feed_folder(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert labels == ["headers", "cells"]
    assert [r["Player"] for r in cleaned.collect()] == ["Part No"]
    assert sorted(r["Error"].split(":")[0] for r in spark.read.parquet(str(tmp_path / "out" / "errors")).collect()) == ["Minutes", "corrupt line"]


def test_clean_feed_leaves_no_stored_cells_and_no_shuffle_files(spark, tmp_path):
    """What the pass over the lines stores is gone once it is written out; seasons of many files need no shuffle."""
    seasons = [f"{y}-{(y + 1) % 100:02d}" for y in range(1970, 1970 + K.OPEN_FILES + 4)]
    for i, season in enumerate(seasons):
        write(f"{tmp_path}/in/{season}.csv", ":".join(FEED_HEADER), *[feed_line(FEED_HEADER, **game(gid=str(g))) for g in range(i % 3 + 1)])
    folder = f"{shared_folder(spark)}/hardwood/{spark.sparkContext.applicationId}".removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    for _ in range(2):
        cleaned = clean_feed_folder(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    assert set(os.listdir(folder)) <= before
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", "0") == "0"
    found = {r["season"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/out/seasons").groupBy("season").count().collect()}
    assert found == {season: i % 3 + 1 for i, season in enumerate(seasons)}
    assert cleaned.count() == sum(found.values())
    assert sorted(n for n in os.listdir(f"{tmp_path}/out/seasons") if "=" in n) == [f"season={s}" for s in seasons]


def test_rebuild_of_rows_that_lie_together_is_not_dealt(spark, tmp_path):
    """Each task writes its own keys: two tasks with a key in common give it two files."""
    df = spark.range(40, numPartitions=2).select("id", F.when(F.col("id") < 10, "a").when(F.col("id") < 30, "b").otherwise("c").alias("season"))
    for _ in range(2):
        K.rebuild(df, str(tmp_path / "t"), ["season"], together=True)
    files = {s: len([n for n in os.listdir(tmp_path / "t" / f"season={s}") if n.endswith(".parquet")]) for s in "abc"}
    assert files == {"a": 1, "b": 2, "c": 1}
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("season").count().orderBy("season").collect() == [("a", 10), ("b", 20), ("c", 10)]


def test_cells_keep_no_address_of_clean_rows_and_names_flip_without_patterns(spark, tmp_path, monkeypatch):
    kept, stored = [], accounting.materialize
    monkeypatch.setattr(accounting, "materialize", lambda df, label: kept.append(df) or stored(df, label))
    raw = spark.createDataFrame(
        [("1", "b", None), ("x", "c", None), ("x", "d", "whole")], "a string, url string, w string"
    )
    cells = [accounting.Cell("a", "A", lambda text: text.try_cast("int"))]
    account = accounting.account_of(raw, [c.value() for c in cells], accounting.cell_errors(cells, F.col("w")), F.col("url"))
    assert sorted(map(tuple, account.errors.collect())) == [("c", "A: x"), ("d", "whole")]
    assert [r["A"] for r in account.clean.collect()] == [1] and (account.n_rows, account.n_clean, account.n_errors) == (3, 1, 2)
    assert sorted((r["_url"] or "", len(r["_errors"])) for r in kept[0].collect()) == [("", 0), ("c", 1), ("d", 1)]
    names = spark.createDataFrame([(n,) for n in ("James, LeBron", "Smith, Jr., Dennis", "Nene", "", ", A", "A, ", "A,B", None)], "n string")
    flipped = names.select(D.flip_name(F.col("n")).alias("n"))
    assert [r["n"] for r in flipped.collect()] == ["LeBron James", "Dennis Smith", "Nene Nene", " ", "A ", " A", "A,B A,B", None]
    assert "split(" not in flipped._jdf.queryExecution().analyzed().toString()
