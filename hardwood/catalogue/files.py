"""Round trips: tables written in each layout, read back, and compared row by row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hardwood.catalogue.models import SQL_LAGS, SQL_POOLED, _pooled
from hardwood.catalogue.pipelines import SQL_LAG_SETS, STEPS, lag_feed
from hardwood.catalogue.registry import query
from hardwood.fixed_values import FEED_HEADER
from hardwood.models.trees import score_saved
from hardwood.plans.feed import clean_feed_folder, prepare_shifted, read_shifted
from hardwood.session import open_writers, small_disk, work_path
from hardwood.sources import delimited as D
from hardwood.sources import sinks as K

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "cents", "status"]
ORDERS_RAW = T.StructType([T.StructField(c, T.StringType()) for c in ORDER_COLUMNS])
# Files that a task keeps open; with more, it sorts its rows by season.
SEASON_WRITERS = 64
SQL_SEASON = "year(o_orderdate)::VARCHAR || '-' || lpad(((year(o_orderdate) + 1) % 100)::VARCHAR, 2, '0')"


def _season(date="o_orderdate"):
    year = F.year(date)
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))


def _orders(tables):
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return tables.orders.select("o_orderkey", "o_custkey", "o_orderdate", cents.alias("cents"), F.col("o_orderstatus").alias("status"))


def _season_files(spark, df, folder: str, sep: str = ",", ending: str = "") -> None:
    """One CSV file per season, named by it: each season is written by one task, then renamed.

    Lines are put together before they meet in that task, which only writes them, unsorted. The header is the name of their
    column.
    """
    written = work_path(spark, "seasons")
    columns = [c for c in df.columns if c != "season"]
    line = F.concat_ws(sep, *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    lines = df.select(line.alias(sep.join(columns)), "season").repartition("season")
    with open_writers(spark, SEASON_WRITERS), small_disk(spark):
        lines.write.partitionBy("season").option("header", True).option("sep", "\u0001").option("quote", "\u0000").csv(written)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(folder))
    for part in files.globStatus(path(f"{written}/season=*/*.csv")):  # one per season
        season = part.getPath().getParent().getName().split("=", 1)[1]
        files.rename(part.getPath(), path(f"{folder}/{season}{ending}.csv"))


SQL_ORDERS = f"""SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, round(o_totalprice * 100)::BIGINT AS cents,
                        o_orderstatus AS status, {SQL_SEASON} AS season FROM orders"""


def _typed(df):
    day = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd")
    return df.select(F.col("o_orderkey").cast("long"), F.col("o_custkey").cast("long"), day.alias("day"), F.col("cents").cast("long"), "status", "season")


@query("season_files_round_trip", "S1 S3 S4", SQL_ORDERS)
def season_files_round_trip(tables):
    """Season files beside a combined file and an ignored entry, which are not read."""
    folder = work_path(tables.spark, "files")
    orders = _orders(tables).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")).withColumn("season", _season())
    _season_files(tables.spark, orders, folder)
    _season_files(tables.spark, orders.where("status = 'P'"), folder, ending="Combined")
    read = D.read_folder(tables.spark, folder, reader=lambda s, f: D.read_games(s, f, ORDERS_RAW))
    return _typed(read)


def _feed(tables):
    """Order lines as feed lines: all 34 columns as text."""
    text = {
        "GID": F.col("l_orderkey"), "Last, First": F.concat(F.lit("Part, No"), F.col("l_partkey")),
        "Date": F.date_format("l_shipdate", "yyyyMMdd"), "Team": F.lit("den"), "Opp": F.lit("mia"), "H/A": F.lit("H"),
        "GameID": F.concat_ws("-", "l_orderkey", "l_linenumber"), "Minutes": F.col("l_quantity").cast("int"),
        "FDP": F.round(F.col("l_extendedprice") * 100).cast("long"), "FD Sal": F.col("l_suppkey"), "Stats": F.lit("1pt"),
    }
    return tables.lineitem.select(*[text.get(c, F.lit("0")).cast("string").alias(c) for c in FEED_HEADER], _season("l_shipdate").alias("season"))


def _cleaned(tables):
    """Whole seasons, one season's file without a column, and lines with a separator too many."""
    spark, folder = tables.spark, work_path(tables.spark, "feed")
    feed = _feed(tables)
    first = F.col("season") == "1992-93"
    broken = F.col("GID").cast("long") % 50 == 0
    # Two cells that are no numbers, in lines that parse.
    unread = F.col("GID").cast("long") % 50 == 1
    lines = feed.where(~first).withColumns(
        {
            "Stats": F.when(broken, "1pt:2rb").otherwise(F.col("Stats")),
            "Minutes": F.when(unread, "half").otherwise(F.col("Minutes")),
            "FD Sal": F.when(unread, "n/a").otherwise(F.col("FD Sal")),
        }
    )
    _season_files(spark, lines, f"{folder}/in", ":")
    _season_files(spark, feed.where(first).drop("YH Sal"), f"{folder}/in", ":")
    for _ in range(2):  # a rerun gives the same tables
        cleaned = clean_feed_folder(spark, f"{folder}/in", f"{folder}/out")
    return cleaned, folder


SQL_FEED = """x AS (SELECT *, year(l_shipdate) = 1992 AS gated, l_orderkey % 50 = 0 AS broken, l_orderkey % 50 = 1 AS unread FROM lineitem)"""


@query(
    "feed_quarantine",
    "K6 S6 C1",
    f"""
    WITH {SQL_FEED}
    SELECT '1992-93.csv' AS file, 'missing columns: YH Sal' AS error, 1 AS n WHERE EXISTS (SELECT 1 FROM x WHERE gated)
    UNION ALL SELECT {SQL_SEASON.replace('o_orderdate', 'l_shipdate')} || '.csv', 'corrupt line', count(*) FROM x WHERE broken AND NOT gated GROUP BY 1
    UNION ALL SELECT {SQL_SEASON.replace('o_orderdate', 'l_shipdate')} || '.csv', e, count(*) FROM x, (VALUES ('Minutes: half'), ('FDSal: n/a')) AS c(e) WHERE unread AND NOT gated GROUP BY ALL
    """,
)
def feed_quarantine(tables):
    _, folder = _cleaned(tables)
    errors = tables.spark.read.parquet(f"{folder}/out/errors")
    file = F.element_at(F.split("URL", "/"), -1)
    kind = F.when(F.col("Error").startswith("corrupt line"), "corrupt line").otherwise(F.col("Error"))
    return errors.groupBy(file.alias("file"), kind.alias("error")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "feed_clean_lines",
    "S2 C1 K1 K2",
    f"""
    WITH {SQL_FEED}
    SELECT l_orderkey AS "GID", 'No' || l_partkey || ' Part' AS "Player", l_orderkey || '-' || l_linenumber AS "GameID", l_quantity::INT::DOUBLE AS "Minutes",
           round(l_extendedprice * 100)::DOUBLE AS "FDP", {SQL_SEASON.replace('o_orderdate', 'l_shipdate')} AS season FROM x WHERE NOT gated AND NOT broken AND NOT unread
    """,
)
def feed_clean_lines(tables):
    """What is not in quarantine, read from the season folders."""
    _, folder = _cleaned(tables)
    seasons = tables.spark.read.parquet(f"{folder}/out/seasons")
    return seasons.select("GID", "Player", "GameID", "Minutes", "FDP", "season")


@query("seasons_round_trip", "K1 K2", f"SELECT *, status = 'P' AS late FROM ({SQL_ORDERS})")
def seasons_round_trip(tables):
    """Combined, then by season; a second write replaces only the seasons it holds."""
    folder = work_path(tables.spark, "layouts")
    orders = _orders(tables).withColumn("season", _season())
    K.write_combined(orders, f"{folder}/combined")
    combined = tables.spark.read.parquet(f"{folder}/combined")
    K.write_seasons(combined.withColumn("late", F.lit(None).cast("boolean")), f"{folder}/seasons")
    marked = combined.withColumn("late", F.col("status") == "P")
    for half in (F.col("season") < "1995", F.col("season") >= "1995"):
        K.write_seasons(marked.where(half), f"{folder}/seasons")
    read = tables.spark.read.parquet(f"{folder}/seasons")
    return read.select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "cents", "status", "season", "late")


@query("player_files_round_trip", "K3", """SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events""")
def player_files_round_trip(tables):
    """All players out of their buckets, with the place of each row in its file: a player's rows lie together and in order."""
    folder = work_path(tables.spark, "players")
    log = tables.events.select(F.col("user_id").cast("string").alias("player"), "ts", "event_id")
    K.write_players(log, folder, "player", ["ts", "event_id"])
    placed = tables.spark.read.parquet(folder).select("player", "event_id", "_metadata.file_path", "_metadata.row_index")
    first = F.min("row_index").over(Window.partitionBy("player", "file_path"))
    # Rows of a player in two files, or with another's between them, would not count from one to the last.
    return placed.select(F.col("player").cast("long").alias("user_id"), "event_id", (F.col("row_index") - first + 1).alias("k"))


@query(
    "prepared_sets_round_trip",
    "K4 K5",
    """SELECT l_orderkey, l_linenumber, l_linenumber AS timestep, l_returnflag AS split, l_quantity AS y FROM lineitem WHERE l_linenumber <= 3""",
)
def prepared_sets_round_trip(tables):
    """A rebuild leaves nothing of an earlier, deeper set; each set is read by its timestep and split."""
    spark, folder = tables.spark, work_path(tables.spark, "sets")
    rows = tables.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_linenumber").alias("timestep"), F.col("l_quantity").alias("y"), F.col("l_returnflag").alias("split")
    )
    K.write_prepared(rows.withColumn("y", -F.col("y")), folder)
    K.rebuild(rows.where("timestep <= 3"), folder, ["timestep", "split"])
    wanted = [K.read_prepared(spark, folder, t, split) for t in (1, 2, 3, 4) for split in ("A", "N", "R")]
    read = reduce(DataFrame.unionByName, wanted)
    return read.select("l_orderkey", "l_linenumber", "timestep", "split", "y")


@query("shifted_sets_round_trip", "S17", SQL_LAG_SETS)
def shifted_sets_round_trip(tables):
    """The prepared lag sets, written and read at all depths with all their lags."""
    folder = work_path(tables.spark, "shifted")
    prepare_shifted(lag_feed(tables), folder)
    sets = [read_shifted(tables.spark, folder, n) for n in range(1, STEPS + 1)]
    read = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sets)
    lags = [F.round(f"FDP_{n}", 6).alias(f"y_{n}") for n in range(1, STEPS + 1)]
    return read.select(F.col("GameID").alias("event_id"), "timestep", "split", F.round("FDP", 6).alias("y"), *lags)


@query(
    "loss_table_round_trip",
    "K7",
    "SELECT l_suppkey AS player, count(*) AS n, round(avg(l_quantity), 4) AS mse FROM lineitem GROUP BY 1",
)
def loss_table_round_trip(tables):
    folder = work_path(tables.spark, "losses")
    losses = tables.lineitem.groupBy(F.col("l_suppkey").alias("player")).agg(F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("mse"))
    K.write_losses(losses, folder)
    read = tables.spark.read.parquet(folder)
    return read.select("player", "n", F.round("mse", 4).alias("mse"))


@query(
    "saved_model_round_trip",
    "K8 M8",
    f"""
    WITH {SQL_LAGS}, f AS ({SQL_POOLED})
    SELECT event_id, y, round(my + b1 * (y_1 - m1) + b2 * (y_2 - m2), 4) AS y_pred FROM x, f WHERE split = 'test'
    UNION ALL SELECT event_id, y, NULL FROM x WHERE split = 'test' AND event_id % 2 = 0
    """,
)
def saved_model_round_trip(tables):
    """A loaded model scores as many rows as it gets: those without a feature have no prediction."""
    folder = work_path(tables.spark, "model")
    model, rows, _ = _pooled(tables)
    K.save_model(model, folder)
    test = rows.where("split = 'test'")
    gaps = test.where("event_id % 2 = 0").withColumn("y_1", F.lit(None).cast("double"))
    return score_saved(folder, test.unionByName(gaps)).select("event_id", "y", F.round("y_pred", 4).alias("y_pred"))
