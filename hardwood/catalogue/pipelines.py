"""Whole jobs: feed to lag sets, merged sources to averages, box scores to windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.features import SQL_WEEK, week
from hardwood.catalogue.models import SQL_POOLED
from hardwood.catalogue.registry import query
from hardwood.models.linear import fit_complete, linear_pipeline
from hardwood.operators.evaluate import metrics
from hardwood.operators.impute import fill_series_mean
from hardwood.operators.series import GameSeries, window_features
from hardwood.plans.averages import linear_on_averages, merged_averages
from hardwood.plans.feed import shifted_sets
from hardwood.plans.windows import player_windows, season_windows
from hardwood.session import materialize


STEPS = 20


def _sql_lags(value: str, mean: str) -> str:
    """Imputed events with lags and splits, as ``k``; ``mean`` wraps the mean that fills gaps."""
    return f"""
    g AS (SELECT *, {SQL_WEEK} AS season, CASE WHEN event_type <> 'error' THEN {value} END AS y0 FROM events),
    i AS (SELECT *, coalesce(y0, {mean.format("avg(y0) OVER (PARTITION BY season, user_id)")}) AS y FROM g),
    l AS (SELECT *, {", ".join(f"lag(y, {n}) OVER w AS y_{n}" for n in range(1, STEPS + 1))}, row_number() OVER w - 1 AS before FROM i
          WINDOW w AS (PARTITION BY season, user_id ORDER BY ts, event_id)),
    h AS (SELECT *, md5(season || '|' || user_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || event_id || 's10a') AS a,
                 md5(season || '|' || user_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || event_id || 's10b') AS b FROM l WHERE y IS NOT NULL),
    k AS (SELECT *, CASE WHEN ('0x' || substr(a, 1, 8))::BIGINT % 100 >= 80 THEN 'test' WHEN ('0x' || substr(b, 1, 8))::BIGINT % 100 < 90 THEN 'train' ELSE 'val' END AS split FROM h)"""


# Means of such values do not lie half-way between two roundings.
UNEVEN = 1.0003717
_SQL_UNEVEN = _sql_lags(f"value * {UNEVEN}::DOUBLE", "round({}, 2)")
SQL_LAG_SETS = f"""
    WITH {_SQL_UNEVEN}
    SELECT event_id, n::INT AS timestep, split, round(y, 6) AS y, {", ".join(f"CASE WHEN n >= {n} THEN round(y_{n}, 6) END AS y_{n}" for n in range(1, STEPS + 1))}
    FROM k, range(1, {STEPS + 1}) t(n) WHERE before >= n"""


def lag_feed(tables, scale: float = UNEVEN):
    """Events as a cleaned feed; errors are games without a score."""
    score = F.col("value") if scale == 1.0 else F.col("value") * scale
    return tables.events.select(
        week().alias("season"),
        F.col("user_id").alias("Player"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date"),
        F.col("event_id").alias("GameID"),
        F.when(F.col("event_type") != "error", score).alias("FDP"),
        F.col("value").alias("FDSal"),
    )


@query(
    "feed_to_lag_sets",
    "W7 W1 P3 C20",
    f"""
    WITH {_sql_lags("value", "{}")}
    SELECT event_id, least(before, {STEPS})::INT AS depth, round(y, 6) AS y, {", ".join(f"round(y_{n}, 6) AS y_{n}" for n in range(1, STEPS + 1))}, split FROM k
    """,
)
def feed_to_lag_sets(tables):
    """All twenty depths. A player without any score in a season has no value to fill with and drops out."""
    sets = shifted_sets(lag_feed(tables, 1.0), STEPS, digits=None)
    lags = [F.round(f"FDP_{n}", 6).alias(f"y_{n}") for n in range(1, STEPS + 1)]
    return sets.select(F.col("GameID").alias("event_id"), "depth", F.round("FDP", 6).alias("y"), *lags, "split")


@query(
    "impute_two_digits",
    "W7 A3",
    f"WITH {_SQL_UNEVEN} SELECT event_id, round(y, 6) AS y FROM k",
)
def impute_two_digits(tables):
    """Gaps filled with the mean of the season's games, rounded as by default."""
    series = GameSeries.of(lag_feed(tables), ["season", "Player"], ["Date", "GameID"])
    filled = fill_series_mean(series, ["FDP"]).result().where("FDP IS NOT NULL")
    return filled.select(F.col("GameID").alias("event_id"), F.round("FDP", 6).alias("y"))


def _two_sides(tables):
    game = F.concat(F.lit("g-"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    keyed = tables.orders.select(
        "o_orderkey", game.alias("GameID"), F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("name"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("Date"), F.lower("o_orderstatus").alias("Team"), "o_totalprice",
    )
    feed = keyed.select(
        "GameID", F.col("name").alias("First  Last"), "Date", "Team", F.col("o_totalprice").alias("FDP"),
        F.lit(None).cast("double").alias("FD Sal"), F.lit(None).cast("double").alias("FD Change"), F.lit("1").alias("FD pos"),
    )
    lines = tables.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("PTS"), F.count(F.lit(1)).cast("double").alias("MP"))
    box = keyed.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.upper("GameID").alias("GameID"), F.col("name").alias("Name"), "Date", F.upper("Team").alias("Team"),
        F.lit("X").alias("OPP"), "PTS", "MP",
    )
    return feed, box


def _averaged_sql(extra: str = "") -> str:
    return f"""
    b AS (SELECT l_orderkey, sum(l_quantity) AS pts, count(*)::DOUBLE AS mp FROM lineitem GROUP BY 1),
    m AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_totalprice AS fdp, pts, mp FROM orders JOIN b ON o_orderkey = l_orderkey),
    v AS (SELECT *, CASE WHEN count(*) OVER w = 2 THEN avg(pts) OVER w END AS a1, CASE WHEN count(*) OVER w = 2 THEN avg(mp) OVER w END AS a2{extra}
          FROM m WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, lpad(o_orderkey::VARCHAR, 12, '0') ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING))"""


@query(
    "merge_to_averages",
    "J1 C10 W3 C26",
    f"""
    WITH {_averaged_sql(", CASE WHEN count(*) OVER w = 2 THEN avg(fdp) OVER w END AS a3")}
    SELECT o_orderkey AS game, pts, round(a1, 4) AS m_pts, round(a2, 4) AS m_mp, round(a3, 4) AS m_fdp FROM v
    """,
)
def merge_to_averages(tables):
    done = merged_averages(*_two_sides(tables), ["PTS", "MP", "FDP"])
    return done.select(
        F.regexp_extract("GameID", "(\\d+)$", 1).cast("long").alias("game"), F.col("PTS").alias("pts"),
        *[F.round(f"2_{c}", 4).alias(f"m_{c.lower()}") for c in ("PTS", "MP", "FDP")],
    )


@query(
    "linear_on_averages",
    "J1 W3 C20 C17 P2 M1 A5",
    f"""
    WITH {_averaged_sql()},
    r AS (SELECT *, fdp / 1000 AS y, md5('g-' || lpad(o_orderkey::VARCHAR, 12, '0')) AS h FROM v WHERE a1 IS NOT NULL AND fdp <> 0),
    x AS (SELECT *, CASE WHEN ('0x' || substr(h, 1, 8))::BIGINT % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM r),
    f AS (SELECT avg(a1) AS m1, avg(a2) AS m2, avg(y) AS my,
            (covar_pop(y, a1) * var_pop(a2) - covar_pop(y, a2) * covar_pop(a1, a2)) / (var_pop(a1) * var_pop(a2) - covar_pop(a1, a2) ** 2) AS b1,
            (covar_pop(y, a2) * var_pop(a1) - covar_pop(y, a1) * covar_pop(a1, a2)) / (var_pop(a1) * var_pop(a2) - covar_pop(a1, a2) ** 2) AS b2
          FROM x WHERE split = 'train')
    SELECT o_orderkey AS game, round(my + b1 * (a1 - m1) + b2 * (a2 - m2), 4) AS y_pred FROM x, f WHERE split = 'test'
    """,
)
def linear_on_averages_query(tables):
    """Merged sources, means of the previous two games, and a linear fit on them with a random split."""
    averaged = merged_averages(*_two_sides(tables), ["PTS", "MP"])
    averaged = averaged.withColumn("FDP", F.col("FDP") / 1000)
    _, predicted, _ = linear_on_averages(averaged, ["PTS", "MP"], key="GameID")
    game = F.regexp_extract("GameID", "(\\d+)$", 1).cast("long")
    return predicted.select(game.alias("game"), F.round("y_pred", 4).alias("y_pred"))


ORDER = ["Date", "l_orderkey", "l_linenumber", "l_partkey"]


def _box(tables):
    """Lines as box scores: supplier = player, ship date = date, null turnovers = not all known."""
    line, quantity = F.col("l_linenumber").cast("double"), F.col("l_quantity")
    return tables.lineitem.select(
        F.col("l_suppkey").cast("string").alias("Player"),
        F.col("l_shipdate").cast("date").alias("Date"),
        F.col("l_returnflag").alias("Team"),
        F.when(F.col("l_tax") < 0.04, F.col("l_linestatus")).otherwise("N").alias("Against"),
        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("Home"),
        (quantity / 2).alias("MP"), quantity.alias("FG"), line.alias("3P"), F.floor(quantity / 3).cast("double").alias("FT"),
        (line + 4).alias("TRB"), (quantity + 1).alias("AST"), line.alias("BLK"), F.lit(2.0).alias("STL"),
        F.when(F.col("l_discount") > 0, line).alias("TOV"),
        *ORDER[1:],
        F.year("l_shipdate").cast("string").alias("season"),
    )


SQL_BOX = """
    b AS (SELECT l_suppkey::VARCHAR AS player, l_shipdate AS d, year(l_shipdate)::VARCHAR AS season,
                 l_orderkey, l_linenumber, l_partkey, l_returnflag AS team,
                 CASE WHEN l_tax < 0.04::DOUBLE THEN l_linestatus ELSE 'N' END AS against, l_quantity AS fg, coalesce(CASE WHEN l_discount > 0 THEN l_linenumber END, 0) AS tov,
                 CASE WHEN l_discount > 0 THEN 0 ELSE 1 END AS injured,
                 CASE WHEN l_discount > 0 THEN l_linenumber * 3 + l_quantity * 2 + floor(l_quantity / 3) + (l_linenumber + 4) * 1.2::DOUBLE + (l_quantity + 1) * 1.5::DOUBLE
                      + l_linenumber * 3 + 6 - l_linenumber ELSE 0 END AS y FROM lineitem)"""


@query(
    "player_window_pipeline",
    "C13 C18 C22 C24 W8 P1 F1 W4",
    f"""
    WITH {SQL_BOX},
    s AS (SELECT player, 0 AS source, d, l_orderkey, l_linenumber, l_partkey, team AS category FROM b UNION ALL SELECT player, 1, d, l_orderkey, l_linenumber, l_partkey, against FROM b),
    f AS (SELECT *, row_number() OVER (PARTITION BY player, category ORDER BY source, d, l_orderkey, l_linenumber, l_partkey) AS k FROM s),
    i AS (SELECT player, category, row_number() OVER (PARTITION BY player ORDER BY source, d, l_orderkey, l_linenumber, l_partkey) AS idx FROM f WHERE k = 1),
    p AS (SELECT b.*, t.idx AS team_idx, a.idx AS against_idx, row_number() OVER (PARTITION BY b.player ORDER BY d, l_orderkey, l_linenumber, l_partkey) AS pos, count(*) OVER (PARTITION BY b.player) AS n
          FROM b JOIN i t ON t.player = b.player AND t.category = b.team JOIN i a ON a.player = b.player AND a.category = b.against),
    c AS (SELECT *, CASE WHEN pos <= floor(0.92::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM p),
    z AS (SELECT *, (fg - avg(CASE WHEN split = 'train' THEN fg END) OVER q) / stddev_pop(CASE WHEN split = 'train' THEN fg END) OVER q AS zfg,
                 (tov - avg(CASE WHEN split = 'train' THEN tov END) OVER q) / stddev_pop(CASE WHEN split = 'train' THEN tov END) OVER q AS ztov
          FROM c WINDOW q AS (PARTITION BY player)),
    w AS (SELECT *, lag(zfg, 3) OVER o AS fg0, lag(ztov, 1) OVER o AS tov2, lag(team_idx, 1) OVER o AS team2, lag(against_idx, 2) OVER o AS against1
          FROM z WINDOW o AS (PARTITION BY player, split ORDER BY d, l_orderkey, l_linenumber, l_partkey))
    SELECT player, split, strftime(d, '%Y-%m-%d') AS target, round(y, 4) AS y, round(fg0, 5) AS fg0, round(tov2, 5) AS tov2, team2::INT AS team2, against1::INT AS against1
    FROM w WHERE fg0 IS NOT NULL
    """,
)
def player_window_pipeline(tables):
    windows = player_windows(_box(tables), 3, order=ORDER)
    at = lambda name, i: F.get(f"window.{name}", F.lit(i))
    return windows.select(
        F.col("Player").alias("player"), "split", F.col("target_date").cast("string").alias("target"), F.round("y", 4).alias("y"),
        F.round(at("FG", 0), 5).alias("fg0"), F.round(at("TOV", 2), 5).alias("tov2"), at("Team", 2).alias("team2"), at("Against", 1).alias("against1"),
    )


@query(
    "season_window_pipeline",
    "C13 C22 C23 C25 W9 P1 W5 W6",
    f"""
    WITH {SQL_BOX},
    i AS (SELECT team, row_number() OVER (ORDER BY team) AS idx FROM (SELECT DISTINCT team FROM b)),
    p AS (SELECT b.*, t.idx AS team_idx, coalesce(a.idx, 0) AS against_idx, row_number() OVER q AS pos, count(*) OVER (PARTITION BY player, season) AS n
          FROM b JOIN i t ON t.team = b.team LEFT JOIN i a ON a.team = b.against WINDOW q AS (PARTITION BY player, season ORDER BY d, l_orderkey, l_linenumber, l_partkey)),
    c AS (SELECT *, CASE WHEN pos <= floor(0.85::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM p),
    w AS (SELECT *, lag(fg, 3) OVER o AS fg0, lag(injured, 1) OVER o AS injured2, lag(team_idx, 1) OVER o AS team2, lag(against_idx, 2) OVER o AS against1
          FROM c WINDOW o AS (PARTITION BY player, season, split ORDER BY d, l_orderkey, l_linenumber, l_partkey))
    SELECT player, season, split, strftime(d, '%Y-%m-%d') AS target, round(y, 4) AS y, fg0, injured2, team2::INT AS team2, against1::INT AS against1 FROM w WHERE fg0 IS NOT NULL
    """,
)
def season_window_pipeline(tables):
    windows = season_windows(_box(tables), ["Team", "Against", "Home", "injured", "MP", "FG", "TOV"], 3, order=ORDER)
    at = lambda name, i: F.get(f"window.{name}", F.lit(i))
    return windows.select(
        F.col("Player").alias("player"), "season", "split", F.col("target_date").cast("string").alias("target"), F.round("y", 4).alias("y"),
        at("FG", 0).alias("fg0"), at("injured", 2).alias("injured2"), at("Team", 2).alias("team2"), at("Against", 1).alias("against1"),
    )


@query(
    "season_windows_to_model",
    "W5 M7 A6 E1",
    f"""
    WITH {SQL_BOX},
    p AS (SELECT *, row_number() OVER (PARTITION BY player, season ORDER BY d, l_orderkey, l_linenumber, l_partkey) AS pos,
                 count(*) OVER (PARTITION BY player, season) AS n FROM b),
    c AS (SELECT *, CASE WHEN pos <= floor(0.85::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM p),
    w AS (SELECT *, lag(fg, 2) OVER o AS y_1, lag(fg, 1) OVER o AS y_2
          FROM c WINDOW o AS (PARTITION BY player, season, split ORDER BY d, l_orderkey, l_linenumber, l_partkey)),
    x AS (SELECT * FROM w WHERE y_1 IS NOT NULL), f AS ({SQL_POOLED}),
    s AS (SELECT player, y, my + b1 * (y_1 - m1) + b2 * (y_2 - m2) AS y_pred FROM x, f WHERE split = 'test')
    SELECT player, count(*) AS n, round(avg((y_pred - y) * (y_pred - y)), 3) AS mse FROM s GROUP BY 1
    """,
)
def season_windows_to_model(tables):
    """Windows within seasons, flattened into features of one pooled model, judged per player."""
    windows = season_windows(_box(tables), ["FG"], 2, order=ORDER)
    rows = materialize(window_features(windows, ["FG"], 2), "windows")
    features = ["FG_0", "FG_1"]
    model = fit_complete(linear_pipeline(features, "y"), rows.where("split = 'train'"), features, "y")
    scored = model.transform(rows.where("split = 'test'"))
    return metrics(scored, "y", "y_pred", ["Player"]).select(F.col("Player").alias("player"), "n", F.round("mse", 3).alias("mse"))
