"""The naive prediction on events, and everything that judges predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.features import ORDER, SQL_GAMES
from hardwood.catalogue.registry import query
from hardwood.operators import evaluate as E
from hardwood.operators.series import GameSeries, mean_of_previous
from hardwood.plans.difficulty import player_difficulty, scored_text

SQL_NAIVE = f"""{SQL_GAMES},
    i AS (SELECT user_id, ts, event_id, coalesce(y, avg(y) OVER (PARTITION BY user_id)) AS y FROM g),
    f AS (SELECT *, CASE WHEN count(*) OVER w2 = 2 THEN avg(y) OVER w2 END AS y_pred,
                 lag(y, 1) OVER w AS y_1, lag(y, 2) OVER w AS y_2, lag(y, 3) OVER w AS y_3, row_number() OVER w AS pos, count(*) OVER (PARTITION BY user_id) AS n
          FROM i WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id),
                        w2 AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)),
    p AS (SELECT *, CASE WHEN pos <= floor(0.85::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM f
          WHERE y IS NOT NULL AND y_pred IS NOT NULL AND y_1 IS NOT NULL AND y_2 IS NOT NULL AND y_3 IS NOT NULL)"""

SQL_PLAYER = """SELECT user_id, count(*) AS n, avg((y_pred - y) * (y_pred - y)) AS mse, avg(abs(y_pred - y)) AS mae,
    count(*) FILTER (WHERE y_pred - y >= 3) AS over, count(*) FILTER (WHERE y_pred - y <= -3) AS under"""


def difficulty(tables):
    text = scored_text(F.col("event_type") == "error", F.col("value"))
    log = tables.events.select("user_id", "ts", "event_id", text.alias("MP"))
    return player_difficulty(log, "user_id", ORDER, "MP", digits=None)


@query(
    "flagship_player_difficulty",
    "C6 C13 W7 W3 W1 C20 P1 E5 A6 E3",
    f"""
    WITH {SQL_NAIVE}, m AS ({SQL_PLAYER} FROM p WHERE split = 'test' GROUP BY user_id)
    SELECT user_id, n, round(mse, 4) AS mse, round(mae, 4) AS mae, over, under FROM m
    """,
)
def flagship_player_difficulty(tables):
    return difficulty(tables).select(
        "user_id", "n", F.round("mse", 4).alias("mse"), F.round("mae", 4).alias("mae"), "over", "under"
    )


SQL_SIMPLE = """
    f AS (SELECT user_id, event_id, value AS y, CASE WHEN count(*) OVER w = 2 THEN avg(value) OVER w END AS y_pred FROM events
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)),
    p AS (SELECT * FROM f WHERE y_pred IS NOT NULL)"""


def predictions(tables):
    """Mean of the two previous values as prediction of the next."""
    log = tables.events.select("user_id", "ts", "event_id", F.col("value").alias("y"))
    series = GameSeries.of(log, ["user_id"], ORDER).neighbours(2, 0, y_pred=mean_of_previous("y", 2))
    return series.result().where(F.col("y_pred").isNotNull())


@query(
    "residuals",
    "E1 E5",
    f"WITH {SQL_SIMPLE} SELECT event_id, round(y - y_pred, 4) AS residual, round(y_pred - y, 4) AS reversed FROM p",
)
def residuals(tables):
    return predictions(tables).select(
        "event_id",
        F.round(E.residual("y", "y_pred"), 4).alias("residual"),
        F.round(E.residual("y", "y_pred", "predicted-actual"), 4).alias("reversed"),
    )


@query(
    "mse_mae",
    "A5 A7",
    f"WITH {SQL_SIMPLE} SELECT count(*) AS n, round(avg((y_pred - y) * (y_pred - y)), 3) AS mse, round(avg(abs(y_pred - y)), 3) AS mae FROM p",
)
def mse_mae(tables):
    return E.metrics(predictions(tables), "y", "y_pred").select("n", F.round("mse", 3).alias("mse"), F.round("mae", 3).alias("mae"))


@query("per_player_mse", "A6", f"WITH {SQL_SIMPLE} SELECT user_id, count(*) AS n, round(avg((y_pred - y) * (y_pred - y)), 3) AS mse FROM p GROUP BY 1")
def per_player_mse(tables):
    return E.metrics(predictions(tables), "y", "y_pred", ["user_id"]).select("user_id", "n", F.round("mse", 3).alias("mse"))


@query(
    "over_under",
    "A8",
    f"""
    WITH {SQL_SIMPLE} SELECT count(*) FILTER (WHERE y_pred - y >= 3) AS over, count(*) FILTER (WHERE y_pred - y <= -3) AS under, count(*) AS n FROM p
    """,
)
def over_under(tables):
    return E.metrics(predictions(tables), "y", "y_pred").select("over", "under", "n")


@query(
    "metric_bundle",
    "E3",
    f"WITH {SQL_SIMPLE}, m AS ({SQL_PLAYER} FROM p GROUP BY user_id) SELECT user_id, n, round(mse, 3) AS mse, round(mae, 9) AS mae, over, under FROM m",
)
def metric_bundle(tables):
    bundle = E.metrics(predictions(tables), "y", "y_pred", ["user_id"])
    return bundle.withColumns({"mse": F.round("mse", 3), "mae": F.round("mae", 9)})


@query(
    "good_bad_tag",
    "E2",
    f"""
    WITH {SQL_SIMPLE}
    SELECT CASE WHEN abs(y - y_pred) <= 7 AND y - y_pred > -4 THEN 'good' ELSE 'bad' END AS strict,
           CASE WHEN abs(y_pred - y) <= 7 THEN 'good' ELSE 'bad' END AS wide, count(*) AS n FROM p GROUP BY 1, 2
    """,
)
def good_bad_tag(tables):
    tagged = predictions(tables).select(
        E.good_prediction("y", "y_pred").alias("strict"), E.good_prediction("y", "y_pred", lower=None).alias("wide")
    )
    return tagged.groupBy("strict", "wide").agg(F.count(F.lit(1)).alias("n"))


@query(
    "target_histogram",
    "A9",
    """
    WITH l AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    b AS (SELECT least(floor(10.0::DOUBLE * (value - lo) / (hi - lo)), 9)::INT + 1 AS bin, lo, hi FROM events, l)
    SELECT bin, round(lo + (bin - 1) * (hi - lo) / 10, 4) AS low, count(*) AS n FROM b GROUP BY bin, lo, hi
    """,
)
def target_histogram(tables):
    return E.histogram(tables.events, "value").withColumn("low", F.round("low", 4))


@query(
    "best_worst_players",
    "O3 A6",
    f"""
    WITH {SQL_NAIVE}, m AS ({SQL_PLAYER} FROM p WHERE split = 'test' GROUP BY user_id HAVING count(*) >= 10),
    r AS (SELECT *, row_number() OVER (ORDER BY mse, user_id) AS a, row_number() OVER (ORDER BY mse DESC, user_id) AS b FROM m)
    SELECT user_id, n, round(mse, 4) AS mse, 'best' AS side FROM r WHERE a <= 3
    UNION ALL SELECT user_id, n, round(mse, 4), 'worst' FROM r WHERE b <= 3
    """,
)
def best_worst_players(tables):
    """Best and worst three among players with at least ten test games."""
    ranked = E.best_and_worst(difficulty(tables), "user_id", at_least=10)
    return ranked.select("user_id", "n", F.round("mse", 4).alias("mse"), "side")
