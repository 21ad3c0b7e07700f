"""Imputation, lags, rolling means, sliding windows, splits, categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.registry import query
from hardwood.session import work_path
from hardwood.operators import impute, splits
from hardwood.operators.categories import apply_index, first_seen_index, global_index, lookup
from hardwood.operators.scaling import single_step, standardize_series
from hardwood.operators.seasons import SeasonStore
from hardwood.operators.series import lag_features as add_lags
from hardwood.operators.series import (
    GameSeries, change_since_last, lag_sets, lead_features, numbered, previous_means, sliding_windows,
)

ORDER = ["ts", "event_id"]


def week():
    return F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd")


SQL_WEEK = "strftime(date_trunc('week', ts), '%Y-%m-%d')"


def games(tables, *extra):
    """Events as a game log; errors are games without a score."""
    score = F.when(F.col("event_type") != "error", F.col("value"))
    return tables.events.select("user_id", "ts", "event_id", score.alias("y"), *extra)


SQL_GAMES = "g AS (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS y FROM events)"


@query(
    "impute_group_mean",
    "W7 A3",
    f"""
    WITH {SQL_GAMES}
    SELECT event_id, round(coalesce(y, avg(y) OVER (PARTITION BY user_id)), 6) AS y FROM g
    """,
)
def impute_group_mean(tables):
    filled = impute.fill_group_mean(games(tables), ["user_id"], ["y"], ["event_id"], digits=None)
    return filled.select("event_id", F.round("y", 6).alias("y"))


@query(
    "impute_season_mean",
    "W7 A3",
    f"""
    WITH {SQL_GAMES}
    SELECT event_id, round(coalesce(y, avg(y) OVER (PARTITION BY user_id, {SQL_WEEK})), 6) AS y FROM g
    """,
)
def impute_season_mean(tables):
    log = games(tables, week().alias("season"))
    filled = impute.fill_group_mean(log, ["season", "user_id"], ["y"], ["event_id"], digits=None)
    return filled.select("event_id", F.round("y", 6).alias("y"))


@query(
    "lag_features",
    "W1 C20 O1",
    f"""
    WITH {SQL_GAMES},
    l AS (SELECT event_id, y, lag(y, 1) OVER w AS y1, lag(y, 2) OVER w AS y2, lag(y, 3) OVER w AS y3 FROM g
          WINDOW w AS (PARTITION BY {SQL_WEEK}, user_id ORDER BY ts, event_id))
    SELECT event_id, y, y1 AS y_1, NULL::DOUBLE AS y_2, NULL::DOUBLE AS y_3, 1 AS timestep FROM l WHERE y + y1 IS NOT NULL
    UNION ALL SELECT event_id, y, y1, y2, NULL, 2 FROM l WHERE y + y1 + y2 IS NOT NULL
    UNION ALL SELECT event_id, y, y1, y2, y3, 3 FROM l WHERE y + y1 + y2 + y3 IS NOT NULL
    """,
)
def lag_features(tables):
    """Three lag sets out of one pass."""
    series = GameSeries.of(games(tables, week().alias("season")), ["season", "user_id"], ORDER)
    sets = lag_sets(series, ["y"], [1, 2, 3])
    return sets.select("event_id", "y", "y_1", "y_2", "y_3", "timestep")


@query(
    "lead_features",
    "W2 F2",
    """
    WITH z AS (SELECT user_id, ts, event_id, (value - avg(value) OVER p) / stddev_pop(value) OVER p AS z FROM events
               WINDOW p AS (PARTITION BY user_id, year(ts)))
    SELECT event_id, round(z, 6) AS z, round(lead(z, 1) OVER w, 6) AS z_1, round(lead(z, 2) OVER w, 6) AS z_2 FROM z
    WINDOW w AS (PARTITION BY user_id, year(ts) ORDER BY ts, event_id)
    """,
)
def lead_of_standardized(tables):
    log = tables.events.select("user_id", F.year("ts").alias("year"), "ts", "event_id", F.col("value").alias("z"))
    series = GameSeries.of(log, ["user_id", "year"], ORDER)
    done = lead_features(standardize_series(series, ["z"]), ["z"], 2).result()
    return done.select("event_id", *[F.round(c, 6).alias(c) for c in ("z", "z_1", "z_2")])


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey"]
STATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "rolling_mean_prev_n",
    "W3",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
           CASE WHEN count(*) OVER w = 2 THEN round(avg(l_quantity) OVER w, 4) END AS m_quantity,
           CASE WHEN count(*) OVER w = 2 THEN round(avg(l_extendedprice) OVER w, 4) END AS m_price,
           CASE WHEN count(*) OVER w = 2 THEN round(avg(l_discount) OVER w, 4) END AS m_discount,
           CASE WHEN count(*) OVER w = 2 THEN round(avg(l_tax) OVER w, 4) END AS m_tax
    FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)
    """,
)
def rolling_mean_prev_n(tables):
    series = GameSeries.of(tables.lineitem.select("l_suppkey", *LINE_ORDER, *STATS), ["l_suppkey"], LINE_ORDER)
    done = previous_means(series, STATS, 2).result()
    names = {"l_quantity": "m_quantity", "l_extendedprice": "m_price", "l_discount": "m_discount", "l_tax": "m_tax"}
    return done.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *[F.round(f"2_{c}", 4).alias(n) for c, n in names.items()]
    )


# -- sliding windows -------------------------------------------------------------------


def _windows_sql(share: float, season: bool) -> str:
    key = f"user_id, {SQL_WEEK}" if season else "user_id"
    return f"""
    p AS (SELECT *, {SQL_WEEK} AS season, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS pos,
                 count(*) OVER (PARTITION BY {key}) AS n FROM events),
    s AS (SELECT *, CASE WHEN pos <= floor({share}::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM p),
    x AS (SELECT *, lag(value, 3) OVER w AS w0, lag(value, 2) OVER w AS w1, lag(value, 1) OVER w AS w2,
                 lag(ts, 3) OVER w AS d0, lag(ts, 1) OVER w AS d2 FROM s
          WINDOW w AS (PARTITION BY {'user_id, season, split' if season else 'user_id, split'} ORDER BY ts, event_id)),
    win AS (SELECT * FROM x WHERE w0 IS NOT NULL)"""


def _windows(tables, share: float, season: bool):
    keys = ["user_id", "season"] if season else ["user_id"]
    columns = ["user_id", "ts", "event_id", "value"]
    log = tables.events.select(*columns, week().alias("season")) if season else tables.events.select(*columns)
    series = splits.chronological_split(GameSeries.of(log, keys, ORDER), share)
    return sliding_windows(series, ["value"], "value", "ts", 3, ["split"])


def _flat(windows, *keys):
    minute = "yyyy-MM-dd HH:mm"
    return windows.select(
        *keys,
        F.date_format("target_date", minute).alias("target"),
        "y",
        *[F.get("window.value", F.lit(i)).alias(f"w{i}") for i in range(3)],
        F.date_format(F.get("window_dates", F.lit(0)), minute).alias("d0"),
        F.date_format(F.get("window_dates", F.lit(2)), minute).alias("d2"),
    )


_FLAT_SQL = "strftime(ts, '%Y-%m-%d %H:%M') AS target, value AS y, w0, w1, w2, strftime(d0, '%Y-%m-%d %H:%M') AS d0, strftime(d2, '%Y-%m-%d %H:%M') AS d2"


@query("sliding_windows", "W4 P1 W10", f"WITH {_windows_sql(0.92, False)} SELECT user_id, split, {_FLAT_SQL} FROM win")
def sliding_windows_player(tables):
    return _flat(_windows(tables, 0.92, False), "user_id", "split")


@query("sliding_windows_season", "W5 P1 W10", f"WITH {_windows_sql(0.85, True)} SELECT user_id, season, split, {_FLAT_SQL} FROM win")
def sliding_windows_season(tables):
    return _flat(_windows(tables, 0.85, True), "user_id", "season", "split")


@query(
    "pooled_windows",
    "W6 F5",
    f"""
    WITH {_windows_sql(0.85, True)}
    SELECT split, count(*) AS n, count(DISTINCT user_id) AS players, 3::INT AS steps, 1::INT AS single, round(sum(w0), 2) AS first_sum, round(sum(value), 2) AS y_sum
    FROM win GROUP BY split
    """,
)
def pooled_windows(tables):
    pooled = _windows(tables, 0.85, True).withColumn("single", single_step(["y"]))
    return pooled.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("user_id").alias("players"),
        F.max(F.size("window")).alias("steps"),
        F.max(F.size("single")).alias("single"),
        F.round(F.sum(F.get("window.value", F.lit(0))), 2).alias("first_sum"),
        F.round(F.sum("y"), 2).alias("y_sum"),
    )


# -- categories and salary --------------------------------------------------------------

SQL_AGAINST = "CASE WHEN value < 20 THEN 'view' WHEN value < 50 THEN 'trade' ELSE 'click' END"


@query(
    "category_index_first_seen",
    "W8 J6",
    f"""
    WITH e AS (SELECT *, {SQL_AGAINST} AS against FROM events),
    s AS (SELECT user_id, 0 AS source, ts, event_id, event_type AS category FROM e UNION ALL SELECT user_id, 1, ts, event_id, against FROM e),
    f AS (SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY source, ts, event_id) AS k FROM s),
    i AS (SELECT user_id, category, row_number() OVER (PARTITION BY user_id ORDER BY source, ts, event_id) AS idx FROM f WHERE k = 1)
    SELECT e.event_id, a.idx::INT AS team_idx, b.idx::INT AS against_idx FROM e
    JOIN i a ON a.user_id = e.user_id AND a.category = e.event_type JOIN i b ON b.user_id = e.user_id AND b.category = e.against
    """,
)
def category_index_first_seen(tables):
    against = F.when(F.col("value") < 20, "view").when(F.col("value") < 50, "trade").otherwise("click")
    log = tables.events.select("user_id", "ts", "event_id", F.col("event_type").alias("team"), against.alias("against"))
    index = first_seen_index(log, ["user_id"], ORDER, ["team", "against"])
    coded = apply_index(log, index, ["user_id"], "team", "team_idx", ["event_id"])
    coded = apply_index(coded, index, ["user_id"], "against", "against_idx", ["event_id"])
    return coded.select("event_id", "team_idx", "against_idx")


@query(
    "category_index_global",
    "W9 J6",
    """
    WITH i AS (SELECT n_name, row_number() OVER (ORDER BY n_name) AS idx FROM (SELECT DISTINCT n_name FROM nation WHERE n_regionkey <> 0))
    SELECT s_suppkey, n.n_name, coalesce(idx, 0)::INT AS team_idx FROM supplier JOIN nation n ON s_nationkey = n_nationkey LEFT JOIN i ON i.n_name = n.n_name
    """,
)
def category_index_global(tables):
    named = lookup(tables.supplier, tables.nation, "s_nationkey", "n_nationkey", "n_name", "n_name", ["s_suppkey"])
    index = global_index(tables.nation.where("n_regionkey <> 0"), "n_name")
    coded = apply_index(named, index, [], "n_name", "team_idx", ["s_suppkey"], unmatched=0)
    return coded.select("s_suppkey", "n_name", "team_idx")


@query(
    "salary_change",
    "W11",
    """
    WITH s AS (SELECT *, CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS salary FROM events)
    SELECT event_id, salary, round(salary - last_value(salary IGNORE NULLS) OVER
           (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 4) AS change FROM s
    """,
)
def salary_change(tables):
    listed = F.when(~F.col("event_type").isin("error", "view"), F.col("value"))
    log = tables.events.select("user_id", "ts", "event_id", listed.alias("salary"))
    done = change_since_last(GameSeries.of(log, ["user_id"], ORDER), "salary", "change").result()
    return done.select("event_id", "salary", F.round("change", 4).alias("change"))


# -- splits ----------------------------------------------------------------------------


def _split_sql(share: float, key: str) -> str:
    return f"""
    SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id)
             <= floor({share}::DOUBLE * count(*) OVER (PARTITION BY {key})) THEN 'train' ELSE 'test' END AS split FROM events"""


@query("chronological_split", "P1 W10", _split_sql(0.92, "user_id"))
def chronological_split(tables):
    log = tables.events.select("user_id", "ts", "event_id")
    return splits.chronological_split(GameSeries.of(log, ["user_id"], ORDER), 0.92).result().select("event_id", "split")


@query("chronological_split_season", "P1 W10", _split_sql(0.85, f"user_id, {SQL_WEEK}"))
def chronological_split_season(tables):
    log = tables.events.select("user_id", week().alias("season"), "ts", "event_id")
    series = GameSeries.of(log, ["user_id", "season"], ORDER)
    return splits.chronological_split(series, 0.85).result().select("event_id", "split")


def _sql_bucket(salt: str) -> str:
    return f"(('0x' || substr(md5(event_id || '{salt}'), 1, 8))::BIGINT % 100)"


@query("random_split", "P2", f"SELECT event_id, CASE WHEN {_sql_bucket('')} < 80 THEN 'train' ELSE 'test' END AS split FROM events")
def random_split(tables):
    return splits.random_split(tables.events.select("event_id"), "event_id")


@query(
    "nested_split",
    "P3",
    f"""
    SELECT event_id, CASE WHEN {_sql_bucket('s10a')} >= 80 THEN 'test' WHEN {_sql_bucket('s10b')} < 90 THEN 'train' ELSE 'val' END AS split FROM events
    """,
)
def nested_split(tables):
    return splits.nested_split(tables.events.select("event_id"), "event_id")


@query(
    "features_by_load",
    "S9 W1 W3",
    """
    WITH c AS (SELECT event_id, user_id, ts, value, ntile(3) OVER (ORDER BY ts, event_id) - 1 AS load FROM events),
    l AS (SELECT event_id, load, lag(value, 1) OVER w AS value_1, lag(value, 2) OVER w AS value_2, lag(value, 3) OVER w AS value_3,
                 CASE WHEN count(*) OVER b = 2 THEN avg(value) OVER b END AS mean2, user_id FROM c
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id), b AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING)),
    s AS (SELECT user_id, load, count(*) AS k, sum(value) AS v FROM c GROUP BY 1, 2)
    SELECT event_id, l.load::INT AS load, value_1, value_2, value_3, round(mean2, 6) AS mean2,
           coalesce((SELECT sum(k) FROM s WHERE s.user_id = l.user_id AND s.load < l.load), 0)::BIGINT AS games_before,
           round(coalesce((SELECT sum(v) FROM s WHERE s.user_id = l.user_id AND s.load < l.load), 0), 4) AS value_before FROM l
    """,
)
def features_by_load(tables):
    """Three loads, each from its own games and what the load before left: as all games at once."""
    log = tables.events.select("event_id", "user_id", "ts", "value")
    n = log.count()
    order = F.struct("ts", "event_id")
    # Thirds of all events in time order: their last events are found without a sort of the whole table in one task.
    ends = [r["e"] for r in _last_of(log, [-(-n // 3), -(-n // 3) + -(-(n - -(-n // 3)) // 2)])]
    first, second = (order <= F.struct(F.lit(e["ts"]).alias("ts"), F.lit(e["event_id"]).alias("event_id")) for e in ends)
    load = F.when(first, 0).when(second, 1).otherwise(2)
    store = SeasonStore(
        work_path(tables.spark, "loads"), ("user_id",), ("ts", "event_id"), ("value",), 3,
        lambda s: previous_means(add_lags(s, ["value"], 3), ["value"], 2),
    )
    for number in range(3):
        store.add(log.where(load == number), number)
    found = store.read(tables.spark)
    return found.select(
        "event_id", F.col("load").cast("int").alias("load"), "value_1", "value_2", "value_3", F.round("2_value", 6).alias("mean2"),
        "games_before", F.round("value_before", 4).alias("value_before"),
    )


def _last_of(log, places):
    """The events at given places (from 1) in time order."""
    return numbered(log, ["ts", "event_id"], 1_000_000).where((F.col("_g") + 1).isin(places)).orderBy("_g").select(F.struct("ts", "event_id").alias("e")).collect()
