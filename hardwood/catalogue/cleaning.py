"""Cleaning, parsing and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.registry import query
from hardwood.fixed_values import FEED_HEADER, POSITIONS, TEAM_ALIASES, TEAM_CODES
from hardwood.functions import clean, markup, scores
from hardwood.operators.categories import dim_table, lookup
from hardwood.operators.impute import (
    complete_rows, feature_columns, flag_and_zero_fill, nonzero_target, only_entity, originals_first, rows_with_missing,
)
from hardwood.operators.evaluate import head
from hardwood.operators.reconcile import matched_or_quarantine
from hardwood.operators.splits import features_and_label
from hardwood.operators.dates import read_dates
from hardwood.sources.delimited import clean_feed, game_state, in_date_range

TEAMS = list(TEAM_CODES)
SQL_TEAMS = "[" + ", ".join(f"'{t}'" for t in TEAMS) + "]"
SQL_CODES = ", ".join(f"('{t}', '{c}')" for t, c in TEAM_CODES.items())
SQL_ALIASES = ", ".join(f"('{a}', '{t}')" for a, t in TEAM_ALIASES.items())


def _team(key, shift: int = 0):
    """A team name for a numeric key."""
    return F.element_at(F.array(*[F.lit(t) for t in TEAMS]), (F.pmod(key + shift, F.lit(len(TEAMS))) + 1).cast("int"))


def _sql_team(key: str, shift: int = 0) -> str:
    return f"{SQL_TEAMS}[(({key} + {shift}) % {len(TEAMS)}) + 1]"


# -- feed lines ------------------------------------------------------------------------


def _raw_name():
    number = F.col("o_custkey").cast("string")
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("Smith"), number, F.lit(", Jr., Dennis")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("Nene"), number))
        .otherwise(F.concat(F.lit("Last"), number, F.lit(", First")))
    )


_SQL_NAME = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Smith' || o_custkey || ', Jr., Dennis'
  WHEN '2-HIGH' THEN 'Nene' || o_custkey ELSE 'Last' || o_custkey || ', First' END"""


def _feed_lines(tables):
    """Every order as a colon-delimited feed line."""
    blank = F.lit("")
    price = F.format_string("%.2f", "o_totalprice")
    value = {
        "GID": F.col("o_custkey").cast("string"),
        "Last, First": _raw_name(),
        "Date": F.date_format("o_orderdate", "yyyyMMdd"),
        "Team": F.lower("o_orderstatus"),
        "Opp": F.lower(F.substring("o_orderpriority", 3, 3)),
        "H/A": F.lit("H"),
        "GameID": F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"), F.col("o_orderkey").cast("string")),
        "GTime(ET)": F.lit("19.5"),
        "Team pts": F.lit("101"),
        "FDP": F.when(F.col("o_orderstatus") == "P", blank).otherwise(price),
        "Stats": F.when(F.col("o_orderstatus") == "P", blank).otherwise(F.lit("30pt 8rb")),
        "FD Sal": price,
    }
    line = F.concat_ws(":", *[value.get(c, blank) for c in FEED_HEADER])
    return tables.orders.select("o_orderkey", line.alias("line"))


def _parsed_feed(tables):
    schema = ", ".join(f"`{c}` string" for c in FEED_HEADER)
    parsed = _feed_lines(tables).select(F.from_csv("line", schema, {"sep": ":"}).alias("r"))
    return clean_feed(parsed.select("r.*"))


@query(
    "feed_line_parse",
    "S2 C1 C2 C5",
    f"""
    SELECT o_custkey AS GID, string_split(raw, ', ')[-1] || ' ' || string_split(raw, ', ')[1] AS Player,
           strftime(o_orderdate, '%Y-%m-%d') AS Date, lower(o_orderstatus) AS Team,
           lower(substr(o_orderpriority, 3, 3)) AS Against, 19.5::DOUBLE AS GameTime, 101 AS TeamPoints,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS FDP, o_totalprice AS FDSal,
           CASE WHEN o_orderstatus <> 'P' THEN '30pt 8rb' END AS Stats, NULL::DOUBLE AS DDSal
    FROM (SELECT *, {_SQL_NAME} AS raw FROM orders)
    """,
)
def feed_line_parse(tables):
    feed = _parsed_feed(tables)
    return feed.select(
        "GID", "Player", F.col("Date").cast("string").alias("Date"), "Team", "Against", "GameTime", "TeamPoints",
        "FDP", "FDSal", "Stats", "DDSal",
    )


@query(
    "feed_date_range",
    "C35 C2",
    """
    SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
    WHERE o_orderdate BETWEEN DATE '1994-03-15' AND DATE '1997-10-01' GROUP BY 1
    """,
)
def feed_date_range(tables):
    games = tables.orders.select(F.col("o_orderdate").alias("Date"))
    kept = in_date_range(games, "19940315", "19971001")
    return kept.groupBy(F.date_format("Date", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "feed_pending_rows",
    "C37",
    """
    SELECT CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'played' END AS state, count(*) AS n,
           round(sum(o_totalprice), 2) AS salary FROM orders GROUP BY 1
    """,
)
def feed_pending_rows(tables):
    feed = _parsed_feed(tables).select(game_state().alias("state"), "FDSal")
    return feed.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("FDSal"), 2).alias("salary"))


@query(
    "stat_string_parse",
    "C11 C12 C36",
    """
    WITH s AS (
      SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
             l_quantity::INT AS pts,
             CASE WHEN l_returnflag <> 'N' THEN l_linenumber + 6 END AS rbs,
             (l_quantity::INT % 13) AS ass,
             CASE WHEN l_linestatus = 'O' THEN l_linenumber END AS fgm,
             CASE WHEN l_linestatus = 'O' THEN l_quantity::INT + l_linenumber END AS fga
      FROM lineitem)
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, pts AS "Pts", rbs AS "Rbs", ass AS "Ass", NULL::INT AS "Stl",
           fgm AS "FGM", fga AS "FGA", round(fgm::DOUBLE / fga, 6) AS fg_share,
           CASE WHEN (pts >= 10)::INT + coalesce((rbs >= 10)::INT, 0) + (ass >= 10)::INT >= 2 THEN 1 ELSE 0 END AS double_d,
           CASE WHEN (pts >= 10)::INT + coalesce((rbs >= 10)::INT, 0) + (ass >= 10)::INT >= 3 THEN 1 ELSE 0 END AS triple_d
    FROM s
    """,
)
def stat_string_parse(tables):
    """The string repeats the points token; the last one counts."""
    number = F.col("l_quantity").cast("int")
    stats = F.concat_ws(
        " ",
        F.lit("1pt"),
        F.concat(number.cast("string"), F.lit("pt")),
        F.when(F.col("l_returnflag") != "N", F.concat((F.col("l_linenumber") + 6).cast("string"), F.lit("rb"))),
        F.concat((number % 13).cast("string"), F.lit("as")),
        F.when(
            F.col("l_linestatus") == "O",
            F.concat(F.col("l_linenumber").cast("string"), F.lit("-"), (number + F.col("l_linenumber")).cast("string"), F.lit("fg")),
        ),
    )
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    parsed = tables.lineitem.select(*keys, stats.alias("Stats"))
    columns = scores.stat_columns(F.col("Stats"))
    parsed = parsed.select(*keys, *[columns[c].alias(c) for c in ("Pts", "Rbs", "Ass", "Stl", "FGM", "FGA")])
    counted = [F.col("Pts"), F.col("Rbs"), F.col("Ass")]
    return parsed.withColumns(
        {
            "fg_share": F.round(scores.share(F.col("FGM"), F.col("FGA")), 6),
            "double_d": scores.multi_double(counted, 2),
            "triple_d": scores.multi_double(counted, 3),
        }
    )


# -- minutes and counts ----------------------------------------------------------------


def _clock_text():
    whole = F.floor("value").cast("string")
    seconds = F.lpad(F.floor((F.col("value") - F.floor("value")) * 60).cast("string"), 2, "0")
    return (
        F.when(F.col("event_type") == "error", F.lit("Did Not Play"))
        .when(F.col("event_type") == "signup", F.lit("Not With Team"))
        .when(F.col("event_type") == "purchase", F.lit("late scratch"))
        .when(F.col("event_type") == "view", F.lit(""))
        .otherwise(F.concat(whole, F.lit(":"), seconds))
    )


@query(
    "clean_minutes",
    "C6 K6",
    """
    WITH c AS (SELECT event_id, event_type, floor(value)::BIGINT AS m, floor((value - floor(value)) * 60)::BIGINT AS s FROM events)
    SELECT event_id,
           CASE WHEN event_type = 'click' THEN (m || '.' || lpad(s::VARCHAR, 2, '0'))::DOUBLE END AS minutes,
           CASE WHEN event_type = 'click' THEN round(m + s / 60.0::DOUBLE, 6) END AS minutes_true,
           CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS unknown
    FROM c
    """,
)
def clean_minutes(tables):
    text = tables.events.select("event_id", _clock_text().alias("MP"))
    minutes = clean.minutes_dotted(F.col("MP"))
    return text.select(
        "event_id",
        minutes.alias("minutes"),
        F.round(clean.minutes_true(F.col("MP")), 6).alias("minutes_true"),
        clean.unknown_text(F.col("MP"), minutes).cast("int").alias("unknown"),
    )


@query(
    "clean_int_sentinel",
    "C7 C16",
    """
    SELECT event_id,
           CASE event_type WHEN 'click' THEN floor(value)::INT END AS made,
           CASE event_type WHEN 'click' THEN floor(value)::INT WHEN 'view' THEN 0 END AS made_or_zero
    FROM events
    """,
)
def clean_int_sentinel(tables):
    text = (
        F.when(F.col("event_type") == "error", F.lit("Did Not Dress"))
        .when(F.col("event_type") == "signup", F.lit("Player Suspended"))
        .when(F.col("event_type") == "purchase", F.lit("n/a"))
        .when(F.col("event_type") == "view", F.lit(" "))
        .otherwise(F.floor("value").cast("string"))
    )
    raw = tables.events.select("event_id", text.alias("FG"))
    return raw.select(
        "event_id",
        clean.count_or_null(F.col("FG")).alias("made"),
        clean.count_or_null(clean.blank_to_zero(F.col("FG"))).alias("made_or_zero"),
    )


# -- teams -----------------------------------------------------------------------------


@query(
    "repair_team_alias",
    "C8",
    f"""
    WITH alias(k, a) AS (SELECT row_number() OVER () - 1, a FROM (SELECT unnest({list(TEAM_ALIASES)}) AS a)),
         fixed(a, t) AS (VALUES {SQL_ALIASES}),
         raw AS (SELECT c_custkey, coalesce(alias.a, n_name) AS name
                 FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN alias ON alias.k = c_nationkey)
    SELECT c_custkey, coalesce(fixed.t, raw.name) AS team FROM raw LEFT JOIN fixed ON fixed.a = raw.name
    """,
)
def repair_team_alias(tables):
    """Customers of the first nations carry the misspelt names."""
    aliases = F.array(*[F.lit(a) for a in TEAM_ALIASES])
    named = lookup(tables.customer, tables.nation, "c_nationkey", "n_nationkey", "n_name", "n_name", ["c_custkey"])
    raw = F.coalesce(F.get(aliases, F.col("c_nationkey")), F.col("n_name"))
    return named.select("c_custkey", clean.repair_team(raw, TEAM_ALIASES).alias("team"))


@query(
    "team_code_lookup",
    "C9 C10 J6 K6",
    f"""
    WITH code(t, c) AS (VALUES {SQL_CODES}),
         raw AS (SELECT s_suppkey, CASE WHEN s_nationkey >= 22 THEN n_name ELSE {_sql_team('s_nationkey')} END AS team
                 FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT s_suppkey, lower(team) AS team, c AS code, CASE WHEN c IS NULL THEN 'quarantine' ELSE 'good' END AS state
    FROM raw LEFT JOIN code ON lower(t) = lower(team)
    """,
)
def team_code_lookup(tables):
    named = lookup(tables.supplier, tables.nation, "s_nationkey", "n_nationkey", "n_name", "n_name", ["s_suppkey"])
    raw = F.when(F.col("s_nationkey") >= 22, F.col("n_name")).otherwise(_team(F.col("s_nationkey")))
    keyed = named.select("s_suppkey", F.lower(raw).alias("team"))
    dim = dim_table(tables.spark, TEAM_CODES, "name", "code").withColumn("name", F.lower("name"))
    coded = lookup(keyed, dim, "team", "name", "code", "code", ["s_suppkey"])
    good, bad = matched_or_quarantine(coded, F.col("code").isNotNull())
    return good.withColumn("state", F.lit("good")).unionByName(bad.withColumn("state", F.lit("quarantine")))


@query(
    "dim_lookups",
    "J6",
    """
    SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    """,
)
def dim_lookups(tables):
    nations = lookup(tables.nation, tables.region, "n_regionkey", "r_regionkey", "r_name", "r_name", ["n_nationkey"])
    named = lookup(tables.customer, nations, "c_nationkey", "n_nationkey", "n_name", "n_name", ["c_custkey"])
    placed = lookup(named, nations, "c_nationkey", "n_nationkey", "r_name", "r_name", ["c_custkey"])
    return placed.select("c_custkey", "n_name", "r_name")


# -- headers, dates, seasons ------------------------------------------------------------


@query(
    "header_parse",
    "S14 C15",
    f"""
    SELECT o_orderkey, {_sql_team('o_custkey')} AS away, {_sql_team('o_custkey', 7)} AS home,
           strftime(o_orderdate, '%Y-%m-%d') AS played,
           strftime(o_orderdate, '%Y%m%d') || '-' || lower({_sql_team('o_custkey')}) || '-' || lower({_sql_team('o_custkey', 7)}) AS game_id
    FROM orders
    """,
)
def header_parse(tables):
    """Titles with "at" inside team names."""
    title = F.concat(
        _team(F.col("o_custkey")), F.lit(" at "), _team(F.col("o_custkey"), 7), F.lit(" Box Score, "),
        F.date_format("o_orderdate", "MMMM d, yyyy"),
    )
    titled = tables.orders.select("o_orderkey", title.alias("h1"))
    away, home = markup.header_teams(F.col("h1"))
    day = markup.header_date(F.col("h1"))
    return titled.select(
        "o_orderkey", away.alias("away"), home.alias("home"), day.cast("string").alias("played"),
        clean.game_id(F.date_format(day, "yyyyMMdd"), F.lower(away), F.lower(home)).alias("game_id"),
    )


@query(
    "anchor_date_parse",
    "C3 C4",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS date_key, strftime(o_orderdate, '%Y-%m-%d') AS free_date FROM orders
    """,
)
def anchor_date_parse(tables):
    day = F.col("o_orderdate")
    anchored = tables.orders.select(
        "o_orderkey",
        F.date_format(day, "E, MMM d, yyyy").alias("anchor"),
        F.when(F.col("o_orderstatus") == "P", F.date_format(day, "yyyyMMdd"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "MMMM d yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("text"),
    )
    return anchored.select(
        "o_orderkey",
        clean.anchor_date_key(F.col("anchor")).alias("date_key"),
        clean.any_date(F.col("text")).cast("string").alias("free_date"),
    )


@query(
    "season_keys",
    "C27 C28",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%y') AS year_key,
           '20' || lpad(((year(o_orderdate) + 1) % 100)::VARCHAR, 2, '0') AS end_year FROM orders
    """,
)
def season_keys(tables):
    end = F.lpad(((F.year("o_orderdate") + 1) % 100).cast("string"), 2, "0")
    label = F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), end)
    return tables.orders.select(
        "o_orderkey", clean.year_key(F.col("o_orderdate")).alias("year_key"), clean.season_end_year(label).alias("end_year")
    )


@query(
    "clock_decode",
    "C30",
    """
    SELECT event_id, lpad(hour(ts)::VARCHAR, 2, '0') || ':' || lpad((minute(ts) // 15 * 15)::VARCHAR, 2, '0') AS clock FROM events
    """,
)
def clock_decode(tables):
    hours = F.hour("ts") + F.floor(F.minute("ts") / 15) * F.lit(0.25)
    return tables.events.select("event_id", clean.clock_text(hours).alias("clock"))


@query(
    "position_explode",
    "C29",
    f"""
    WITH d AS (SELECT p_partkey, unnest(regexp_extract_all(p_size::VARCHAR, '[1-5]')) AS digit FROM part)
    SELECT 'digit' AS kind, {list(POSITIONS.values())}[digit::INT] AS position, count(*) AS n FROM d GROUP BY ALL
    UNION ALL
    SELECT 'label', position, count(*) FROM (
      SELECT unnest(string_split(CASE WHEN p_size > 25 THEN 'G-F' WHEN p_size > 10 THEN 'PF' ELSE 'F-G' END, '-')) AS position FROM part)
    GROUP BY position
    """,
)
def position_explode(tables):
    label = F.when(F.col("p_size") > 25, "G-F").when(F.col("p_size") > 10, "PF").otherwise("F-G")
    sizes = tables.part.select("p_size", label.alias("label"))
    digits = sizes.select(F.lit("digit").alias("kind"), F.explode(scores.positions_of_digits(F.col("p_size"))).alias("position"))
    labels = sizes.select(F.lit("label").alias("kind"), F.explode(scores.positions_of_label(F.col("label"))).alias("position"))
    return digits.unionByName(labels).groupBy("kind", "position").agg(F.count(F.lit(1)).alias("n"))


# -- scores, nulls, columns --------------------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "weighted_score",
    "C13 C14",
    """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS home,
           CASE WHEN l_returnflag <> 'R' THEN round(l_linenumber * 3 + l_quantity * 2 + floor(l_quantity / 3) + (l_linenumber + 4) * 1.2::DOUBLE
             + (l_quantity + 1) * 1.5::DOUBLE + l_linenumber * 3 + 2 * 3 - l_linenumber, 4) END AS score
    FROM lineitem
    """,
)
def weighted_score(tables):
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    box = tables.lineitem.withColumns(
        {
            "3P": line, "FG": quantity, "FT": F.floor(quantity / 3), "TRB": line + 4, "AST": quantity + 1, "BLK": line,
            "STL": F.lit(2), "TOV": F.when(F.col("l_returnflag") != "R", line),
        }
    )
    return box.select(*LINE_KEYS, clean.home_flag(line - 1).alias("home"), F.round(scores.book_score("FDP"), 4).alias("score"))


@query(
    "injured_flag_fill",
    "C19 C22 C23",
    """
    WITH m AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS score,
                      CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE value * 2 END AS salary FROM events)
    SELECT event_id, coalesce(score, 0) AS score, round(coalesce(salary, 0), 4) AS salary,
           CASE WHEN score IS NULL OR salary IS NULL THEN 1 ELSE 0 END AS injured,
           (SELECT count(*) FROM m WHERE score IS NULL OR salary IS NULL) AS n_missing FROM m
    """,
)
def injured_flag_fill(tables):
    made = tables.events.select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("score"),
        F.when(~F.col("event_type").isin("error", "view"), F.col("value") * 2).alias("salary"),
    )
    missing = rows_with_missing(made, ["score", "salary"]).agg(F.count(F.lit(1)).alias("n_missing"))
    flagged = flag_and_zero_fill(made, ["score", "salary"])
    # One row of counts: a broadcast of fixed size.
    return (
        flagged.withColumn("_one", F.lit(1))
        .join(F.broadcast(missing.withColumn("_one", F.lit(1))), "_one")
        .select("event_id", "score", F.round("salary", 4).alias("salary"), "injured", "n_missing")
    )


@query(
    "nonzero_target_drop_null",
    "C17 C20 C21",
    """
    SELECT event_id, CASE WHEN event_type = 'view' THEN 0 ELSE value END AS score FROM events
    WHERE event_type NOT IN ('error', 'view') AND value <> 0
    """,
)
def nonzero_target_drop_null(tables):
    """``blank`` is null throughout; only the named columns decide."""
    made = tables.events.select(
        "event_id",
        F.when(F.col("event_type") == "view", 0.0).when(F.col("event_type") != "error", F.col("value")).alias("score"),
        F.lit(None).cast("double").alias("blank"),
    )
    return nonzero_target(complete_rows(made, ["score"]), "score").select("event_id", "score")


@query("entity_filter", "C18", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE event_type = 'purchase' GROUP BY 1")
def entity_filter(tables):
    games = only_entity(only_entity(tables.events, "event_type", "all"), "event_type", "purchase")
    return games.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(
    "feature_select",
    "C24 C25 C26 P5",
    """
    SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, round(l_quantity * 2, 4) AS doubled, l_extendedprice AS label
    FROM lineitem
    """,
)
def feature_select(tables):
    box = tables.lineitem.withColumn("doubled", F.round(F.col("l_quantity") * 2, 4))
    features = feature_columns(box, ["l_orderkey", "l_extendedprice"], numeric_only=True)
    chosen = features_and_label(box, features, "l_extendedprice")
    return originals_first(chosen, ["doubled", "label"])


@query("first_n", "O1 O4", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def first_n(tables):
    return head(tables.orders, ["o_orderdate", "o_orderkey"], 100).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "series_profile",
    "A4 O1",
    """
    SELECT user_id, count(*) AS n, count(DISTINCT event_type) AS kinds,
           strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day FROM events GROUP BY 1
    """,
)
def series_profile(tables):
    return tables.events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("event_type").alias("kinds"),
        F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_day"),
    )


# --- fixed values: formats of the query, by a number; the last ones cannot be read
DATE_FORMATS = [
    "yyyy-MM-dd", "yyyy/M/d", "yyyyMMdd", "MMMM d yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d-MMM-yyyy", "EEE, MMM d, yyyy",
    "d/M/yyyy", "M-d-yyyy", "d.M.yy", "M/d/yy",
]


@query(
    "date_formats",
    "C3 C7",
    """
    WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_orderkey % 15 AS f FROM orders)
    SELECT o_orderkey, CASE WHEN f >= 11 THEN strftime(d, '20%y-%m-%d') ELSE strftime(d, '%Y-%m-%d') END AS day, NULL AS "Error" FROM o WHERE f <= 11 OR (f = 12 AND (day(d) > 12 OR day(d) = month(d)))
    UNION ALL SELECT o_orderkey, NULL, 'day: day or month first: ' || month(d) || '/' || day(d) || '/' || strftime(d, '%y') FROM o WHERE f = 12 AND day(d) <= 12 AND day(d) <> month(d)
    UNION ALL SELECT o_orderkey, NULL, 'day: no date: 31st of ' || month(d) FROM o WHERE f = 13
    UNION ALL SELECT o_orderkey, NULL, 'day: no date: ' || year(d) || '-02-30' FROM o WHERE f = 14
    """,
)
def date_formats(tables):
    """Thirteen formats in one column, of which one is written both ways and only read where a cell tells; and what is no date."""
    form = F.col("o_orderkey") % 15
    date = F.col("o_orderdate").cast("date")
    text = F.lit(None).cast("string")
    for number, pattern in enumerate(DATE_FORMATS):
        text = F.when(form == number, F.date_format(date, pattern)).otherwise(text)
    # Some cells of the two-digit form have the day first, so the column contradicts itself.
    both = (form == 12) & (F.dayofmonth(date) > 12) & (F.col("o_orderkey") % 2 == 0)
    text = F.when(both, F.date_format(date, "d/M/yy")).otherwise(text)
    text = F.when(form == 13, F.concat(F.lit("31st of "), F.month(date))).when(form == 14, F.concat(F.year(date), F.lit("-02-30"))).otherwise(text)
    account = read_dates(tables.orders.select("o_orderkey", text.alias("day")), "day", F.col("o_orderkey"))
    clean = account.clean.select("o_orderkey", F.date_format("day", "yyyy-MM-dd").alias("day"), F.lit(None).cast("string").alias("Error"))
    return clean.unionByName(account.errors.select(F.col("URL").cast("long").alias("o_orderkey"), F.lit(None).cast("string").alias("day"), "Error"))
