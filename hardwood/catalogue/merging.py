"""Joins of sources, set operations, counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.registry import query
from hardwood.operators import reconcile as R
from hardwood.operators.evaluate import value_counts
from hardwood.operators.splits import shuffled
from hardwood.session import materialize


def _feed(tables):
    return tables.orders.select(
        F.lower(F.concat(F.lit("G-"), F.col("o_orderkey").cast("string"))).alias("game_id"),
        F.year("o_orderdate").alias("season"),
        F.lower("o_orderstatus").alias("team"),
        F.quarter("o_orderdate").alias("quarter"),
        "o_totalprice",
    )


def _box(tables):
    """Lines reduced to one row per key before the join, so no key is hot in it."""
    keyed = tables.lineitem.select(
        F.lower(F.concat(F.lit("G-"), F.col("l_orderkey").cast("string"))).alias("game_id"),
        F.year("l_shipdate").alias("season"),
        F.lower("l_linestatus").alias("team"),
        F.quarter("l_shipdate").alias("quarter"),
        "l_quantity",
    )
    return keyed.groupBy("game_id", "season", "team", "quarter").agg(
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n")
    )


KEYS = ["game_id", "season", "team", "quarter"]


@query(
    "merge_sources",
    "J1 O2 C10",
    """
    WITH f AS (SELECT lower('G-' || o_orderkey) AS game_id, year(o_orderdate)::INT AS season, lower(o_orderstatus) AS team, quarter(o_orderdate)::INT AS quarter, o_totalprice FROM orders),
         b AS (SELECT lower('G-' || l_orderkey) AS game_id, year(l_shipdate)::INT AS season, lower(l_linestatus) AS team, quarter(l_shipdate)::INT AS quarter,
                      sum(l_quantity) AS quantity, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT game_id, season, team, quarter, o_totalprice, quantity, n FROM f JOIN b USING (game_id, season, team, quarter)
    """,
)
def merge_sources(tables):
    box = materialize(_box(tables), "box")
    return R.merge_sources(_feed(tables), box, KEYS, ["o_totalprice"], ["game_id", "team", "season", "quarter"])


@query(
    "reconcile_sources",
    "J3 A4",
    """
    WITH a AS (SELECT year(o_orderdate)::INT AS season, count(*) AS n FROM orders GROUP BY 1),
         b AS (SELECT year(l_shipdate)::INT AS season, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT season, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right, coalesce(a.n, 0) - coalesce(b.n, 0) AS diff
    FROM a FULL JOIN b USING (season)
    """,
)
def reconcile_sources(tables):
    left = tables.orders.select(F.year("o_orderdate").alias("season"))
    right = tables.lineitem.select(F.year("l_shipdate").alias("season"))
    return R.count_by_source(left, right, "season")


@query(
    "unmatched_keys",
    "J3",
    """
    SELECT o_orderkey AS game, 'left' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL
    SELECT DISTINCT l_orderkey, 'right' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    """,
)
def unmatched_keys(tables):
    left = tables.orders.select(F.col("o_orderkey").alias("game"))
    right = tables.lineitem.select(F.col("l_orderkey").alias("game"))
    return R.unmatched(left, right, ["game"])


@query(
    "shared_seasons",
    "J2 U3",
    """
    SELECT year(l_shipdate)::INT AS season, count(*) AS n FROM lineitem
    WHERE year(l_shipdate) IN (SELECT year(o_orderdate) FROM orders) GROUP BY 1
    """,
)
def shared_seasons(tables):
    box = tables.lineitem.select(F.year("l_shipdate").alias("season"), "l_orderkey", "l_linenumber")
    feed = tables.orders.select(F.year("o_orderdate").alias("season"))
    kept = R.shared(box, feed, ["season"], ["l_orderkey", "l_linenumber"])
    return kept.groupBy("season").agg(F.count(F.lit(1)).alias("n"))


@query(
    "union_append",
    "U1 S5",
    """
    WITH u AS (
      SELECT 0 AS source, o_orderkey AS game, year(o_orderdate)::INT AS season, o_totalprice AS price, NULL AS quantity FROM orders
      UNION ALL SELECT 1, l_orderkey, year(l_shipdate)::INT, NULL, l_quantity FROM lineitem)
    SELECT source, season, count(*) AS n, count(price) AS n_price, round(sum(quantity), 2) AS quantity FROM u GROUP BY 1, 2
    """,
)
def union_append(tables):
    """Two tables with different columns."""
    feed = tables.orders.select(F.col("o_orderkey").alias("game"), F.year("o_orderdate").alias("season"), F.col("o_totalprice").alias("price"))
    box = tables.lineitem.select(F.col("l_orderkey").alias("game"), F.year("l_shipdate").alias("season"), F.col("l_quantity").alias("quantity"))
    both = R.append(feed, box, source="source")
    return both.groupBy("source", "season").agg(
        F.count(F.lit(1)).alias("n"), F.count("price").alias("n_price"), F.round(F.sum("quantity"), 2).alias("quantity")
    )


@query(
    "entity_union_distinct",
    "U2 A1",
    "SELECT l_partkey::VARCHAR AS value FROM lineitem UNION SELECT l_suppkey::VARCHAR FROM lineitem",
)
def entity_union_distinct(tables):
    return R.distinct_of_columns(tables.lineitem, ["l_partkey", "l_suppkey"])


@query("value_counts", "A2", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def counts(tables):
    return value_counts(tables.events, "user_id")


@query(
    "ignore_list_difference",
    "U4",
    "SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'signup') GROUP BY 1",
)
def ignore_list_difference(tables):
    kept = R.without(tables.events, "event_type", ["error", "signup"])
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stable_shuffle", "P4", "SELECT event_id, md5(event_id || 's1') AS place FROM events")
def stable_shuffle(tables):
    placed = shuffled(tables.events.select("event_id"), "event_id", "s1")
    return placed.withColumn("place", F.md5(F.concat(F.col("event_id").cast("string"), F.lit("s1"))))
