"""Standardisation and min-max scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.features import LINE_ORDER
from hardwood.catalogue.registry import query
from hardwood.operators import scaling
from hardwood.operators.series import GameSeries
from hardwood.operators.splits import chronological_split, random_split

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FEATURES = ["l_quantity", "l_extendedprice", "constant"]


def _box(tables):
    return tables.lineitem.select(*KEYS, "l_shipdate", "l_quantity", "l_extendedprice", F.lit(7.0).alias("constant"))


def _rounded(df, *more):
    return df.select(*KEYS, *more, *[F.round(c, 5).alias(c) for c in FEATURES])


_SQL_SPLIT = """
    b AS (SELECT *, 7.0::DOUBLE AS constant, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) AS pos,
                 count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem),
    s AS (SELECT *, CASE WHEN pos <= floor(0.92::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM b)"""


def _sql_z(column: str, window: str, fit: str = "") -> str:
    value = f"CASE WHEN split = 'train' THEN {column} END" if fit else column
    scale = f"stddev_pop({value}) OVER {window}"
    return f"round(({column} - avg({value}) OVER {window}) / CASE WHEN {scale} = 0 THEN 1 ELSE {scale} END, 5) AS {column}"


@query(
    "standardize_train_fit",
    "F1 P1",
    f"""
    WITH {_SQL_SPLIT}
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, split, {", ".join(_sql_z(c, "p", "train") for c in FEATURES)}
    FROM s WINDOW p AS (PARTITION BY l_suppkey)
    """,
)
def standardize_train_fit(tables):
    """Split, fit and scale on one exchange."""
    series = chronological_split(GameSeries.of(_box(tables), ["l_suppkey"], LINE_ORDER), 0.92)
    scaled = scaling.standardize_series(series, FEATURES, F.col("split") == "train")
    return _rounded(scaled.result(), "split")


@query(
    "standardize_group_year",
    "F2",
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {", ".join(_sql_z(c, "p") for c in FEATURES)}
    FROM (SELECT *, 7.0::DOUBLE AS constant FROM lineitem) WINDOW p AS (PARTITION BY l_suppkey, year(l_shipdate))
    """,
)
def standardize_group_year(tables):
    """Group parameters are aggregated and brought back; the rows are not shuffled."""
    box = _box(tables).withColumn("year", F.year("l_shipdate"))
    return _rounded(scaling.standardize(box, ["l_suppkey", "year"], FEATURES, LINE_ORDER))


@query(
    "scaler_parameters",
    "F1",
    f"""
    WITH {_SQL_SPLIT},
    a AS (SELECT l_suppkey, avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp
          FROM s WHERE split = 'train' GROUP BY 1)
    SELECT l_suppkey, 'l_quantity' AS feature, round(mq, 5) AS mean, round(CASE WHEN sq = 0 THEN 1 ELSE sq END, 5) AS scale FROM a
    UNION ALL SELECT l_suppkey, 'l_extendedprice', round(mp, 4), round(CASE WHEN sp = 0 THEN 1 ELSE sp END, 4) FROM a
    UNION ALL SELECT l_suppkey, 'constant', 7.0, 1.0 FROM a
    """,
)
def scaler_parameters(tables):
    series = chronological_split(GameSeries.of(_box(tables), ["l_suppkey"], LINE_ORDER), 0.92)
    fitted = scaling.standard_parameters(series.result(), ["l_suppkey"], FEATURES, F.col("split") == "train")
    table = scaling.parameter_table(fitted, ["l_suppkey"], FEATURES)
    digits = F.when(F.col("feature") == "l_extendedprice", 4).otherwise(5)
    wide = lambda c: F.when(digits == 4, F.round(c, 4)).otherwise(F.round(c, 5))
    return table.select("l_suppkey", "feature", wide("mean").alias("mean"), wide("scale").alias("scale"))


@query(
    "optional_scaling",
    "F4",
    f"""
    SELECT 'scaled' AS kind, count(*) AS n, round(sum(l_quantity * l_quantity), 2) AS quantity FROM (
      SELECT {_sql_z("l_quantity", "p").replace(", 5)", ", 9)")} FROM lineitem WINDOW p AS (PARTITION BY l_suppkey))
    UNION ALL SELECT 'plain', count(*), round(sum(l_quantity * l_quantity), 2) FROM lineitem
    """,
)
def optional_scaling(tables):
    box = tables.lineitem.select("l_suppkey", *LINE_ORDER, "l_quantity")
    both = None
    for kind, enabled in (("scaled", True), ("plain", False)):
        scaled = scaling.standardize(box, ["l_suppkey"], ["l_quantity"], LINE_ORDER, enabled=enabled)
        part = scaled.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_quantity") * F.col("l_quantity")), 2).alias("quantity"))
        part = part.select(F.lit(kind).alias("kind"), "n", "quantity")
        both = part if both is None else both.unionByName(part)
    return both


_SQL_HASH_SPLIT = """
    s AS (SELECT event_id, value, 7.0::DOUBLE AS constant,
                 CASE WHEN (('0x' || substr(md5(event_id || ''), 1, 8))::BIGINT % 100) < 80 THEN 'train' ELSE 'test' END AS split FROM events)"""


def _events(tables):
    return random_split(tables.events.select("event_id", "value", F.lit(7.0).alias("constant")), "event_id")


@query(
    "minmax_train_fit",
    "F3 P2",
    f"""
    WITH {_SQL_HASH_SPLIT}, r AS (SELECT min(value) AS lo, max(value) AS hi FROM s WHERE split = 'train')
    SELECT event_id, split, round((value - lo) / (hi - lo), 6) AS value, 0.0::DOUBLE AS constant FROM s, r
    """,
)
def minmax_train_fit(tables):
    scaled = scaling.minmax(_events(tables), ["value", "constant"], ["event_id"])
    return scaled.select("event_id", "split", F.round("value", 6).alias("value"), "constant")


@query(
    "minmax_per_split",
    "F3",
    f"""
    WITH {_SQL_HASH_SPLIT}
    SELECT event_id, split, round((value - min(value) OVER p) / (max(value) OVER p - min(value) OVER p), 6) AS value, 0.0::DOUBLE AS constant
    FROM s WINDOW p AS (PARTITION BY split)
    """,
)
def minmax_per_split(tables):
    scaled = scaling.minmax(_events(tables), ["value", "constant"], ["event_id"], fit_scope="split")
    return scaled.select("event_id", "split", F.round("value", 6).alias("value"), "constant")
