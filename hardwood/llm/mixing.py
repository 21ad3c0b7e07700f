"""Mixing of sources to target weights, in DataFrame operations only.

Words are added up per source. Each source gets a share of the budget by its weight; a share stops
at ``most`` times the source's words and the excess goes to the others by weight until none is above.
The rate of a source is target / words; a document is taken floor(rate) times, and once more if a
number hashed from its id lies below the rate's fraction.

Words are runs without ASCII white space; null texts and empty texts have none and are taken zero
words of; texts of any length are counted whole. Sources are ordered by code point, null last, and weighed by ``weights`` in turn. Rows
without an id draw by their text; identical rows draw alike. Empty tables give empty results. Other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hardwood.llm.common import hash_fraction, n_words, table, wrapped
from hardwood.operators.balance import attach
from hardwood.session import materialize

WEIGHTS = (5, 2, 1)
SHARE, MOST, SEED = 1.5, 2.0, 17


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(key, source_size, target)`` from ``(key, source, source_size)``, one row per source.

    In the order of cap / weight the capped sources come first; the first source that stays below
    its cap fixes the words per unit of weight for all after it. One row per source is ordered in
    one task, after all documents have been added up.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(turn - 1, F.lit(len(weights))) + 1)
    weighed = sizes.withColumn("turn", turn).withColumn("weight", weight)
    weighed = weighed.withColumn("cap", F.lit(most) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "turn")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = weighed.select(
        "key", "source_size", "weight", "cap", "turn",
        (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))).alias("left"),
        F.sum("weight").over(after).alias("weights"),
    )
    capped = F.col("left") * F.col("weight") >= F.col("cap") * F.col("weights")
    level = F.when(~capped, F.col("left") / F.col("weights"))
    return filled.select(
        "key",
        "source_size",
        F.when(capped, F.col("cap")).otherwise(F.max(level).over(everything) * F.col("weight")).alias("target"),
    )


def mixed(
    docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, share=SHARE, most=MOST, seed=SEED
) -> DataFrame:
    """All rows as ``doc`` with ``size, source_size, target, copies``."""
    name = F.col(f"doc.`{source_col}`")
    who = F.coalesce(F.col(f"doc.`{id_col}`").cast("string"), F.md5(F.col(f"doc.`{text_col}`")))
    rows = wrapped(docs).select(
        "doc",
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("key"),
        n_words(F.col(f"doc.`{text_col}`")).alias("size"),
        hash_fraction(F.coalesce(who, F.lit("")), seed=seed).alias("draw"),
    )
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"))
    sizes = sizes.withColumn("source", F.when(F.col("key") != "", F.expr("substring(key, 2)")))
    goals = materialize(targets(sizes, weights, share, most), "targets")
    joined = attach(rows, goals, ["key"], ["draw"])
    rate = F.coalesce(F.col("target") / F.col("source_size"), F.lit(0.0))
    extra = (F.col("draw") < rate - F.floor(rate)).cast("long")
    return joined.select("doc", "size", "source_size", "target", (F.floor(rate) + extra).alias("copies"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each row as often as it is taken, with its columns."""
    taken = mixed(docs, **options).where(F.col("copies") > 0)
    return taken.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select("doc.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixed(docs).select(
        "doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


SQL = {
    "op9_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                   coalesce(cast(doc_id AS varchar), md5(text), '') AS who
            FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM s),
        c AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
                     CASE (turn - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM w),
        f AS (SELECT *,
                1.5::DOUBLE * sum(source_size) OVER ()
                - coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
              FROM c),
        t AS (SELECT *, CASE WHEN rest * weight >= cap * weights THEN cap ELSE
                max(CASE WHEN rest * weight < cap * weights THEN rest / weights END) OVER () * weight END AS target FROM f),
        r AS (SELECT source, source_size, target, coalesce(target / nullif(source_size, 0), 0.0) AS rate FROM t),
        m AS (SELECT d.doc_id, d.size, r.source_size, r.target, r.rate,
                ('0x' || substr(md5('17:' || d.who), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
              FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
        SELECT doc_id, size, source_size, target,
               (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM m
    """
}
QUERIES = {"op9_mixing": op9_mixing}
