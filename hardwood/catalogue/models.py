"""Regressors on lag features of the events, and neighbours of the embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from hardwood.catalogue.features import ORDER
from hardwood.catalogue.registry import query
from hardwood.models import boosting, exact_trees, linear, neighbours, trees
from hardwood.operators.evaluate import metrics
from hardwood.operators.impute import complete_rows
from hardwood.operators.series import GameSeries, lag_features
from hardwood.operators.splits import chronological_split
from hardwood.session import materialize


def _lagged(tables, steps: int):
    """Events with their previous values and a split in time."""
    log = tables.events.select("user_id", "ts", "event_id", F.col("value").alias("y"))
    series = chronological_split(GameSeries.of(log, ["user_id"], ORDER), 0.85)
    done = lag_features(series, ["y"], steps).result()
    return complete_rows(done, [f"y_{k}" for k in range(1, steps + 1)])


def _stored(tables, steps: int):
    """The same, written once, for models that read it several times."""
    return materialize(_lagged(tables, steps), "lagged")


SQL_LAGS = """
    b AS (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY user_id) AS n,
                 value AS y, lag(value, 1) OVER w AS y_1, lag(value, 2) OVER w AS y_2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    x AS (SELECT *, CASE WHEN pos <= floor(0.85::DOUBLE * n) THEN 'train' ELSE 'test' END AS split FROM b WHERE y_2 IS NOT NULL)"""

# Least squares on two columns, by the normal equations of the centred columns.
SQL_FIT = """
    SELECT {key} count(*) AS n, avg(y_1) AS m1, avg(y_2) AS m2, avg(y) AS my,
      (covar_pop(y, y_1) * var_pop(y_2) - covar_pop(y, y_2) * covar_pop(y_1, y_2)) / (var_pop(y_1) * var_pop(y_2) - covar_pop(y_1, y_2) ** 2) AS b1,
      (covar_pop(y, y_2) * var_pop(y_1) - covar_pop(y, y_1) * covar_pop(y_1, y_2)) / (var_pop(y_1) * var_pop(y_2) - covar_pop(y_1, y_2) ** 2) AS b2
    FROM x {where} {group}"""
SQL_POOLED = SQL_FIT.format(key="", where="WHERE split = 'train'", group="")


def _pooled(tables):
    rows = _stored(tables, 2)
    features = ["y_1", "y_2"]
    model = linear.fit_complete(linear.linear_pipeline(features, "y"), rows.where("split = 'train'"), features, "y")
    return model, rows, features


@query(
    "simple_regression",
    "M1",
    """
    SELECT l_suppkey, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem GROUP BY 1
    """,
)
def simple_regression(tables):
    fits = linear.simple_regression(tables.lineitem, "l_quantity", "l_extendedprice", ["l_suppkey"])
    return fits.select("l_suppkey", "n", F.round("slope", 3).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query(
    "ar1_per_player",
    "M6",
    """
    WITH x AS (SELECT user_id, value AS y, lag(value, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS y_1 FROM events)
    SELECT user_id, count(*) AS n, round(regr_slope(y, y_1), 5) AS slope, round(regr_intercept(y, y_1), 4) AS intercept
    FROM x WHERE y_1 IS NOT NULL GROUP BY 1
    """,
)
def ar1_per_player(tables):
    fits = linear.simple_regression(_lagged(tables, 1), "y_1", "y", ["user_id"])
    return fits.select("user_id", "n", F.round("slope", 5).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query(
    "ar_per_player",
    "M6",
    f"""
    WITH {SQL_LAGS}, f AS ({SQL_FIT.format(key="user_id,", where="", group="GROUP BY user_id")})
    SELECT user_id, n, 'fitted' AS status, round(my - b1 * m1 - b2 * m2, 3) AS w0, round(b1, 4) AS w1, round(b2, 4) AS w2 FROM f
    """,
)
def ar_per_player(tables):
    """One least-squares fit per player, from sums."""
    fits = linear.fit_per_entity(_lagged(tables, 2), ["user_id"], ["y_1", "y_2"], "y")
    return fits.select(
        "user_id", "n", "status",
        *[F.round(F.get("weights", F.lit(i)), 3 if i == 0 else 4).alias(f"w{i}") for i in range(3)],
    )


SQL_ORDERS = f"""
    {SQL_LAGS},
    v AS (SELECT *, event_id % 4 = 0 AS held FROM x),
    one AS (SELECT user_id, count(*) AS n, regr_slope(y, y_1) AS s, regr_intercept(y, y_1) AS i FROM v WHERE NOT held GROUP BY 1),
    two AS ({SQL_FIT.format(key="user_id,", where="WHERE NOT held", group="GROUP BY user_id").replace("FROM x", "FROM v")}),
    e AS (SELECT user_id, one.n, count(*) AS n_validation, avg((i + s * y_1 - y) ** 2) AS e1, avg((my + b1 * (y_1 - m1) + b2 * (y_2 - m2) - y) ** 2) AS e2,
                 any_value(i) AS i, any_value(s) AS s, any_value(my - b1 * m1 - b2 * m2) AS w0, any_value(b1) AS b1, any_value(b2) AS b2
          FROM v JOIN one USING (user_id) JOIN two USING (user_id) WHERE held AND one.n >= 4 GROUP BY user_id, one.n)"""


@query(
    "ar_order_per_player",
    "M6",
    f"""
    WITH {SQL_ORDERS}
    SELECT user_id, n, n_validation, CASE WHEN e1 <= e2 THEN 1 ELSE 2 END AS lags, round(least(e1, e2), 3) AS mse,
           round(CASE WHEN e1 <= e2 THEN i ELSE w0 END, 3) AS w0, round(CASE WHEN e1 <= e2 THEN s ELSE b1 END, 4) AS w1,
           CASE WHEN e1 > e2 THEN round(b2, 4) END AS w2 FROM e
    """,
)
def ar_order_per_player(tables):
    """One lag or two, whichever predicts a player's validation games better."""
    rows = _lagged(tables, 2).withColumn("held", F.col("event_id") % 4 == 0)
    fits = linear.fit_best_order(rows, ["user_id"], ["y_1", "y_2"], "y", "held").where(F.col("order").isNotNull())
    weights = [F.round(F.get("weights", F.lit(i)), 3 if i == 0 else 4).alias(f"w{i}") for i in range(3)]
    return fits.select("user_id", "n", "n_validation", F.col("order").alias("lags"), F.round("mse", 3).alias("mse"), *weights)


@query(
    "linear_regression",
    "M1 C20",
    f"""
    WITH {SQL_LAGS}, f AS ({SQL_POOLED})
    SELECT event_id, y, round(my + b1 * (y_1 - m1) + b2 * (y_2 - m2), 4) AS y_pred FROM x, f WHERE split = 'test'
    """,
)
def linear_regression(tables):
    model, rows, _ = _pooled(tables)
    scored = model.transform(rows.where("split = 'test'"))
    return scored.select("event_id", "y", F.round("y_pred", 4).alias("y_pred"))


@query(
    "coefficient_table",
    "M2",
    f"""
    WITH {SQL_LAGS}, f AS ({SQL_POOLED})
    SELECT 'y_1' AS feature, round(b1, 5) AS weight FROM f UNION ALL SELECT 'y_2', round(b2, 5) FROM f
    UNION ALL SELECT '(intercept)', round(my - b1 * m1 - b2 * m2, 4) FROM f
    """,
)
def coefficient_table(tables):
    model, _, features = _pooled(tables)
    table = linear.coefficients(model, features)
    return table.withColumn("weight", F.when(F.col("feature") == "(intercept)", F.round("weight", 4)).otherwise(F.round("weight", 5)))


@query(
    "pooled_model_player_mse",
    "M7 A6",
    f"""
    WITH {SQL_LAGS}, f AS ({SQL_POOLED}),
    s AS (SELECT user_id, y, my + b1 * (y_1 - m1) + b2 * (y_2 - m2) AS y_pred FROM x, f WHERE split = 'test')
    SELECT user_id, count(*) AS n, round(avg((y_pred - y) * (y_pred - y)), 3) AS mse FROM s GROUP BY 1
    """,
)
def pooled_model_player_mse(tables):
    model, rows, _ = _pooled(tables)
    scored = model.transform(rows.where("split = 'test'"))
    return metrics(scored, "y", "y_pred", ["user_id"]).select("user_id", "n", F.round("mse", 3).alias("mse"))


SQL_LARGE_MEANS = "x AS (SELECT l_suppkey, l_extendedprice AS y, l_quantity AS y_1, l_partkey + 1000000.0::DOUBLE AS y_2 FROM lineitem)"


@query(
    "fit_per_supplier_large_means",
    "M6",
    f"""
    WITH {SQL_LARGE_MEANS}, f AS ({SQL_FIT.format(key="l_suppkey,", where="", group="GROUP BY l_suppkey")})
    SELECT l_suppkey, n, 'fitted' AS status, round(my - b1 * m1 - b2 * m2, 1) AS w0, round(b1, 4) AS w1, round(b2, 5) AS w2 FROM f
    """,
)
def fit_per_supplier_large_means(tables):
    """Fits do not depend on the magnitude of a feature."""
    rows = tables.lineitem.select(
        "l_suppkey", F.col("l_extendedprice").alias("y"), F.col("l_quantity").cast("double").alias("x1"), (F.col("l_partkey") + 1e6).alias("x2")
    )
    fits = linear.fit_per_entity(rows, ["l_suppkey"], ["x1", "x2"], "y")
    digits = {0: 1, 1: 4, 2: 5}
    return fits.select("l_suppkey", "n", "status", *[F.round(F.get("weights", F.lit(i)), d).alias(f"w{i}") for i, d in digits.items()])


# Of one feature with few values, a tree of full depth predicts the mean of each value's rows. The first boosting
# round is that tree, and later rounds have nothing left to fit.
SQL_MEANS = """
    x AS (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_extendedprice / 1000 AS y,
                 CASE WHEN l_orderkey % 10 < 7 THEN 'train' WHEN l_orderkey % 10 = 7 THEN 'val' ELSE 'test' END AS split FROM lineitem),
    m AS (SELECT q, avg(y) AS y_pred FROM x WHERE split = 'train' GROUP BY q),
    s AS (SELECT x.*, m.y_pred FROM x JOIN m ON x.q = m.q)"""
VALUES = 64


def _quantities(tables):
    """Lines with their quantity as the only feature, and a split by order."""
    tenth = F.col("l_orderkey") % 10
    split = F.when(tenth < 7, "train").when(tenth == 7, "val").otherwise("test")
    rows = tables.lineitem.select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("q"), (F.col("l_extendedprice") / 1000).alias("y"),
        split.alias("split"),
    )
    return materialize(rows, "quantities")


@query("tree_regressor", "M3", f"WITH {SQL_MEANS} SELECT l_orderkey, l_linenumber, y, round(y_pred, 5) AS y_pred FROM s WHERE split = 'test'")
def tree_regressor(tables):
    rows = _quantities(tables)
    model = linear.fit_complete(trees.tree_pipeline(["q"], "y", bins=VALUES), rows.where("split = 'train'"), ["q"], "y")
    scored = model.transform(rows.where("split = 'test'"))
    return scored.select("l_orderkey", "l_linenumber", "y", F.round("y_pred", 5).alias("y_pred"))


def _sql_level(nodes: str) -> str:
    """Best split of each node by running sums over the values of two continuous features."""
    return f"""
      SELECT node, feature, threshold FROM (
        SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, threshold) AS place FROM (
          SELECT node, feature, (v + after) / 2 AS threshold,
                 round((ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n) / (q - s * s / n), 12) AS gain
          FROM (SELECT node, feature, v, lead(v) OVER w AS after, sum(k) OVER w AS ln, sum(ys) OVER w AS ls,
                       sum(k) OVER p AS n, sum(ys) OVER p AS s, sum(yq) OVER p AS q
                FROM (SELECT node, feature, v, count(*)::DOUBLE AS k, sum(y) AS ys, sum(y * y) AS yq
                      FROM (SELECT node, y, 0 AS feature, a AS v FROM {nodes} UNION ALL SELECT node, y, 1, b FROM {nodes}) GROUP BY ALL)
                WINDOW w AS (PARTITION BY node, feature ORDER BY v), p AS (PARTITION BY node, feature))
          WHERE after IS NOT NULL)) WHERE place = 1"""


@query(
    "tree_exact_splits",
    "M3",
    f"""
    WITH t0 AS (SELECT 'r' AS node, l_quantity::DOUBLE AS y, l_extendedprice AS a, l_partkey + l_discount AS b FROM lineitem),
    s0 AS ({_sql_level('t0')}),
    t1 AS (SELECT t0.node || CASE WHEN (CASE feature WHEN 0 THEN a ELSE b END) <= threshold THEN 'L' ELSE 'R' END AS node, y, a, b FROM t0 JOIN s0 ON s0.node = t0.node),
    s1 AS ({_sql_level('t1')}),
    t2 AS (SELECT t1.node || CASE WHEN (CASE feature WHEN 0 THEN a ELSE b END) <= threshold THEN 'L' ELSE 'R' END AS node, y FROM t1 JOIN s1 ON s1.node = t1.node),
    c AS (SELECT node, count(*) AS n, avg(y) AS value FROM (SELECT node, y FROM t0 UNION ALL SELECT node, y FROM t1 UNION ALL SELECT node, y FROM t2) GROUP BY node)
    SELECT c.node, feature, round(threshold, 6) AS threshold, n, round(value, 6) AS value
    FROM c LEFT JOIN (SELECT * FROM s0 UNION ALL SELECT * FROM s1) s ON s.node = c.node
    """,
)
def tree_exact_splits(tables):
    """Two levels of a tree on two continuous columns, split on the cluster; its nodes are the result."""
    rows = tables.lineitem.select(
        F.col("l_quantity").cast("double").alias("y"), F.col("l_extendedprice").alias("a"), (F.col("l_partkey") + F.col("l_discount")).alias("b")
    )
    tree = exact_trees.fit_exact_tree(rows, ["a", "b"], "y", max_depth=2, local_rows=1)
    digits = {c: F.round(c, 6).alias(c) for c in ("threshold", "value")}
    return tree.top.select("node", "feature", digits["threshold"], "n", digits["value"])


def _stopped(tables):
    """Boosting that stops on a validation part, which is neither fitted nor scored."""
    rows = _quantities(tables)
    train, validation = rows.where("split = 'train'"), rows.where("split = 'val'")
    model, curve = trees.fit_with_patience(train, validation, ["q"], "y", patience=2, min_delta=1e-6, depth=30, bins=VALUES)
    return model, curve, rows


@query("boosted_early_stop", "M5", f"WITH {SQL_MEANS} SELECT l_orderkey, l_linenumber, y, round(y_pred, 5) AS y_pred FROM s WHERE split = 'test'")
def boosted_early_stop(tables):
    model, _, rows = _stopped(tables)
    scored = model.transform(rows.where("split = 'test'"))
    return scored.select("l_orderkey", "l_linenumber", "y", F.round("y_pred", 5).alias("y_pred"))


@query(
    "loss_curve",
    "E4",
    f"""
    WITH {SQL_MEANS},
    l AS (SELECT avg((y - y_pred) ** 2) FILTER (WHERE split = 'train') AS loss, avg((y - y_pred) ** 2) FILTER (WHERE split = 'val') AS val_loss FROM s)
    SELECT r::INT AS round, round(loss, 5) AS loss, round(val_loss, 5) AS val_loss FROM l, range(1, 5) t(r)
    """,
)
def loss_curve(tables):
    """Four rounds: the best one, two without an improvement, and the rest of the trial."""
    _, curve, _ = _stopped(tables)
    return curve.withColumns({c: F.round(c, 5) for c in ("loss", "val_loss")})


BOOST = {"rounds": 12, "patience": 1, "min_delta": 5.0, "rate": 0.5}


def _sql_boosted(rounds: int, rate: float) -> str:
    """Rounds of stumps on two binary features, each on the residuals of the rounds before."""
    ctes = [
        """b AS (SELECT l_orderkey, l_linenumber, l_extendedprice / 1000 AS y, (l_quantity > 25)::INT AS x0,
                (l_extendedprice / l_quantity > 1500)::INT AS x1, l_orderkey % 10 AS tenth FROM lineitem)""",
        "d0 AS MATERIALIZED (SELECT *, (SELECT avg(y) FROM b WHERE tenth < 7) AS pred FROM b)",
    ]
    for r in range(1, rounds + 1):
        last = f"d{r - 1}"
        ctes += [
            f"""t{r} AS MATERIALIZED (
              SELECT feature, {rate} * s0 / n0 AS v0, {rate} * s1 / n1 AS v1 FROM (
                SELECT feature, count(*) FILTER (WHERE v = 0) AS n0, count(*) FILTER (WHERE v = 1) AS n1,
                       sum(e) FILTER (WHERE v = 0) AS s0, sum(e) FILTER (WHERE v = 1) AS s1
                FROM (SELECT 0 AS feature, x0 AS v, y - pred AS e FROM {last} WHERE tenth < 7
                      UNION ALL SELECT 1, x1, y - pred FROM {last} WHERE tenth < 7) GROUP BY feature)
              ORDER BY s0 * s0 / n0 + s1 * s1 / n1 DESC, feature LIMIT 1)""",
            f"""d{r} AS MATERIALIZED (
              SELECT {last}.* EXCLUDE (pred), pred + CASE WHEN (CASE feature WHEN 0 THEN x0 ELSE x1 END) = 0 THEN v0 ELSE v1 END AS pred FROM {last}, t{r})""",
            f"""l{r} AS (SELECT {r} AS round, avg((y - pred) ** 2) FILTER (WHERE tenth < 7) AS loss,
                avg((y - pred) ** 2) FILTER (WHERE tenth = 7) AS val_loss FROM d{r})""",
        ]
    every = " UNION ALL ".join(f"SELECT * FROM l{r}" for r in range(1, rounds + 1))
    ctes.append(f"l AS MATERIALIZED ({every})")
    # The first round that does not lower the loss by enough is the last one made, and not part of the model.
    ctes.append(
        f"""e AS (SELECT coalesce(min(round), {rounds + 1}) AS stopped FROM
              (SELECT round, val_loss, lag(val_loss) OVER (ORDER BY round) AS before FROM l) WHERE val_loss >= before - {BOOST['min_delta']})"""
    )
    return ", ".join(ctes)


SQL_BOOSTED = _sql_boosted(BOOST["rounds"], BOOST["rate"])


def _boosted(tables):
    tenth = F.col("l_orderkey") % 10
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    rows = tables.lineitem.select(
        "l_orderkey", "l_linenumber", tenth.alias("tenth"), (F.col("l_extendedprice") / 1000).alias("y"),
        (F.col("l_quantity") > 25).cast("double").alias("x0"), (unit > 1500).cast("double").alias("x1"),
    )
    return rows, boosting.fit_boosted(rows.where("tenth < 7"), rows.where("tenth = 7"), ["x0", "x1"], "y", depth=1, bins=2, **BOOST)


@query(
    "boosted_rounds",
    "M5 E4",
    f"WITH {SQL_BOOSTED} SELECT round, round(loss, 6) AS loss, round(val_loss, 6) AS val_loss FROM l, e WHERE round <= stopped",
)
def boosted_rounds(tables):
    """Losses of stumps on two binary features, round by round, until patience ends."""
    _, (_, curve) = _boosted(tables)
    return curve.withColumns({c: F.round(c, 6) for c in ("loss", "val_loss")})


@query(
    "boosted_predictions",
    "M5",
    f"""
    WITH {SQL_BOOSTED}, p AS ({' UNION ALL '.join(f'SELECT {r} AS round, l_orderkey, l_linenumber, y, pred FROM d{r} WHERE tenth > 7' for r in range(1, BOOST['rounds'] + 1))})
    SELECT l_orderkey, l_linenumber, y, round(pred, 6) AS y_pred FROM p, e WHERE round = stopped - 1
    """,
)
def boosted_predictions(tables):
    """The best round's model on lines that were neither fitted nor used to stop."""
    rows, (model, _) = _boosted(tables)
    found = model.predict(rows.where("tenth > 7"))
    return found.select("l_orderkey", "l_linenumber", "y", F.round("y_pred", 6).alias("y_pred"))


@query(
    "knn_regressor",
    "M4 J8",
    """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
    d AS (SELECT q.vec_id, r.label, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, r.v), r.vec_id) AS k
          FROM e q JOIN e r ON q.vec_id <> r.vec_id)
    SELECT vec_id, count(*) AS n_neighbours, round(avg(label), 6) AS y_pred FROM d WHERE k <= 10 GROUP BY 1
    """,
)
def knn_regressor(tables):
    """Every embedding predicted from its ten nearest others."""
    vectors = tables.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"), F.col("label").cast("double").alias("y"))
    queries = vectors.select(F.col("vec_id").alias("qid"), "vec")
    references = vectors.withColumnRenamed("vec_id", "rid")
    predicted = neighbours.knn_regression(queries, references, 10, not_self=True)
    return predicted.select(F.col("qid").alias("vec_id"), "n_neighbours", F.round("y_pred", 6).alias("y_pred"))
