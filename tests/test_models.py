"""Fits against numpy, neighbours against brute force, saved models."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows
from hardwood.models import boosting, exact_trees, linear, neighbours, trees
from hardwood.operators import evaluate as E
from hardwood.operators.series import GameSeries, sliding_windows, window_features
from hardwood.sources.sinks import load_model, save_model


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    y = 3 + 2 * x[:, 0] - x[:, 1] + rng.normal(scale=0.1, size=300)
    player = ["a"] * 200 + ["b"] * 97 + ["c"] * 3
    data = [(i, p, float(u), float(v), float(t)) for i, (p, (u, v), t) in enumerate(zip(player, x, y))]
    return data, spark.createDataFrame(data, "id long, player string, x1 double, x2 double, y double")


def lstsq(data):
    a = np.array([[1, r[2], r[3]] for r in data])
    return np.linalg.lstsq(a, np.array([r[4] for r in data]), rcond=None)[0]


def test_linear_and_coefficients(spark, points):
    data, df = points
    model = linear.linear_pipeline(["x1", "x2"], "y").fit(df)
    want = lstsq(data)
    got = {r["feature"]: r["weight"] for r in linear.coefficients(model, ["x1", "x2"]).collect()}
    assert got == pytest.approx({"(intercept)": want[0], "x1": want[1], "x2": want[2]}, abs=1e-8)


def test_fit_per_entity(spark, points):
    data, df = points
    fits = {r["player"]: r for r in linear.fit_per_entity(df, ["player"], ["x1", "x2"], "y").collect()}
    for p in "ab":
        assert fits[p]["weights"] == pytest.approx(lstsq([r for r in data if r[1] == p]).tolist(), abs=1e-7)
    assert fits["c"]["status"] == "too short" and fits["c"]["weights"] is None
    scored = linear.predict_per_entity(df, linear.fit_per_entity(df, ["player"], ["x1", "x2"], "y"), ["player"], ["x1", "x2"], ["id"])
    assert scored.where("player = 'c' AND y_pred IS NOT NULL").count() == 0
    assert E.metrics(scored, "y", "y_pred").first()["mse"] < 0.02


def test_constant_feature_has_a_solution(spark):
    df = spark.createDataFrame([("a", 1.0, float(i), 2.0 * i) for i in range(6)], "p string, c double, x double, y double")
    weights = linear.fit_per_entity(df, ["p"], ["c", "x"], "y").first()["weights"]
    assert weights[2] == pytest.approx(2.0)


def test_saved_model_scores_alike(spark, points, tmp_path):
    _, df = points
    model = trees.tree_pipeline(["x1", "x2"], "y", depth=5).fit(df)
    save_model(model, str(tmp_path / "m"))
    direct = rows(model.transform(df).select("id", "y_pred"), "id")
    assert rows(trees.score_saved(str(tmp_path / "m"), df).select("id", "y_pred"), "id") == direct
    assert load_model(str(tmp_path / "m")).stages


def test_boosting_stops_early_and_reports_losses(spark, points):
    _, df = points
    train, val = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    model, curve = trees.fit_with_patience(train, val, ["x1", "x2"], "y", rounds=12, patience=3, min_delta=0.01)
    losses = [r["val_loss"] for r in sorted(curve.collect(), key=lambda r: r["round"])]
    best, _ = trees.best_round(losses, 3, 0.01)
    kept = trees.loss_curve(model, train, val).collect()
    assert len(kept) == best
    assert max(kept, key=lambda r: r["round"])["val_loss"] == pytest.approx(losses[best - 1])


@pytest.mark.parametrize(
    "losses, patience, delta, want",
    [([5, 4, 3, 2], 2, 0, (4, False)), ([5, 4, 4, 4, 1], 2, 0, (2, True)), ([5, 4.9, 4.8, 4.0], 3, 0.5, (4, False)), ([3, 3, 3], 2, 0, (1, True)), ([2], 5, 0, (1, False))],
)
def test_patience(losses, patience, delta, want):
    assert trees.best_round(losses, patience, delta) == want


@pytest.mark.parametrize("mean", [0.0, 1e3, 1e4, 1e6, 1e9])
def test_fits_do_not_depend_on_the_magnitude(spark, mean):
    rng = np.random.default_rng(11)
    x = np.stack([mean + rng.normal(size=200), -mean + rng.normal(size=200) * 50], axis=1)
    y = 7 - 3 * (x[:, 0] - mean) + 0.5 * (x[:, 1] + mean) + mean
    df = spark.createDataFrame([("a", *map(float, r), float(t)) for r, t in zip(x, y)], "p string, x1 double, x2 double, y double")
    weights = linear.fit_per_entity(df, ["p"], ["x1", "x2"], "y").first()["weights"]
    assert weights[1:] == pytest.approx([-3, 0.5], rel=1e-5)
    assert weights[0] + weights[1] * mean - weights[2] * mean == pytest.approx(7 + mean, rel=1e-5)


def test_dependent_features_share_the_weight(spark):
    df = spark.createDataFrame([("a", float(i), 2.0 * i, 6.0 * i + 1) for i in range(8)], "p string, x1 double, x2 double, y double")
    fit = linear.fit_per_entity(df, ["p"], ["x1", "x2"], "y")
    assert all(r["y_pred"] == pytest.approx(r["y"]) for r in linear.predict_per_entity(df, fit, ["p"], ["x1", "x2"], ["y"]).collect())


def test_scoring_keeps_every_row(spark, points):
    _, df = points
    gaps = df.withColumn("x1", F.when(F.col("id") % 3 != 0, F.col("x1")))
    for pipeline in (linear.linear_pipeline(["x1", "x2"], "y"), trees.tree_pipeline(["x1", "x2"], "y", depth=3), trees.boosted_pipeline(["x1", "x2"], "y", rounds=2)):
        model = linear.fit_complete(pipeline, df, ["x1", "x2"], "y")
        scored = model.transform(gaps)
        assert scored.count() == df.count()
        assert scored.where("(y_pred IS NULL) <> (x1 IS NULL)").count() == 0
        with pytest.raises(ValueError, match="x1"):
            linear.fit_complete(pipeline, gaps, ["x1", "x2"], "y")


def brute(vectors, y, k):
    out = {}
    for i, v in enumerate(vectors):
        d = sorted((float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in enumerate(vectors) if j != i)[:k]
        out[i] = [j for _, j in d]
    return out


@pytest.mark.parametrize("block, pivots", [(20_000, None), (40, 6), (15, 1)])
def test_neighbours_match_brute_force(spark, block, pivots):
    """Clusters, exact copies (more than k of one vector) and several blocks per cell."""
    rng = np.random.default_rng(1)
    cloud = np.concatenate([rng.normal(loc=c, size=(40, 5)) for c in (0, 6, -6)])
    copies = np.repeat(cloud[:1], 50, axis=0)
    vectors = np.round(np.concatenate([cloud, copies]), 3)
    y = rng.integers(0, 9, len(vectors)).astype(float)
    refs = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(vectors, y))], "rid long, vec array<double>, y double")
    queries = refs.select(F.col("rid").alias("qid"), "vec")
    found = neighbours.nearest(queries, refs.repartition(3), 7, not_self=True, pivots=pivots, block=block).toPandas()
    want = brute(vectors, y, 7)
    for qid, group in found.groupby("qid"):
        got = group.sort_values(["dist", "rid"])["rid"].tolist()
        assert got == want[qid], qid
    assert len(found) == 7 * len(vectors)
    others = neighbours.nearest(queries, refs, 7, pivots=pivots, block=block).toPandas()
    assert len(others) == 7 * len(vectors)
    for qid in (0, 45, 130):
        d = sorted((float(np.sqrt(((vectors[qid] - w) ** 2).sum())), j) for j, w in enumerate(vectors))[:7]
        assert others[others["qid"] == qid].sort_values(["dist", "rid"])["rid"].tolist() == [j for _, j in d]
    predicted = {r["qid"]: r["y_pred"] for r in neighbours.knn_regression(queries, refs, 7, not_self=True, pivots=pivots, block=block).collect()}
    assert predicted[0] == pytest.approx(y[want[0]].mean())


def test_fewer_references_than_k(spark):
    refs = spark.createDataFrame([(1, [0.0], 1.0), (2, [1.0], 3.0)], "rid long, vec array<double>, y double")
    queries = spark.createDataFrame([(9, [0.2])], "qid long, vec array<double>")
    assert neighbours.knn_regression(queries, refs, 10).collect()[0]["y_pred"] == 2.0
    assert neighbours.nearest(queries, refs.where("false"), 10).count() == 0


def test_far_cells_are_not_visited(spark):
    """Queries near one cluster do not reach the blocks of another."""
    vectors = [[float(i % 10) * 0.01 + (1000.0 if i >= 200 else 0.0)] for i in range(400)]
    refs = spark.createDataFrame([(i, v, 1.0) for i, v in enumerate(vectors)], "rid long, vec array<double>, y double")
    queries = spark.createDataFrame([(9, [0.0])], "qid long, vec array<double>")
    found = neighbours.nearest(queries, refs, 3, pivots=8)
    assert [r["rid"] for r in rows(found, "rid")] == [0, 10, 100] or found.agg(F.max("rid")).first()[0] < 200


def test_evaluation_boundaries(spark):
    gaps = [3.0, -3.0, 7.0, -4.0, 0.0, 8.0]
    df = spark.createDataFrame([("p", 10.0, 10.0 + g) for g in gaps], "player string, y double, y_pred double")
    m = E.metrics(df, "y", "y_pred").first()
    assert (m["n"], m["over"], m["under"]) == (6, 3, 2)
    tags = [tuple(r) for r in df.select(E.good_prediction("y", "y_pred"), E.good_prediction("y", "y_pred", lower=None)).collect()]
    # actual - predicted = -3, 3, -7, 4, 0, -8
    assert tags == [("good", "good"), ("good", "good"), ("bad", "good"), ("good", "good"), ("good", "good"), ("bad", "bad")]
    with pytest.raises(ValueError):
        E.residual("y", "y_pred", "other")


def test_ranking_needs_ten_games(spark):
    df = spark.createDataFrame([(p, float(i), n) for i, (p, n) in enumerate([("a", 9), ("b", 10), ("c", 30), ("d", 10), ("e", 11)])], "player string, mse double, n long")
    found = rows(E.best_and_worst(df, "player"), "side", "mse")
    assert [(r["side"], r["player"]) for r in found] == [("best", "b"), ("best", "c"), ("best", "d"), ("worst", "c"), ("worst", "d"), ("worst", "e")]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 5, 9.99, 10, 10]] + [(None,)], "x double")
    found = {r["bin"]: r["n"] for r in E.histogram(df, "x").collect()}
    assert found == {1: 1, 2: 1, 6: 1, 10: 3}
    flat = E.histogram(df.where("x = 10"), "x").collect()
    assert [(r["bin"], r["n"]) for r in flat] == [(1, 2)]


def test_references_go_only_where_they_are_asked_for(spark, monkeypatch):
    """Rows shuffled on the reference side are those of the blocks that some routed query visits."""
    rng = np.random.default_rng(6)
    spots = np.repeat(rng.normal(size=(12, 4)) * 100, 30, axis=0) + rng.normal(size=(360, 4))
    refs = spark.createDataFrame([(i, v.tolist(), 0.0) for i, v in enumerate(spots)], "rid long, vec array<double>, y double")
    asked = []
    kept = neighbours.asked_blocks
    monkeypatch.setattr(neighbours, "asked_blocks", lambda routed: asked.append(kept(routed)) or asked[-1])
    found = neighbours.nearest(refs.select(F.col("rid").alias("qid"), "vec"), refs, 3, not_self=True, pivots=12, block=10)
    want = brute(spots, None, 3)
    got = {}
    for r in found.orderBy("qid", "dist", "rid").collect():
        got.setdefault(r["qid"], []).append(r["rid"])
    assert got == want
    triples = asked[0].count()
    chunks = asked[0].select("chunk").distinct().count()
    blocks = asked[0].select("cell", "slot").distinct().count()
    assert triples < blocks * chunks / 2


@pytest.mark.parametrize("block", [None, 200])
def test_queries_travel_by_blocks_not_by_pivots(spark, monkeypatch, block):
    """Vectors in all directions: every pivot may hold a neighbour, but a query goes to a block once. Some ids come twice."""
    rng = np.random.default_rng(12)
    spots = rng.normal(size=(600, 24))
    ids = np.where(np.arange(600) < 590, np.arange(600), np.arange(600) - 590)
    spots[590:] = spots[:10]
    y = rng.integers(0, 9, 600).astype(float)
    refs = spark.createDataFrame([(int(i), v.tolist(), float(t)) for i, v, t in zip(ids, spots, y)], "rid long, vec array<double>, y double")
    seen = []
    kept = neighbours.asked_blocks
    monkeypatch.setattr(neighbours, "asked_blocks", lambda routed: seen.append(routed) or kept(routed))
    found = neighbours.nearest(refs.select(F.col("rid").alias("qid"), "vec"), refs, 5, not_self=True, pivots=30, block=block)
    got = {}
    for r in found.collect():
        got.setdefault(r["qid"], []).append((round(r["dist"], 9), r["rid"]))
    away = np.sqrt(((spots[:, None, :] - spots[None, :, :]) ** 2).sum(2))
    for i in range(590):
        times = 2 if i < 10 else 1
        want = sorted((round(float(away[i, j]), 9), int(ids[j])) for j in range(600) if ids[j] != i for _ in range(times))[:5]
        assert sorted(got[i]) == want, i
    assert seen[0].count() <= len(spots) * (1 if block is None else 5)


def grown(x, y, min_rows=2, max_depth=None, depth=0):
    """Plain recursion: (prediction function, depth), the best split by squared error."""
    mean = sum(y) / len(y)
    error = sum((v - mean) ** 2 for v in y)
    best = None
    if len(y) >= min_rows and depth != max_depth and error > 1e-9:
        for feature in range(len(x[0])):
            values = sorted({r[feature] for r in x})
            for a, b in zip(values, values[1:]):
                parts = [[v for r, v in zip(x, y) if (r[feature] <= a) == side] for side in (True, False)]
                left = sum(sum((v - sum(p) / len(p)) ** 2 for v in p) for p in parts)
                gain = round((error - left) / error, 9)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, feature, (a + b) / 2
    if best is None:
        return lambda r: mean, depth
    _, feature, cut = best
    sides = [[i for i, r in enumerate(x) if (r[feature] <= cut) == side] for side in (True, False)]
    (low, d1), (high, d2) = (grown([x[i] for i in at], [y[i] for i in at], min_rows, max_depth, depth + 1) for at in sides)
    return lambda r: low(r) if r[feature] <= cut else high(r), max(d1, d2)


@pytest.mark.parametrize("local, options", [(1_000, {}), (25, {}), (25, {"max_depth": 3}), (10, {"min_rows": 12, "max_depth": 6})])
def test_exact_tree_is_the_plain_recursion(spark, local, options):
    rng = np.random.default_rng(8)
    x = [[float(a), float(b)] for a, b in zip(rng.normal(size=90).round(2), rng.integers(0, 5, 90))]
    y = [round(float(3 * (a > 0.1) + b + n), 3) for (a, b), n in zip(x, rng.normal(size=90))]
    df = spark.createDataFrame([(i, *r, v) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, y double").repartition(5)
    tree = exact_trees.fit_exact_tree(df, ["a", "b"], "y", local_rows=local, **options)
    want, depth = grown(x, y, **options)
    assert tree.depth() == depth
    asked = [[float(a), float(b)] for a, b in rng.normal(scale=2, size=(60, 2))] + x
    more = spark.createDataFrame([(i, *r) for i, r in enumerate(asked)] + [(-1, None, 1.0), (-2, 1.0, float("nan"))], "id long, a double, b double")
    got = {r["id"]: r["y_pred"] for r in exact_trees.predict_exact_tree(tree, more).collect()}
    assert got.pop(-1) is None and got.pop(-2) is None
    assert got == pytest.approx({i: want(r) for i, r in enumerate(asked)}, abs=1e-9)


@pytest.mark.parametrize("bins", [12, 65_536])
@pytest.mark.parametrize("signal", [0.0, 20.0])
def test_bins_without_the_best_split_are_left_out(spark, monkeypatch, signal, bins):
    """The best of all thresholds, with and without a signal, from the values of few bins if there is one."""
    rng = np.random.default_rng(9)
    x = np.stack([rng.normal(size=2_000), rng.uniform(size=2_000) if signal else rng.lognormal(sigma=3, size=2_000).round(2)], axis=1)
    y = signal * (x[:, 0] > 0.3) + rng.normal(size=2_000)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, y double").repartition(3)
    stored = {}
    kept = exact_trees.materialize

    def noted(df, label):
        stored.setdefault(label, made := kept(df, label))
        return made

    monkeypatch.setattr(exact_trees, "BINS", bins, raising=False)
    monkeypatch.setattr(exact_trees, "materialize", noted)
    tree = exact_trees.fit_exact_tree(df, ["a", "b"], "y", max_depth=1, local_rows=1_999)
    root = tree.top.where("depth = 0").first()
    assert (root["feature"], pytest.approx(root["threshold"], abs=1e-12)) == exact_trees._best_here(x, y)
    if signal:
        assert stored["values"].count() < 2_000


@pytest.mark.parametrize("local", [1_000, 36])
def test_exact_tree_has_no_limit_of_depth(spark, local):
    df = spark.createDataFrame([(i, float(i), 3.0**i) for i in range(45)], "id long, x double, y double")
    tree = exact_trees.fit_exact_tree(df, ["x"], "y", local_rows=local)
    assert tree.depth() > 30
    got = {r["id"]: r["y_pred"] for r in exact_trees.predict_exact_tree(tree, df).collect()}
    assert got == pytest.approx({i: 3.0**i for i in range(45)})


def test_boosting_on_windows_stops_on_validation_loss(spark):
    """Windows of the last three games, of which the newest tells most."""
    rng = np.random.default_rng(4)
    games, value = [], {}
    for i in range(1_500):
        player = int(rng.integers(0, 6))
        value[player] = 0.8 * value.get(player, 0.0) + float(rng.normal())
        games.append((player, i, value[player]))
    series = GameSeries.of(spark.createDataFrame(games, "player long, day long, pts double"), ["player"], ["day"])
    windows = window_features(sliding_windows(series, ["pts"], "pts", "day", 3), ["pts"], 3).drop("window_dates")
    train, validation, test = (windows.where(c) for c in ("target_date < 1000", "target_date BETWEEN 1000 AND 1199", "target_date >= 1200"))
    features = ["pts_0", "pts_1", "pts_2"]
    model, curve = boosting.fit_boosted(train, validation, features, "y", rounds=60, patience=5, min_delta=1e-3, depth=3, rate=0.3)
    losses = [(r["loss"], r["val_loss"]) for r in rows(curve.orderBy("round"))]
    best = min(range(len(losses)), key=lambda i: losses[i][1])
    assert losses[0][1] > losses[1][1] > losses[2][1]
    assert all(a[0] >= b[0] for a, b in zip(losses, losses[1:]))  # every round explains more of the training part
    assert len(losses) < 60 and len(model.trees) <= best + 1
    scored = model.predict(test)
    assert scored.count() == test.count()
    plain = test.agg(F.var_pop("y")).first()[0]
    assert E.metrics(scored, "y", "y_pred").first()["mse"] < 0.6 * plain
    # A round goes on from the rounds before: fewer rounds are the first trees of more.
    shorter, _ = boosting.fit_boosted(train, validation, features, "y", rounds=2, depth=3, rate=0.3)
    assert [t.feature for t in shorter.trees] == [t.feature for t in model.trees[:2]]
    assert [v for t in shorter.trees for v in t.value] == pytest.approx([v for t in model.trees[:2] for v in t.value])


def test_boosted_edges(spark, tmp_path):
    data = [(i, float(i % 4), None if i % 9 == 0 else float(i % 3), None if i % 11 == 0 else float(10 * (i % 4))) for i in range(90)]
    df = spark.createDataFrame(data, "id long, a double, b double, y double")
    model, curve = boosting.fit_boosted(df, df.limit(0), ["a", "b"], "y", rounds=3, depth=2, rate=1.0)
    assert curve.where("val_loss IS NULL").count() == 3 and curve.orderBy("round").first()["loss"] == pytest.approx(0.0)
    model.save(spark, str(tmp_path / "m"))
    again = boosting.Boosted.load(spark, str(tmp_path / "m"))
    assert again == model
    scored = {r["id"]: r["y_pred"] for r in again.predict(df).collect()}
    assert scored == {i: None if b is None else pytest.approx(10 * a) for i, a, b, _ in data}
    with pytest.raises(ValueError):
        boosting.fit_boosted(df.limit(0), df, ["a"], "y")


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_best_order_is_that_of_separate_fits(spark, shift):
    """Twenty lags: chosen order, error and weights against one least-squares fit for each order."""
    rng = np.random.default_rng(6)
    data, want = [], {}
    for player, noise in (("a", 0.3), ("b", 2.0)):
        y = rng.normal(size=24).tolist()
        for _ in range(400):
            y.append(0.6 * y[-1] - 0.3 * y[-3] + 0.2 * y[-7] + float(rng.normal(scale=noise)))
        y = [v + shift for v in y]
        table = [(y[i], *[y[i - k] for k in range(1, 21)], i % 5 == 0) for i in range(24, len(y))]
        data += [(player, *r) for r in table]
        fits = []
        for order in range(1, 21):
            x = np.array([[1.0, *[v - shift for v in r[1 : order + 1]]] for r in table])
            t, inside = np.array([r[0] - shift for r in table]), np.array([r[-1] for r in table])
            w = np.linalg.lstsq(x[~inside], t[~inside], rcond=None)[0]
            fits.append((float(((x[inside] @ w - t[inside]) ** 2).mean()), order, [w[0] + shift * (1 - w[1:].sum()), *w[1:]]))
        want[player] = min(fits)
    data += [("short", *([1.0] * 21), False), ("unjudged", *([2.0] * 21), True)]
    lags = [f"y_{k}" for k in range(1, 21)]
    df = spark.createDataFrame(data, f"p string, y double, {', '.join(f'{c} double' for c in lags)}, v boolean").repartition(5)
    found = {r["p"]: r for r in linear.fit_best_order(df, ["p"], lags, "y", "v").collect()}
    for player, (mse, order, weights) in want.items():
        assert found[player]["order"] == order
        assert found[player]["mse"] == pytest.approx(mse, rel=1e-6)
        assert found[player]["weights"] == pytest.approx(weights, rel=1e-4, abs=1e-4 * max(1.0, shift * 1e-3))
    assert found["short"]["order"] is None and found["unjudged"]["weights"] is None


def test_best_order_with_lags_that_say_the_same(spark):
    data = [("a", float(2 * i), float(i), float(i), float(i % 3), i % 4 == 0) for i in range(40)]
    df = spark.createDataFrame(data, "p string, y double, y_1 double, y_2 double, y_3 double, v boolean")
    found = linear.fit_best_order(df, ["p"], ["y_1", "y_2", "y_3"], "y", "v").first()
    assert found["order"] == 1 and found["mse"] == pytest.approx(0.0, abs=1e-12)
    assert found["weights"] == pytest.approx([0.0, 2.0], abs=1e-9)


def test_boosting_keeps_one_row_for_equal_bins(spark, monkeypatch):
    """The state that every round reads and writes is as large as the bins differ, not as the rows."""
    rows = spark.range(4_000).selectExpr("cast(id % 2 AS double) AS a", "cast(id % 3 AS double) AS b", "cast(id % 7 AS double) AS y")
    sizes, grown = [], boosting._grown
    monkeypatch.setattr(boosting, "_grown", lambda state, *rest: sizes.append(state.count()) or grown(state, *rest))
    model, curve = boosting.fit_boosted(rows, rows.where("y < 3"), ["a", "b"], "y", rounds=2, depth=1, rate=1.0)
    assert sizes == [12, 12]
    for part, column in ((rows, "loss"), (rows.where("y < 3"), "val_loss")):
        error = model.predict(part).selectExpr("avg((y - y_pred) * (y - y_pred))").first()[0]
        assert curve.where(f"round = {len(model.trees)}").first()[column] == pytest.approx(error, rel=1e-12)
