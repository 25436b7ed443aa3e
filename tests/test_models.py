"""Preparation, metrics, models and grids against brute force and known answers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from starling.operators import clustering, features, metrics, regression, silhouette, tree
from starling.plans import experiments as grids


@pytest.fixture(scope="module")
def profile(tables):
    data = grids.profile(tables).cache()
    yield data
    data.unpersist()


# preparation


def test_median_and_mode(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "b"), (10.0, "a"), (None, None)], "x double, c string")
    assert features.fit_medians(df, ["x"]) == {"x": 2.5}
    assert features.fit_modes(df, ["c"]) == {"c": "a"}
    gaps = spark.createDataFrame([(float("nan"),), (1.0,), (4.0,), (None,)], "x double")
    assert [r.x for r in features.impute_medians(gaps, features.fit_medians(gaps, ["x"])).collect()] == [2.5, 1, 4, 2.5]
    assert features.fit_medians(df.limit(0), ["x"]) == {"x": None} and features.fit_modes(df.limit(0), ["c"]) == {"c": None}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_median_is_exact_on_awkward_values(spark, seed):
    rng = np.random.default_rng(seed)
    wild = np.where(rng.random(2001) < 0.3, 7.0, rng.normal(size=2001) * 10.0 ** rng.integers(-8, 9, 2001))
    few = rng.integers(-2, 3, 2001).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(wild, few)], "a double, b double").repartition(5)
    got = features.fit_medians(df, ["a", "b"], bins=16)
    assert got == {"a": float(np.median(wild)), "b": float(np.median(few))}
    even = df.limit(1000).toPandas()
    assert features.fit_medians(spark.createDataFrame(even), ["a"], bins=4) == {"a": float(np.median(even["a"]))}


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0), (5.0, 4.0)], "x double, c double")
    got = features.scale(df, features.fit_scaler(df, ["x", "c"])).collect()
    assert [r.x for r in got] == pytest.approx([-(1.5**0.5), 0, 1.5**0.5]) and [r.c for r in got] == [0, 0, 0]


def test_encoding(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    levels = features.fit_levels(train, ["c"])
    new = spark.createDataFrame([("z",), ("b",), (None,)], "c string")
    assert [tuple(r)[1:] for r in features.onehot(new, levels).collect()] == [(0, 0, 0), (0, 1, 0), (0, 0, 0)]
    assert features.onehot(new, levels, drop_first=True).columns == ["c", "c=b", "c=c"]
    with pytest.raises(ValueError):
        features.fit_levels(train, ["c"], limit=2)
    odd = spark.createDataFrame([(1.0, "St. J`s"), (2.0, "b=c"), (4.0, "b=c")], "`x.1` double, `c.1` string")
    ready = features.fit_preprocessing(odd, ["x.1"], ["c.1"])
    columns = ready.columns(["x.1", "c.1"])
    coded = ready.transform(odd.withColumn("y", F.lit(1)), ["y"])
    assert coded.columns == ["y", *columns] == ["y", "x.1", "c.1=St. J`s", "c.1=b=c"]
    assert tree.assemble(coded, columns, F.col("y")).count() == 3
    assert regression.gram(coded, columns, "y").rows == 3


def test_split_is_stable_and_near_the_share(spark):
    df = spark.range(20000)
    got = features.split_hash(df, ["id"])
    test = {r.id for r in got.filter("is_test").collect()}
    assert abs(len(test) / 20000 - 0.2) < 0.01
    assert test == {r.id for r in features.split_hash(df.repartition(7), ["id"]).filter("is_test").collect()}
    other = {r.id for r in features.split_hash(df, ["id"], seed=1).filter("is_test").collect()}
    assert len(test & other) / len(test) < 0.25


# metrics


def test_binary_metrics_of_a_known_confusion(spark):
    pairs = spark.createDataFrame([(1, 1, 541), (0, 0, 10), (0, 1, 27), (1, 0, 8)], "label int, prediction int, aantal long")
    got = metrics.binary_metrics(pairs).first()
    assert tuple(got) == pytest.approx((0.9403, 0.9525, 0.9854, 0.9687), abs=5e-5)
    assert grids.binary_scores([tuple(r) for r in pairs.collect()]) == pytest.approx(tuple(got))
    assert [tuple(r) for r in metrics.confusion_matrix(pairs, [0, 1]).orderBy("label").collect()] == [(0, 10, 27), (1, 8, 541)]


def test_zero_denominators(spark):
    pairs = spark.createDataFrame([(1, 0, 3), (0, 0, 2)], "label int, prediction int, aantal long")
    got = metrics.binary_metrics(pairs).first()
    assert (got.precision, got.recall, got.f1) == (0.0, 0.0, 0.0)
    assert metrics.confusion_matrix(pairs, [0, 1]).filter("label = 0").first().pred_1 == 0


def brute_silhouette(x, labels, power):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    out = []
    for i, own in enumerate(labels):
        if (labels == own).sum() == 1:
            out.append(0.0)
            continue
        a = d[i, labels == own].sum() / ((labels == own).sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.mark.parametrize("power,score", [(1, silhouette.silhouette_exact), (2, silhouette.silhouette_squared)])
def test_silhouettes_match_brute_force(spark, power, score):
    rng = np.random.default_rng(3)
    labels = np.array([0] * 40 + [1] * 19 + [2])
    x = rng.normal(size=(60, 3)) + labels[:, None] * 2
    df = spark.createDataFrame([(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(labels, x))],
                               "id long, c int, v array<double>")
    options = {"block_rows": 7} if power == 1 else {}
    got = {r.id: r.silhouette for r in score(df, "id", "v", "c", **options).collect()}
    assert [got[i] for i in range(60)] == pytest.approx(brute_silhouette(x, labels, power))


# regression


@pytest.mark.parametrize("penalty", ["l2", "l1", "elasticnet"])
def test_descent_reaches_the_optimum(spark, penalty):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    x = (x - x.mean(0)) / x.std(0)
    y = 100 + x @ [30, -5, 0.2] + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, y double")
    config = regression.SgdConfig("t", ("a", "b", "c"), 3000, 0.005, "adaptive", alpha=0.5, penalty=penalty, tol=1e-9)
    g = regression.gram(df, ["a", "b", "c"], "y")
    assert g.rows == 400
    w = regression.descend(g, ["a", "b", "c"], config)
    best = regression.fit_optimum(df, ["a", "b", "c"], "y", 0.5, regression.l1_share(config))
    assert w == pytest.approx([best.intercept, *best.coefficients], abs=1e-3)
    scored = regression.score_many(df, ["a", "b", "c"], "y", {"r": w}).first()
    error = w[0] + x @ w[1:] - y
    assert scored.mae == pytest.approx(np.abs(error).mean()) and scored.mse == pytest.approx((error**2).mean())
    assert scored.r2 == pytest.approx(1 - (error**2).sum() / ((y - y.mean()) ** 2).sum())


@pytest.mark.parametrize("rate", ["constant", "invscaling", "adaptive"])
def test_schedules_converge(rate):
    g = regression.Gram(("a",), np.array([[100.0, 0, 500.0], [0, 100.0, 300.0], [500.0, 300.0, 3500.0]]))
    w = regression.descend(g, ["a"], regression.SgdConfig("t", ("a",), 1000, 0.01, rate, alpha=0.0))
    assert w == pytest.approx([5.0, 3.0], abs=0.05)


# trees


def test_cut_tree_equals_the_tree_grown_with_the_limit(spark, profile):
    columns = ["quality", "area", "built", "lot"]
    data = profile.withColumn("target", F.when(F.col("garage") == "yes", 1).otherwise(0)).cache()
    deep = tree.read_tree(data, tree.grow(data, columns, "target", None, 1, "gini", None))
    x = data.select(*columns).toPandas().to_numpy(dtype=float)
    vectors = VectorAssembler(inputCols=columns, outputCol="features").transform(data)
    for depth in (1, 3, 6):
        model = tree.grow(data, columns, "target", depth, 1, "gini", None)
        own = np.array([r.prediction for r in model.transform(vectors).select("prediction").collect()])
        assert (deep.predict(x, max_depth=depth) == own).all()
        assert (tree.read_tree(data, model).predict(x) == own).all()


def test_minimum_split_size_leaves_no_small_internal_node(spark, profile):
    columns = ["quality", "area"]
    data = profile.withColumn("target", F.when(F.col("garage") == "yes", 1).otherwise(0))
    deep = tree.read_tree(data, tree.grow(data, columns, "target", None, 1, "gini", None))
    x = data.select(*columns).toPandas().to_numpy(dtype=float)
    cut = deep.predict(x, min_split=50)
    # walk by hand
    for row, label in zip(x, cut):
        node = 0
        while deep.left[node] >= 0 and deep.rows[node] >= 50:
            node = deep.left[node] if row[deep.feature[node]] <= deep.threshold[node] else deep.right[node]
        assert deep.label[node] == label


def test_leak_is_refused():
    with pytest.raises(ValueError):
        tree.check_no_leak(["quality", "area"], "quality")


def test_leaked_target_scores_perfectly(profile):
    found = {r.leak: r for r in grids.leak_check(profile).collect()}
    assert found[True].accuracy == found[True].f1 == 1.0 and found[False].accuracy < 0.5


# clustering


def test_kmeans_finds_clear_groups(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(50, 2)) * 0.1 + c for c in ((0, 0), (5, 5), (0, 9))])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double").repartition(4)
    configs = [clustering.KMeansConfig(f"k{k}", ("a", "b"), k, n_init=5) for k in (2, 3, 4)]
    models = clustering.fit_kmeans(df, "id", {c.name: ["a", "b"] for c in configs}, configs)
    labels = np.repeat([0, 1, 2], 50)
    expected = sum(((x[labels == c] - x[labels == c].mean(0)) ** 2).sum() for c in range(3))
    assert models["k3"].inertia == pytest.approx(expected)
    assert models["k2"].inertia > models["k3"].inertia > models["k4"].inertia
    assigned = clustering.assign(df, "id", models["k3"])
    assert sorted(r["count"] for r in assigned.groupBy("cluster").count().collect()) == [50, 50, 50]
    scored = silhouette.silhouette_squared(assigned, "id", "features", "cluster")
    mean = silhouette.mean_silhouette(scored).first()[0]
    assert clustering.mean_silhouettes(df, models)["k3"] == pytest.approx(mean) and mean > 0.95


def test_kmeans_finds_a_rare_far_cluster(spark):
    far = F.when(F.col("id") % 50_000 == 7, 1e4).otherwise(F.sin("id"))
    df = spark.range(0, 200_000, 1, 8).select("id", far.alias("a"), F.cos("id").alias("b"))
    model = clustering.fit_kmeans(df, "id", {"k": ["a", "b"]}, [clustering.KMeansConfig("k", ("a", "b"), 2, n_init=2)])["k"]
    assert sorted(r["count"] for r in clustering.assign(df, "id", model).groupBy("cluster").count().collect()) == [4, 199_996]


def test_kmeans_of_few_distinct_rows(spark):
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(5)], "id long, a double, b double")
    fit = lambda frame, k: clustering.fit_kmeans(frame, "id", {"k": ["a", "b"]}, [clustering.KMeansConfig("k", ("a", "b"), k, n_init=1)])["k"]
    assert fit(df, 3).inertia == 0
    with pytest.raises(ValueError, match="cannot form"):
        fit(df.limit(2), 3)


def test_missing_features_are_refused(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0), (3, 4.0, 9.0)], "id long, a double, b double")
    with pytest.raises(Exception, match="missing value"):
        clustering.fit_kmeans(df, "id", {"k": ["a", "b"]}, [clustering.KMeansConfig("k", ("a", "b"), 2, n_init=1)])
    with pytest.raises(Exception, match="missing value"):
        regression.gram(df, ["a"], "b")


def test_principal_components(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=200)
    x = np.column_stack([base, base + rng.normal(size=200) * 0.1, rng.normal(size=200)])
    x = (x - x.mean(0)) / x.std(0)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "id long, a double, b double, c double")
    got = clustering.principal_components(df, "id", ["a", "b", "c"]).orderBy("id").toPandas()
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    for i in (0, 1):
        axis = axes[i] * np.sign(axes[i][np.abs(axes[i]).argmax()])
        assert got[f"pc{i + 1}"].to_numpy() == pytest.approx(x @ axis, abs=1e-6)


# grids


def test_grids_rank_all_their_runs(profile):
    reg = grids.regression_grid(profile, grids.REGRESSION_GRID)
    found = reg.collect()
    assert len(found) == 21 and [r.rmse for r in found] == sorted(r.rmse for r in found)
    assert grids.best(reg, "rmse").first().experiment == found[0].experiment
    twice = grids.combine([reg, reg.limit(2)], "rmse").collect()
    assert len(twice) == 23 and twice[0].experiment == twice[1].experiment
    trees = grids.tree_grid(profile, grids.TREE_GRID).collect()
    assert len(trees) == 22 and [r.f1 for r in trees] == sorted((r.f1 for r in trees), reverse=True)
    by_name = {r.experiment: r for r in trees}
    assert by_name["exp 1"].f1 == by_name["exp 6"].f1 == by_name["exp 18"].f1


def test_cluster_grid_and_elbow(profile):
    runs = grids.cluster_grid(profile, grids.CLUSTER_GRID[:3]).collect()
    assert len(runs) == 3 and all(-1 <= r.silhouette <= 1 for r in runs)
    inertia = [r.inertia for r in grids.elbow(profile, ks=(2, 3, 5)).orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)


def test_medians_of_extreme_values(spark):
    from starling.operators.features import fit_medians

    inf = float("inf")
    frame = spark.createDataFrame([(-1.7e308, inf, -inf), (1.7e308, inf, 1.0), (3.0, 1.0, 2.0), (-2.0, -inf, 3.0), (5.0, 2.0, None)], "a double, b double, c double")
    assert fit_medians(frame, ["a", "b", "c"]) == {"a": 3.0, "b": 2.0, "c": 1.5}


def test_versions_open_at_the_wall_clock_time(spark, monkeypatch):
    import time
    from datetime import datetime

    from starling.operators import scd

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        frame = spark.createDataFrame([("a", 1)], "k string, v long")
        opened = scd.scd2_initial(frame, "k", "sk", datetime(2021, 1, 1)).selectExpr("cast(begin_tijd as string) as b").first()[0]
    finally:
        monkeypatch.undo()
        time.tzset()
    assert opened == "2021-01-01 00:00:00"


def test_descent_does_not_depend_on_the_number_of_rows(spark):
    from dataclasses import replace

    from starling.operators import regression as R

    frame = spark.range(200).selectExpr("cast(id % 7 as double) / 3 - 1 as x", "cast(id % 5 as double) / 2 - 1 as z", "cast(id % 7 + 2 * (id % 5) as double) as y")
    many = frame.crossJoin(spark.range(50)).drop("id")
    once, often = (R.gram(f, ["x", "z"], "y") for f in (frame, many))
    config = R.SgdConfig("c", ("x", "z"), max_iter=3, eta0=0.01, learning_rate="constant")
    assert np.allclose(R.descend(once, ["x", "z"], config), R.descend(often, ["x", "z"], config))
    other = R.descend(often, ["x", "z"], replace(config, eta0=0.001))
    assert not np.allclose(other, R.descend(often, ["x", "z"], config), rtol=0.01)
    with pytest.raises(ValueError):
        R.descend(once, ["x", "z"], replace(config, eta0=50.0))


def test_depth_beyond_the_library_is_an_error():
    from starling.operators.tree import TreeConfig

    with pytest.raises(ValueError):
        TreeConfig("deep", ("x",), max_depth=31)
