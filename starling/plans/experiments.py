"""Experiment grids: regression, decision tree, clustering.

The inputs of a grid are prepared and written once; every run of the grid then
shares the passes over them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import named
from starling.operators import clustering, features, metrics, regression, silhouette, tree
from starling.operators.clustering import KMeansConfig
from starling.operators.frames import numeric_columns, other_columns
from starling.operators.regression import SgdConfig
from starling.operators.tree import TreeConfig
from starling.plans.tables import Tables
from starling.session import stage

ROW_ID = "p_partkey"
PRICE = "price"

BASE = ("quality", "area", "district")
ALL_TEN = ("garage", "quality", "area", "basement", "lot", "built", "baths", "bedrooms", "district", "style")
EIGHT = ("quality", "area", "basement", "built", "baths", "lot", "bedrooms", "district")
NUMBERS = ("quality", "area", "basement", "built", "baths", "lot")

# fixed values: the regression runs
REGRESSION_GRID: list[SgdConfig] = [
    SgdConfig("initial", BASE, 1000, 0.01, "invscaling"),
    SgdConfig("exp 1", BASE, 2000, 0.005, "adaptive"),
    SgdConfig("exp 2", (*BASE, "basement", "built"), 2000, 0.005, "adaptive"),
    SgdConfig("exp 3", (*BASE, "basement", "built", "garage", "style"), 2000, 0.005, "adaptive"),
    SgdConfig("exp 4", ALL_TEN, 2000, 0.005, "adaptive"),
    SgdConfig("exp 5", ALL_TEN, 3000, 0.003, "adaptive"),
    SgdConfig("exp 6", EIGHT, 2000, 0.005, "adaptive", alpha=0.01),
    SgdConfig("exp 7", EIGHT, 2000, 0.005, "adaptive", alpha=0.00001),
    SgdConfig("exp 8", EIGHT, 2000, 0.005, "adaptive", penalty="l1"),
    SgdConfig("exp 9", EIGHT, 2000, 0.005, "adaptive", penalty="elasticnet"),
    SgdConfig("exp 10", EIGHT, 2000, 0.01, "constant"),
    SgdConfig("exp 11", EIGHT, 5000, 0.005, "adaptive"),
    SgdConfig("exp 12", EIGHT, 3000, 0.001, "adaptive"),
    SgdConfig("exp 13", NUMBERS, 2000, 0.005, "adaptive"),
    SgdConfig("exp 14", (*EIGHT, "style"), 2000, 0.005, "adaptive"),
    SgdConfig("exp 15", ("quality", "area"), 2000, 0.005, "adaptive"),
    *[
        SgdConfig(f"exp {i}", EIGHT, 3000, 0.005, "adaptive", alpha=a)
        for i, a in enumerate((0.0005, 0.001, 0.005, 0.02, 0.05), 16)
    ],
]

# fixed values: the tree runs
_SIX = (*BASE, "built", "baths", "lot")
TREE_GRID: list[TreeConfig] = [
    TreeConfig("exp 1", BASE),
    TreeConfig("exp 2", BASE, 10, 5),
    TreeConfig("exp 3", BASE, 3),
    TreeConfig("exp 4", BASE, 7),
    TreeConfig("exp 5", BASE, 15),
    TreeConfig("exp 6", BASE),
    TreeConfig("exp 7", BASE, 5, 5),
    TreeConfig("exp 8", BASE, 5, 20),
    TreeConfig("exp 9", BASE, 5, 50),
    TreeConfig("exp 10", BASE, 5, min_samples_leaf=1),
    TreeConfig("exp 11", BASE, 5, min_samples_leaf=5),
    TreeConfig("exp 12", BASE, 5, min_samples_leaf=10),
    TreeConfig("exp 13", BASE, 5, criterion="entropy"),
    TreeConfig("exp 14", BASE, 10),
    TreeConfig("exp 15", BASE, 5, class_weight="balanced"),
    TreeConfig("exp 16", _SIX, 5),
    TreeConfig("exp 17", ("quality",), 5),
    TreeConfig("exp 18", BASE),
    TreeConfig("exp 19", BASE, 3, 50, 20),
    TreeConfig("exp 20", BASE, 10, min_samples_leaf=5),
    TreeConfig("exp 21", BASE, 15, criterion="entropy"),
    TreeConfig("exp 22", BASE, 7, 20, 5),
]

# fixed values: the cluster runs
_PAIR = ("area", "quality")
_WIDE = ("area", "quality", "built", "lot", "baths", "district")
CLUSTER_GRID: list[KMeansConfig] = [
    KMeansConfig("exp 1", (*_PAIR, "district"), 3),
    KMeansConfig("exp 2", (*_PAIR, "district"), 5),
    KMeansConfig("exp 3", (*_PAIR, "built", "district"), 4),
    KMeansConfig("exp 4", (*_PAIR, "garage", "district"), 6),
    KMeansConfig("exp 5", (*_PAIR, "garage", "baths", "district"), 5),
    *[KMeansConfig(f"exp {i}", (*_PAIR, "district"), k) for i, k in enumerate((2, 4, 6, 8), 6)],
    *[KMeansConfig(f"exp {i}", (*_PAIR, c, "district"), 3) for i, c in enumerate(("built", "lot", "baths"), 10)],
    KMeansConfig("exp 13", _WIDE, 4),
    KMeansConfig("exp 14", _WIDE, 5),
    KMeansConfig("exp 15", (*_PAIR, "built", "lot"), 3),
    KMeansConfig("exp 16", _PAIR, 3),
    KMeansConfig("exp 17", (*_PAIR, "district"), 3, n_init=20),
    KMeansConfig("exp 18", (*_PAIR, "district"), 3, n_init=50),
    KMeansConfig("exp 19", (*_PAIR, "district"), 3, seed=1),
    KMeansConfig("exp 20", (*_PAIR, "district"), 3, seed=100),
    KMeansConfig("exp 21", _WIDE, 6),
    KMeansConfig("exp 22", _WIDE, 7),
    KMeansConfig("exp 23", (*_PAIR, "garage", "district"), 4),
    KMeansConfig("exp 24", (*_PAIR, "garage", "baths", "district"), 5),
    KMeansConfig("exp 25", (*_PAIR, "built", "lot", "baths", "garage", "district"), 8),
]


def profile(t: Tables) -> DataFrame:
    """Ten features and a price per sold part, aggregated from its lines."""
    year = F.year("l_shipdate")
    lines = t.lineitem.groupBy("l_partkey").agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("basement"),
        F.min(year).cast("double").alias("built"),
        F.count(F.when(F.col("l_linestatus") == "F", 1)).cast("double").alias("baths"),
        F.max("l_quantity").alias("lot"),
        F.count("*").cast("double").alias("bedrooms"),
        F.avg("l_tax").alias("tax"),
        F.avg("l_extendedprice").alias(PRICE),
    )
    return t.part.join(lines, F.col("p_partkey") == F.col("l_partkey")).select(
        ROW_ID, F.col("p_size").cast("double").alias("quality"), F.col("p_retailprice").alias("area"),
        F.col("p_brand").alias("district"), F.col("p_type").alias("style"),
        F.when(F.col("tax") > 0.039, "yes").otherwise("no").alias("garage"),
        "basement", "built", "baths", "lot", "bedrooms", PRICE,
    )


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    marked = features.split_hash(df, [ROW_ID])
    return marked.filter("NOT is_test"), marked.filter("is_test")


def regression_grid(df: DataFrame, grid: Sequence[SgdConfig]) -> DataFrame:
    """One row of settings and metrics per run, best RMSE first."""
    spark = df.sparkSession
    data = stage(df, ROW_ID)
    used = [c for c in data.columns if any(c in g.features for g in grid)]
    for g in grid:
        tree.check_no_leak(g.features, PRICE)
    train, test = _split(data)
    inputs = data.select(*used)
    ready = features.fit_preprocessing(train, numeric_columns(inputs), other_columns(inputs))
    columns = ready.columns(used)
    g = regression.gram(ready.transform(train, [PRICE]), columns, PRICE)
    weights, status = {}, {}
    for config in grid:
        own = ready.columns(config.features)
        try:
            found = regression.descend(g, own, config)
        except ValueError as error:  # its step length diverges; the other runs stand
            status[config.name] = str(error)
            continue
        full = np.zeros(len(columns) + 1)
        full[[0, *[columns.index(c) + 1 for c in own]]] = found
        weights[config.name] = full
    scores = regression.score_many(ready.transform(test, [PRICE]), columns, PRICE, weights)
    settings = [
        (c.name, ", ".join(c.features), len(c.features), c.max_iter, c.eta0, c.learning_rate, c.alpha, c.penalty, status.get(c.name, "OK"))
        for c in grid
    ]
    schema = (
        "experiment string, features string, n_features int, max_iter int, eta0 double, "
        "learning_rate string, alpha double, penalty string, status string"
    )
    # a run without result has no scores and comes last
    return rank(
        spark.createDataFrame(settings, schema).join(scores, F.col("experiment") == F.col("run"), "left").drop("run"), "rmse"
    )


def rank(results: DataFrame, metric: str, descending: bool = False) -> DataFrame:
    """Runs in order of a metric, the name deciding ties."""
    order = F.col(metric).desc_nulls_last() if descending else F.col(metric).asc_nulls_last()
    return results.orderBy(order, "experiment")


def combine(parts: Sequence[DataFrame], metric: str, descending: bool = False) -> DataFrame:
    """Result tables of several grids as one ranking."""
    return rank(reduce(DataFrame.unionByName, parts), metric, descending)


def best(results: DataFrame, metric: str, descending: bool = False) -> DataFrame:
    return rank(results, metric, descending).limit(1)


def optimum_coefficients(df: DataFrame, config: SgdConfig) -> DataFrame:
    """Coefficients of the penalised optimum over the training rows."""
    data = stage(df, ROW_ID)
    inputs = data.select(*config.features)
    train, _ = _split(data)
    ready = features.fit_preprocessing(train, numeric_columns(inputs), other_columns(inputs))
    columns = ready.columns(config.features)
    model = regression.fit_optimum(
        ready.transform(train, [PRICE]), columns, PRICE, config.alpha, regression.l1_share(config)
    )
    rows = [("(intercept)", float(model.intercept)), *zip(columns, map(float, model.coefficients))]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def tree_confusions(df: DataFrame, grid: Sequence[TreeConfig], label: str = "garage") -> DataFrame:
    """Test rows by (run, label, prediction). Runs alike but for depth or split size share one grown tree."""
    target = F.when(F.col(label) == "yes", 1).when(F.col(label) == "no", 0)
    used = [c for c in df.columns if any(c in g.features for g in grid)]
    for g in grid:
        tree.check_no_leak(g.features, label)
    raw = df.select(ROW_ID, *used, target.alias("target")).filter("target IS NOT NULL")
    train, test = _split(stage(raw, ROW_ID))
    categories = other_columns(train.select(*used))
    levels = features.fit_levels(train, categories)
    columns = [c for f in used for c in ([f"{f}={v}" for v in levels[f]] if f in levels else [f])]
    names_of = lambda fs: [c for c in columns if c in fs or c.split("=")[0] in fs]
    encoded = features.with_class_weights(features.onehot(train, levels), "target")
    keep = [named(c) for c in columns]
    ready = encoded.select("target", "gewicht", *keep).persist()
    grown: dict[tuple, tree.Tree] = {}
    for growth in {g.growth(): None for g in grid}:
        alike = [g for g in grid if g.growth() == growth]
        depth = None if any(g.max_depth is None for g in alike) else max(g.max_depth for g in alike)
        first = alike[0]
        weight = "gewicht" if first.class_weight == "balanced" else None
        model = tree.grow(
            ready, names_of(first.features), "target", depth, first.min_samples_leaf, first.criterion, weight
        )
        grown[growth] = tree.read_tree(ready, model)
    ready.unpersist()
    runs = {g.name: (grown[g.growth()], names_of(g.features), g) for g in grid}
    return tree.confusion_many(features.onehot(test, levels).select("target", *keep), columns, "target", runs)


def tree_grid(df: DataFrame, grid: Sequence[TreeConfig], label: str = "garage") -> DataFrame:
    """Binary tree runs, best F1 first."""
    by_run: dict[str, list] = {g.name: [] for g in grid}
    for row in tree_confusions(df, grid, label).collect():
        by_run[row["run"]].append((row["label"], row["prediction"], row["aantal"]))
    settings = [
        (g.name, ", ".join(g.features), g.max_depth, g.min_samples_split, g.min_samples_leaf, g.criterion,
         g.class_weight, *binary_scores(by_run[g.name]))
        for g in grid
    ]
    schema = (
        "experiment string, features string, max_depth int, min_samples_split int, min_samples_leaf int, "
        "criterion string, class_weight string, accuracy double, precision double, recall double, f1 double"
    )
    return rank(df.sparkSession.createDataFrame(settings, schema), "f1", descending=True)


def leak_check(df: DataFrame, seed: int = 42) -> DataFrame:
    """Many-class trees with and without the target among the features, weighted metrics.

    With it, every score is perfect: a check on the evaluation and not a model to keep.
    """
    graded = df.withColumn("grade", F.ceil(F.col("quality") / 10).cast("double"))
    train, test = _split(stage(graded.select(ROW_ID, "grade", "area", "built", "lot"), ROW_ID))
    results = []
    for used in (("grade", "area", "built"), ("area", "built", "lot")):
        model = tree.grow(train, used, "grade", 5, 1, "gini", None, seed)
        scored = model.transform(tree.assemble(test, used, F.col("grade")))
        pairs = metrics.pair_counts(scored, "grade", "prediction")
        hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("aantal")).otherwise(0)) / F.sum("aantal")
        accuracy = pairs.agg(hit.alias("accuracy"))
        results.append(metrics.weighted_metrics(pairs).select(
            F.lit(", ".join(used)).alias("features"), F.lit("grade" in used).alias("leak"),
            accuracy.scalar().alias("accuracy"), "precision", "recall", "f1",
        ))
    return results[0].unionByName(results[1])


def line_fit(df: DataFrame, feature: str, target: str) -> DataFrame:
    """Intercept and slope of the unpenalised line, from one pass of product sums."""
    xx, xy, _ = regression.gram(df, [feature], target).system([feature])
    intercept, slope = (float(v) for v in np.linalg.solve(xx, xy))
    return df.sparkSession.createDataFrame([(intercept, slope)], "intercept double, slope double")


def line_rows(df: DataFrame, feature: str, target: str, *keep: str) -> DataFrame:
    """Every row with its actual value, the value on the fitted line, and what lies between."""
    line = line_fit(df, feature, target).first()
    predicted = F.lit(line["intercept"]) + F.lit(line["slope"]) * F.col(feature)
    actual = F.col(target)
    return df.select(*keep, actual.alias("actual"), predicted.alias("predicted"), (actual - predicted).alias("residual"))


def binary_scores(pairs: Sequence[tuple[int, int, int]]) -> tuple[float, float, float, float]:
    """Accuracy, precision, recall and F1 from (label, prediction, count) triples."""
    cell = {(label, guess): n for label, guess, n in pairs}
    tp, fp, fn, tn = (cell.get(k, 0) for k in ((1, 1), (0, 1), (1, 0), (0, 0)))
    ratio = lambda a, b: a / b if b else 0.0
    return ratio(tp + tn, tp + fp + fn + tn), ratio(tp, tp + fp), ratio(tp, tp + fn), ratio(2 * tp, 2 * tp + fp + fn)


def cluster_inputs(df: DataFrame, used: Sequence[str]) -> tuple[DataFrame, dict[str, list[str]]]:
    """Scaled dummies (first level dropped) and numbers, and the columns of each feature."""
    # levels, scaler and rows each read the input: it is computed once
    data = stage(df.select(ROW_ID, *used))
    categories = other_columns(data.select(*used))
    levels = features.fit_levels(data, categories)
    encoded = features.onehot(data, levels, drop_first=True)
    columns_of = {f: [f"{f}={v}" for v in levels[f][1:]] if f in levels else [f] for f in used}
    columns = [c for f in used for c in columns_of[f]]
    plain = encoded.select(ROW_ID, *[named(c) for c in columns])
    return stage(features.scale(plain, features.fit_scaler(plain, columns)), ROW_ID), columns_of


def _columns(config: KMeansConfig, columns_of: dict[str, list[str]]) -> list[str]:
    return [c for f in config.features for c in columns_of[f]]


def plain_silhouette(data: DataFrame, model: clustering.Clustering) -> float:
    """Mean silhouette on plain distances: quadratic in the rows."""
    vector = F.array(*[named(c).cast("double") for c in model.columns])
    placed = clustering.assign(data.withColumn("_vector", vector), ROW_ID, model, keep=["_vector"])
    return silhouette.mean_silhouette(silhouette.silhouette_exact(placed, ROW_ID, "_vector", "cluster")).first()[0]


def cluster_grid(df: DataFrame, grid: Sequence[KMeansConfig], plain: bool = False) -> DataFrame:
    """Cluster runs, best silhouette first: on squared distances in linear work or, if wanted, on plain ones."""
    used = [c for c in df.columns if any(c in g.features for g in grid)]
    data, columns_of = cluster_inputs(df, used)
    models = clustering.fit_kmeans(data, ROW_ID, {g.name: _columns(g, columns_of) for g in grid}, grid)
    scores = {g.name: plain_silhouette(data, models[g.name]) for g in grid} if plain else clustering.mean_silhouettes(data, models)
    rows = [
        (g.name, ", ".join(g.features), len(g.features), g.k, g.n_init, g.seed, models[g.name].inertia,
         scores[g.name])
        for g in grid
    ]
    schema = (
        "experiment string, features string, n_features int, k int, n_init int, seed int, inertia double, "
        "silhouette double"
    )
    return rank(df.sparkSession.createDataFrame(rows, schema), "silhouette", descending=True)


def elbow(df: DataFrame, ks: Sequence[int] = range(2, 11), used: Sequence[str] = (*_PAIR, "district")) -> DataFrame:
    """Sum of squared distances per number of clusters."""
    data, columns_of = cluster_inputs(df, used)
    grid = [KMeansConfig(f"k={k}", tuple(used), k) for k in ks]
    models = clustering.fit_kmeans(data, ROW_ID, {g.name: _columns(g, columns_of) for g in grid}, grid)
    rows = [(g.k, models[g.name].inertia) for g in grid]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def cluster_plane(df: DataFrame, k: int = 3, used: Sequence[str] = (*_PAIR, "district")) -> DataFrame:
    """Each row's cluster and its place on the first two principal components."""
    data, columns_of = cluster_inputs(df, used)
    config = KMeansConfig("plane", tuple(used), k)
    columns = _columns(config, columns_of)
    model = clustering.fit_kmeans(data, ROW_ID, {"plane": columns}, [config])["plane"]
    plane = clustering.principal_components(data, ROW_ID, columns)
    return clustering.assign(data, ROW_ID, model).select(ROW_ID, "cluster").join(plane, ROW_ID)
