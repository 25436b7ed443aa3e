"""Decision trees: Spark ML growth, exact pruning to depth and minimum split size, batched scoring."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import numbered
from starling.operators.features import matrix
from starling.session import shared_dir
from starling.sources.files import delete

# Spark ML refuses deeper trees; stands for "no limit"
MAX_DEPTH = 30


@dataclass(frozen=True)
class TreeConfig:
    name: str
    features: tuple[str, ...]
    max_depth: int | None = None
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    criterion: str = "gini"
    class_weight: str | None = None

    def __post_init__(self) -> None:
        if self.max_depth is not None and self.max_depth > MAX_DEPTH:
            raise ValueError(f"max_depth {self.max_depth}: trees are at most {MAX_DEPTH} deep")

    def growth(self) -> tuple[object, ...]:
        """What decides the order of splits; depth and minimum split size only cut the tree short."""
        return self.features, self.min_samples_leaf, self.criterion, self.class_weight


@dataclass(frozen=True)
class Tree:
    """Node arrays; ``left`` is -1 at a leaf. A row goes left when its value is at most the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    label: np.ndarray
    rows: np.ndarray
    depth: np.ndarray

    def predict(self, x: np.ndarray, max_depth: int | None = None, min_split: int = 2) -> np.ndarray:
        """Labels of rows, the tree cut at a depth and at nodes with fewer rows than ``min_split``.

        Growth is greedy, so cutting a deeper tree gives the tree grown with the limit.
        """
        stop = (self.left < 0) | (self.rows < min_split)
        if max_depth is not None:
            stop = stop | (self.depth >= max_depth)
        at = np.zeros(len(x), dtype=np.int64)
        moving = np.flatnonzero(~stop[at])
        while len(moving):
            node = at[moving]
            goes_left = x[moving, self.feature[node]] <= self.threshold[node]
            at[moving] = np.where(goes_left, self.left[node], self.right[node])
            moving = moving[~stop[at[moving]]]
        return self.label[at]


def assemble(df: DataFrame, columns: Sequence[str], *keep: Column) -> DataFrame:
    """``features`` vector of the given columns, beside ``keep``."""
    inputs = [f"x{i}" for i in range(len(columns))]
    plain = df.select(*numbered(columns), *keep)
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(plain).drop(*inputs)


def grow(
    df: DataFrame, columns: Sequence[str], label: str, max_depth: int | None, min_leaf: int,
    criterion: str, weight: str | None, seed: int = 42, max_bins: int = 256,
) -> DecisionTreeClassificationModel:
    keep = [F.col(label).cast("double").alias("label"), *([F.col(weight).alias("weight")] if weight else [])]
    data = assemble(df, columns, *keep)
    estimator = DecisionTreeClassifier(
        maxDepth=MAX_DEPTH if max_depth is None else max_depth,
        minInstancesPerNode=min_leaf, impurity=criterion, seed=seed, maxBins=max_bins,
    )
    if weight:
        estimator = estimator.setWeightCol("weight")
    return estimator.fit(data)


def read_tree(df: DataFrame, model: DecisionTreeClassificationModel) -> Tree:
    """Node arrays of a fitted model, read from its saved node table."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tree-{uuid.uuid4().hex}"
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "id", "prediction", "rawCount", "leftChild", "rightChild", "split.featureIndex",
        F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
    ).orderBy("id").toPandas()
    delete(spark, path)
    place = {node: i for i, node in enumerate(nodes["id"])}
    left = np.array([place.get(n, -1) for n in nodes["leftChild"]])
    right = np.array([place.get(n, -1) for n in nodes["rightChild"]])
    depth = np.zeros(len(nodes), dtype=int)
    for i in range(len(nodes)):  # ids are in pre-order: a parent precedes its children
        for child in (left[i], right[i]):
            if child >= 0:
                depth[child] = depth[i] + 1
    return Tree(
        feature=np.maximum(nodes["featureIndex"].fillna(-1).to_numpy().astype(int), 0),
        threshold=nodes["threshold"].fillna(0.0).to_numpy().astype(float),
        left=left, right=right, depth=depth,
        label=nodes["prediction"].to_numpy().astype(int),
        rows=nodes["rawCount"].to_numpy().astype(float),
    )


def confusion_many(
    df: DataFrame, columns: Sequence[str], label: str, runs: Mapping[str, tuple[Tree, Sequence[str], TreeConfig]]
) -> DataFrame:
    """Counts by (run, label, prediction) of many trees in one pass over the test rows."""
    where = {c: i for i, c in enumerate(columns)}
    picks = {name: [where[c] for c in used] for name, (_, used, _) in runs.items()}

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = matrix(pdf)
            x, y = values[:, :-1], values[:, -1].astype(int)
            for name, (tree, _, config) in runs.items():
                predicted = tree.predict(x[:, picks[name]], config.max_depth, config.min_samples_split)
                counts = pd.DataFrame({"label": y, "prediction": predicted}).value_counts()
                yield counts.rename("aantal").reset_index().assign(run=name)[["run", "label", "prediction", "aantal"]]

    slim = df.select(*numbered(columns), F.col(label).cast("double").alias("y"))
    parts = slim.mapInPandas(partial, "run string, label int, prediction int, aantal long")
    return parts.groupBy("run", "label", "prediction").agg(F.sum("aantal").alias("aantal"))


def check_no_leak(features: Sequence[str], target: str) -> None:
    """A target among its own features makes every score perfect and worthless."""
    if target in features:
        raise ValueError(f"{target} is both feature and target")
