"""Model metrics as aggregates over label and prediction columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    """0 when the denominator is 0."""
    return F.when(bottom == 0, 0.0).otherwise(top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0)))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    # n * population variance is the total sum of squares, stable and one pass
    sums = df.agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.var_pop(y).alias("_var"),
    )
    return sums.select("mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.col("mse") / F.col("_var")).alias("r2"))


def predicted_bounds(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Common axis bounds of actual and predicted values."""
    return df.agg(
        F.least(F.min(label), F.min(prediction)).alias("min_val"),
        F.greatest(F.max(label), F.max(prediction)).alias("max_val"),
    )


def pair_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("aantal")
    )


def binary_metrics(pairs: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of :func:`pair_counts`, positive label 1."""
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("aantal"))), F.lit(0))
    y, p = F.col("label") == 1, F.col("prediction") == 1
    sums = pairs.agg(
        total(y & p).alias("tp"), total(~y & p).alias("fp"), total(y & ~p).alias("fn"), total(~y & ~p).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return sums.select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_metrics(pairs: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, from counts by (label, prediction)."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("aantal")).otherwise(0)
    seen = lambda klasse, support, predicted, hits: F.struct(
        klasse.alias("klasse"), support.alias("support"), predicted.alias("predicted"), hits.alias("hit"))
    none = F.lit(0).cast("long")
    # each count speaks for its label and for its prediction
    both = F.array(
        seen(F.col("label"), F.col("aantal"), none, hit), seen(F.col("prediction"), none, F.col("aantal"), none)
    )
    sums = pairs.select(F.inline(both)).groupBy("klasse").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit")
    )
    return sums.select(
        "klasse",
        "support",
        _ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hit"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hit"), F.col("support") + F.col("predicted")).alias("f1"),
    )


def weighted_metrics(pairs: DataFrame) -> DataFrame:
    """Class metrics averaged with the class support as weight."""
    mean = lambda c: (F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(c)
    return class_metrics(pairs).agg(mean("precision"), mean("recall"), mean("f1"))


def confusion_matrix(pairs: DataFrame, labels: Sequence[object]) -> DataFrame:
    """One row per true label, one column per predicted label, zeros filled."""
    return (
        pairs.groupBy("label")
        .pivot("prediction", list(labels))
        .agg(F.sum("aantal"))
        .na.fill(0)
        .select("label", *[F.col(f"`{v}`").alias(f"pred_{v}") for v in labels])
    )


def cluster_sizes(df: DataFrame, cluster: str) -> DataFrame:
    return df.groupBy(F.col(cluster).alias("cluster")).agg(F.count("*").alias("aantal"))
