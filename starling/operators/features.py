"""Seeded split, imputation, scaling, encoding, class weights.

``fit_*`` functions run distributed aggregates and hand back small parameter
objects (one entry per feature or category level); ``apply_*`` are projections.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starling.functions.columns import named

# fixed values: prime modulus and multiplier of the mixing step
_PRIME = 2147483647
_MULTIPLIER = 48271


def mixed(ids: Sequence[str], seed: int) -> Column:
    """Even hash of integer id columns in [0, 2^31-1), in plain integer arithmetic."""
    state: Column = F.lit(seed % _PRIME).cast("long")
    for name in ids:
        state = F.pmod(state + F.col(name).cast("long"), F.lit(_PRIME))
        for _ in range(2):
            state = F.pmod(state * state + state * F.lit(_MULTIPLIER) + F.lit(11), F.lit(_PRIME))
    return state


def matrix(pdf: pd.DataFrame) -> np.ndarray:
    """Values of a batch as doubles; a missing one is an error, as no model here can use it."""
    values = pdf.to_numpy(dtype=float)
    if np.isnan(values).any():
        raise ValueError("missing value among the model's columns")
    return values


def split_hash(df: DataFrame, ids: Sequence[str], seed: int = 42, test_percent: int = 20) -> DataFrame:
    """Add ``is_test``; it depends on the row's ids and the seed, not on partitioning or retries."""
    return df.withColumn("is_test", F.pmod(mixed(ids, seed), F.lit(100)) < test_percent)


def _long(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    cells = [F.struct(F.lit(c).alias("feature"), named(c).cast(dtype).alias("value")) for c in columns]
    return df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").filter("value IS NOT NULL")


def _number(name: str) -> Column:
    """Double value; NaN counts as missing."""
    return F.nanvl(named(name).cast("double"), F.lit(None).cast("double"))


def fit_medians(df: DataFrame, columns: Sequence[str], bins: int = 256) -> dict[str, float | None]:
    """Exact medians without gathering a column.

    Each pass histograms the current bracket of every column at once and keeps
    the bin holding the wanted rank; the bracket becomes that bin's own minimum
    and maximum, so a pass divides it by up to ``bins`` whatever the outliers.
    The driver sees one row per bin. A column is done when its bracket is a
    single value, typically after three or four passes over the pruned columns.
    """
    if not columns:
        return {}
    finite = lambda c: F.when(F.abs(_number(c)) < math.inf, _number(c))
    stats = df.agg(
        *[F.count(_number(c)).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.count(F.when(_number(c) == -math.inf, 1)).alias(f"under{i}") for i, c in enumerate(columns)],
        *[F.count(F.when(_number(c) == math.inf, 1)).alias(f"over{i}") for i, c in enumerate(columns)],
        *[F.min(finite(c)).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(finite(c)).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    found: dict[tuple[str, int], float] = {}
    # one search per wanted rank: (column, rank) -> (low, high, rows below low)
    open_: dict[tuple[str, int], tuple[float, float, int]] = {}
    ranks: dict[str, tuple[int, int]] = {}
    for i, c in enumerate(columns):
        n = stats[f"n{i}"]
        if n:
            ranks[c] = ((n - 1) // 2, n // 2)
            for r in set(ranks[c]):
                if r < stats[f"under{i}"]:
                    found[c, r] = -math.inf
                elif r >= n - stats[f"over{i}"]:
                    found[c, r] = math.inf
                else:
                    open_[c, r] = (stats[f"lo{i}"], stats[f"hi{i}"], stats[f"under{i}"])
    while open_:
        for key, (low, high, _) in list(open_.items()):
            if low == high:
                found[key] = low
                del open_[key]
        brackets = sorted({(c, low, high) for (c, _), (low, high, _) in open_.items()})
        if not brackets:
            break
        bins_of = _histogram(df, brackets, bins)
        for (c, r), (low, high, below) in list(open_.items()):
            for count, bin_low, bin_high in bins_of[c, low, high]:
                if below + count > r:
                    if (bin_low, bin_high) == (low, high):
                        raise RuntimeError(f"{c}: no progress between {low} and {high}")
                    open_[c, r] = (bin_low, bin_high, below)
                    break
                below += count

    def middle(c: str) -> float:
        a, b = found[c, ranks[c][0]], found[c, ranks[c][1]]
        # halves first where the sum leaves the range of doubles
        return a / 2 + b / 2 if math.isinf(a + b) else (a + b) / 2

    return {c: middle(c) if c in ranks else None for c in columns}


def _histogram(df: DataFrame, brackets: Sequence[tuple[str, float, float]], bins: int) -> dict:
    cells = []
    for i, (c, low, high) in enumerate(brackets):
        value = _number(c)
        # halves, because a bracket may be wider than the largest double
        place = F.least(F.floor((value / 2 - low / 2) / (high / 2 - low / 2) * bins), F.lit(bins - 1)).cast("int")
        inside = value.between(low, high)
        cells.append(F.when(inside, F.struct(F.lit(i).alias("bracket"), place.alias("bin"), value.alias("value"))))
    cell = F.explode(F.array(*cells)).alias("cell")
    binned = df.select(cell).filter("cell IS NOT NULL").select("cell.*").groupBy("bracket", "bin")
    rows = binned.agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).collect()
    out: dict[tuple[str, float, float], list[tuple[int, float, float]]] = {b: [] for b in brackets}
    for row in sorted(rows, key=lambda r: (r["bracket"], r["bin"])):
        out[brackets[row["bracket"]]].append((row["n"], row["lo"], row["hi"]))
    return out


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value) with the most rows, the lowest value on a tie.

    Counts per value first, then one reduction per feature, so no task holds
    the distinct values of a column.
    """
    counts = _long(df, columns, "string").groupBy("feature", "value").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col("value").alias("value")))
    return counts.groupBy("feature").agg(best.alias("best")).select("feature", "best.value")


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    rows = {r["feature"]: r["value"] for r in most_frequent(df, columns).collect()} if columns else {}
    return {c: rows.get(c) for c in columns}


def impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    fills = {c: F.coalesce(named(c), F.lit(v).cast(df.schema[c].dataType)) for c, v in values.items()}
    return df.withColumns(fills)


def impute_medians(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    """Fill numeric columns; they become double because a median may lie between two values."""
    return df.withColumns({c: F.coalesce(_number(c), F.lit(v)) for c, v in medians.items()})


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column."""
    if not columns:
        return {}
    row = df.agg(
        *[F.avg(named(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(named(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def scale(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``(x - mean) / deviation``; a constant column becomes 0."""
    rule = lambda c, m, s: (named(c) - F.lit(m)) / F.lit(s) if s else named(c) * 0.0
    return df.withColumns({c: rule(c, m, s) for c, (m, s) in params.items()})


def fit_levels(df: DataFrame, columns: Sequence[str], limit: int = 10000) -> dict[str, list[str]]:
    """Sorted levels per category column, for columns of their own; :mod:`sparse` has no limit.

    More levels than ``limit`` is an error, never a cut.
    """
    if not columns:
        return {}
    levels = _long(df, columns, "string").distinct()
    rows = levels.limit(limit * len(columns) + 1).collect()
    out: dict[str, list[str]] = {c: [] for c in columns}
    for row in rows:
        out[row["feature"]].append(row["value"])
    if len(rows) > limit * len(columns) or any(len(v) > limit for v in out.values()):
        raise ValueError(f"a category column has more than {limit} levels")
    return {c: sorted(v) for c, v in out.items()}


def onehot(df: DataFrame, levels: Mapping[str, Sequence[str]], drop_first: bool = False) -> DataFrame:
    """One 0/1 column ``<column>=<level>`` per level; an unseen value gives zeros everywhere."""
    out = {}
    for c, values in levels.items():
        for level in values[1:] if drop_first else values:
            out[f"{c}={level}"] = F.coalesce((named(c) == level).cast("double"), F.lit(0.0))
    return df.withColumns(out)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight ``n / (k * n_c)`` per class; one pass, then a window over one row per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("aantal"))
    every = Window.partitionBy(F.lit(0))
    total, classes = F.sum("aantal").over(every), F.count("*").over(every)
    return counts.withColumn("gewicht", total.cast("double") / (classes * F.col("aantal")))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    return df.join(class_weights(df, label).drop("aantal"), label, "left")


@dataclass(frozen=True)
class Prepared:
    """Fitted column-wise preprocessing of one feature list."""

    numeric: dict[str, tuple[float, float]]
    medians: dict[str, float]
    modes: dict[str, str]
    levels: dict[str, list[str]]

    def columns(self, features: Sequence[str]) -> list[str]:
        """Output columns of the given input features, in order."""
        out: list[str] = []
        for f in features:
            out += [f] if f in self.numeric else [f"{f}={v}" for v in self.levels[f]]
        return out

    def transform(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        filled = impute(impute_medians(df, self.medians), self.modes)
        ready = onehot(scale(filled, self.numeric), self.levels)
        return ready.select(*keep, *[named(c) for c in self.columns([*self.numeric, *self.levels])])


    def table(self, spark: SparkSession) -> DataFrame:
        """The fitted parameters as rows, one per number and per level, to be stored beside a model."""
        rows = [("number", f, 0, None, self.medians[f], *self.numeric[f]) for f in self.numeric]
        for f, values in self.levels.items():
            rows += [("mode", f, 0, self.modes[f], None, None, None), *[("level", f, i, v, None, None, None) for i, v in enumerate(values)]]
        return spark.createDataFrame(rows, PREPARED)

    @staticmethod
    def read(stored: DataFrame) -> Prepared:
        """Parameters as :meth:`table` wrote them; features come in the order of their names."""
        rows = stored.orderBy("feature", "part", "position").collect()
        numbers = [r for r in rows if r["part"] == "number"]
        modes = {r["feature"]: r["value"] for r in rows if r["part"] == "mode"}
        levels = {f: [r["value"] for r in rows if r["part"] == "level" and r["feature"] == f] for f in modes}
        return Prepared(
            {r["feature"]: (r["mean"], r["deviation"]) for r in numbers}, {r["feature"]: r["median"] for r in numbers}, modes, levels,
        )


PREPARED = "part string, feature string, position int, value string, median double, mean double, deviation double"


def fit_preprocessing(train: DataFrame, numeric: Sequence[str], categories: Sequence[str]) -> Prepared:
    """Median fill and scaling for numbers, most frequent fill and one-hot for the rest."""
    medians = fit_medians(train, numeric)
    modes = fit_modes(train, categories)
    filled = impute(impute_medians(train, medians), modes)
    return Prepared(fit_scaler(filled, numeric), medians, modes, fit_levels(filled, categories))
