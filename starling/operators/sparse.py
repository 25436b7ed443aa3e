"""Categories of any number of levels: a level table, rows as index arrays, ridge by aggregation.

Nothing here has one entry per level on the driver. Levels and coefficients are tables; the
product sums of a row are those of its few non-zero entries.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import named
from starling.operators.keys import dense_keys
from starling.session import broadcast_if_small

Keep = Callable[[DataFrame], DataFrame]
INTERCEPT = "(intercept)"


def fit_levels(df: DataFrame, numeric: Sequence[str], categories: Sequence[str], keep: Keep) -> DataFrame:
    """``(feature, value, idx)``: 0 for the intercept, then the numbers (value null), then every level of every category."""
    spark = df.sparkSession
    fixed = [(INTERCEPT, None, 0), *[(c, None, i) for i, c in enumerate(numeric, 1)]]
    first = spark.createDataFrame(fixed, "feature string, value string, idx long")
    if not categories:
        return keep(first)
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), named(c).cast("string").alias("value")) for c in categories])
    levels = keep(df.select(F.explode(cells).alias("cell")).select("cell.*").filter("value IS NOT NULL").distinct())
    return keep(first.unionByName(dense_keys(levels, ["feature", "value"], "idx", start=len(numeric)).select("feature", "value", "idx")))


def encode(df: DataFrame, numeric: Sequence[str], categories: Sequence[str], levels: DataFrame, *keep: str | Column) -> DataFrame:
    """``keep`` and ``entries``, the non-zeros of each row as (idx, value) by index; an unseen or missing level has none."""
    out = df
    for n, c in enumerate(categories):
        own = levels.filter((F.col("feature") == c) & F.col("value").isNotNull()).select(F.col("value").alias("_value"), F.col("idx").alias(f"_idx{n}"))
        out = out.join(broadcast_if_small(own, own), named(c).cast("string") == F.col("_value"), "left").drop("_value")
    entry = lambda idx, value: F.struct(idx.cast("long").alias("idx"), value.cast("double").alias("value"))
    cells = [entry(F.lit(0), F.lit(1.0)), *[entry(F.lit(i), named(c)) for i, c in enumerate(numeric, 1)]]
    cells += [F.when(F.col(f"_idx{n}").isNotNull(), entry(F.col(f"_idx{n}"), F.lit(1.0))) for n in range(len(categories))]
    return out.select(*keep, F.array_sort(F.array_compact(F.array(*cells))).alias("entries"))


def product_sums(encoded: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Sums over rows: ``(i, j, total)`` of products of non-zeros, each pair in both orders, and ``(i, total)`` with the target.

    Pairs are made row by row and added up in the tasks before they are shuffled.
    """
    each = encoded.select(F.col(target).alias("y"), "entries", F.explode("entries").alias("a"))
    with_target = each.groupBy(F.col("a.idx").alias("i")).agg(F.sum(F.col("a.value") * F.col("y")).alias("total"))
    pairs = each.select("a", F.explode("entries").alias("b"))
    products = pairs.groupBy(F.col("a.idx").alias("i"), F.col("b.idx").alias("j")).agg(F.sum(F.col("a.value") * F.col("b.value")).alias("total"))
    return products, with_target


def ridge(encoded: DataFrame, target: str, levels: DataFrame, alpha: float, keep: Keep, tolerance: float = 1e-10, rounds: int = 500) -> DataFrame:
    """``(feature, value, coefficient)`` of least squares with ``alpha`` times the squared coefficients, the intercept free.

    The loss is the mean over rows. The system is solved by conjugate gradients with the
    diagonal as preconditioner; its vectors are tables of one row per coefficient, and a step is
    one join with the product sums. A level without training rows has coefficient 0.
    """
    rows = encoded.count()
    products, right = (keep(x) for x in product_sums(encoded, target))
    penalty = F.when((F.col("i") == F.col("j")) & (F.col("i") != 0), F.lit(alpha)).otherwise(0.0)
    system = keep(products.select("i", "j", (F.col("total") / rows + penalty).alias("a")))
    diagonal = system.filter("i = j").select("i", F.col("a").alias("d"))
    # x: solution, r: what is left, z: preconditioned, p: direction
    state = diagonal.join(right, "i").select("i", "d", F.lit(0.0).alias("x"), (F.col("total") / rows).alias("r"))
    state = keep(state.withColumn("p", F.col("r") / F.col("d")))
    size, first = state.agg(F.sum(F.col("r") * F.col("r") / F.col("d")), F.lit(0)).first()
    first = size
    for _ in range(rounds):
        if not size or size <= tolerance * tolerance * first:
            break
        direction = state.select(F.col("i").alias("j"), "p")
        moved = system.join(broadcast_if_small(direction, state), "j").groupBy("i").agg(F.sum(F.col("a") * F.col("p")).alias("q"))
        state = keep(state.join(broadcast_if_small(moved, state), "i"))
        step = size / state.agg(F.sum(F.col("p") * F.col("q"))).first()[0]
        state = keep(state.select("i", "d", "p", (F.col("x") + step * F.col("p")).alias("x"), (F.col("r") - step * F.col("q")).alias("r")))
        before, size = size, state.agg(F.sum(F.col("r") * F.col("r") / F.col("d"))).first()[0]
        state = state.withColumn("p", F.col("r") / F.col("d") + F.lit(size / before) * F.col("p"))
        state = keep(state)
    else:
        raise RuntimeError(f"no solution after {rounds} rounds")
    found = state.select(F.col("i").alias("idx"), F.col("x").alias("coefficient"))
    return levels.join(broadcast_if_small(found, found), "idx", "left").select("feature", "value", F.coalesce("coefficient", F.lit(0.0)).alias("coefficient"))


def predict(encoded: DataFrame, coefficients: DataFrame, levels: DataFrame, *keep: str) -> DataFrame:
    """``keep`` (which must tell rows apart) and ``predicted``: entries meet their coefficients and are added up per row."""
    weights = levels.join(coefficients, levels["feature"].eqNullSafe(coefficients["feature"]) & levels["value"].eqNullSafe(coefficients["value"]))
    weights = weights.select("idx", "coefficient")
    each = encoded.select(*keep, F.explode("entries").alias("e")).select(*keep, F.col("e.idx").alias("idx"), F.col("e.value").alias("v"))
    met = each.join(broadcast_if_small(weights, levels), "idx", "left")
    return met.groupBy(*keep).agg(F.sum(F.col("v") * F.coalesce("coefficient", F.lit(0.0))).alias("predicted"))
