"""Linear regression: the penalised optimum, and learning-rate schedules on the Gram matrix.

One distributed pass reduces the training rows to X'X, X'y and y'y. Those small
matrices serve every experiment that uses a subset of the columns: a gradient
epoch then costs nothing on the cluster. The path averages over all rows, so it
differs from row-by-row steps; the optimum is the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import numbered
from starling.operators.features import matrix
from starling.operators.tree import assemble


@dataclass(frozen=True)
class Gram:
    """Sums over rows of products of (1, features..., target)."""

    names: tuple[str, ...]
    products: np.ndarray

    @property
    def rows(self) -> float:
        return float(self.products[0, 0])

    def system(self, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray, float]:
        """Mean products (X'X, X'y, y'y) of an intercept and the given columns."""
        at = [0, *[self.names.index(c) + 1 for c in columns]]
        mean = self.products / self.rows
        return mean[np.ix_(at, at)], mean[at, -1], float(mean[-1, -1])


def gram(df: DataFrame, columns: Sequence[str], target: str) -> Gram:
    """Sum the products block by block inside the tasks, then across them."""
    width = len(columns) + 2

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for pdf in batches:
            x = np.column_stack([np.ones(len(pdf)), matrix(pdf)])
            total += x.T @ x
        i, j = np.indices((width, width))
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "total": total.ravel()})

    slim = df.select(*numbered(columns), F.col(target).cast("double").alias("y"))
    cells = slim.mapInPandas(partial, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("t"))
    products = np.zeros((width, width))
    for row in cells.collect():
        products[row["i"], row["j"]] = row["t"]
    return Gram(tuple(columns), products)


@dataclass(frozen=True)
class SgdConfig:
    name: str
    features: tuple[str, ...]
    max_iter: int
    eta0: float
    learning_rate: str
    alpha: float = 0.0001
    penalty: str = "l2"
    l1_ratio: float = 0.15
    tol: float = 1e-3


def l1_share(config: SgdConfig) -> float:
    return {"l2": 0.0, "l1": 1.0, "elasticnet": config.l1_ratio}[config.penalty]


# fixed values: exponent of the decaying schedule, patience, divisor and floor of the adaptive one
_POWER, _PATIENCE, _DIVISOR, _FLOOR = 0.25, 5, 5.0, 1e-6
# gradient steps per epoch: an epoch visits every row, here in that many averaged steps
_STEPS = 100


def descend(g: Gram, columns: Sequence[str], config: SgdConfig) -> np.ndarray:
    """Coefficients (intercept first) after at most ``max_iter`` epochs of the given schedule.

    The intercept carries no penalty. An epoch is ``_STEPS`` steps of size eta, each along
    the mean gradient of all rows, so the path does not depend on the number of rows. The
    tolerance is a share of the loss, whatever the target's unit. A step too long for the
    matrix is an error.
    """
    xx, xy, yy = g.system(columns)
    r = l1_share(config)
    ridge = np.full(len(xy), config.alpha * (1 - r))
    lasso = np.full(len(xy), config.alpha * r)
    ridge[0] = lasso[0] = 0.0
    curve = xx + np.diag(ridge)
    values, axes = np.linalg.eigh(curve)
    if config.eta0 >= 2.0 / values.max():
        raise ValueError(f"eta0 {config.eta0} diverges: the largest curvature is {values.max():.3g}")
    # the smooth optimum along each axis; flat axes stay where they start
    flat = values <= 1e-12 * values.max()
    goal = axes @ (np.where(flat, 0.0, axes.T @ xy) / np.where(flat, 1.0, values))

    def epoch_of_steps(w: np.ndarray, size: float) -> np.ndarray:
        if not lasso.any():  # all steps at once: each axis shrinks towards its optimum
            return goal + axes @ ((1 - size * values) ** _STEPS * (axes.T @ (w - goal)))
        for _ in range(_STEPS):
            w = w - size * (curve @ w - xy)
            w = np.sign(w) * np.maximum(np.abs(w) - size * lasso, 0.0)
        return w

    def loss(w: np.ndarray) -> float:
        fit = 0.5 * (yy - 2 * w @ xy + w @ xx @ w)
        return float(fit + 0.5 * ridge @ (w * w) + lasso @ np.abs(w))

    w = np.zeros(len(xy))
    eta, best, stale = config.eta0, np.inf, 0
    for epoch in range(config.max_iter):
        if config.learning_rate == "invscaling":
            eta = config.eta0 / (1 + epoch * _STEPS) ** _POWER
        w = epoch_of_steps(w, eta)
        now = loss(w)
        stale = stale + 1 if epoch and now >= best * (1 - config.tol) else 0
        best = min(best, now)
        if stale >= _PATIENCE:
            if config.learning_rate != "adaptive" or eta <= _FLOOR:
                break
            eta, stale = eta / _DIVISOR, 0
    return w


# ten or so single steps, for a look at the path: name, first step length, and how it changes
SCHEDULES = (("constant", 0.3), ("invscaling", 0.3), ("adaptive", 0.9))
_LOOK_PATIENCE = 2


def descent_steps(sums: DataFrame, steps: int, alpha: float = 0.0001, tol: float = 1e-3) -> DataFrame:
    """``schedule, step, eta, w0, w1, loss`` of single gradient steps on one feature, from zero, for each of ``SCHEDULES``.

    ``sums`` holds the mean products ``mx, mxx, my, mxy, myy`` of all rows in one written row. A recursive query
    carries the state: the decaying length is eta0 / (1 + step) ** 0.25, the adaptive one is divided by five after
    two steps in a row that better the loss by less than its share ``tol``.
    """
    given = ", ".join(f"('{name}', {eta}D)" for name, eta in SCHEDULES)
    return sums.sparkSession.sql(f"""
        WITH RECURSIVE path(schedule, eta0, step, eta, w0, w1, loss, best, stale) AS (
          SELECT schedule, eta0, 0, eta0, 0D, 0D, myy / 2, myy / 2, 0 FROM VALUES {given} AS g(schedule, eta0) CROSS JOIN {{sums}}
          UNION ALL
          SELECT schedule, eta0, step + 1, CASE WHEN schedule = 'adaptive' AND stale + flat >= {_LOOK_PATIENCE} AND flat = 1 THEN used / {_DIVISOR}D ELSE used END,
            n0, n1, after, least(best, after), CASE WHEN flat = 0 OR stale + flat >= {_LOOK_PATIENCE} THEN 0 ELSE stale + flat END
          FROM (
            SELECT *, CASE WHEN after >= best * (1 - {tol}D) THEN 1 ELSE 0 END AS flat FROM (
              SELECT *, (myy - 2 * (n0 * my + n1 * mxy) + n0 * n0 + 2 * n0 * n1 * mx + n1 * n1 * mxx) / 2 + {alpha}D * n1 * n1 / 2 AS after FROM (
                SELECT *, w0 - used * (w0 + w1 * mx - my) AS n0, w1 - used * (w0 * mx + w1 * (mxx + {alpha}D) - mxy) AS n1 FROM (
                  SELECT *, CASE WHEN schedule = 'invscaling' THEN eta0 / power(1 + step, {_POWER}D) ELSE eta END AS used
                  FROM path CROSS JOIN {{sums}} WHERE step < {steps}))))
        )
        SELECT schedule, step, eta, w0, w1, loss FROM path""", sums=sums)


def fit_optimum(df: DataFrame, columns: Sequence[str], target: str, alpha: float, share: float) -> LinearRegressionModel:
    """The penalised least squares optimum by Spark ML, ``share`` being the L1 part of ``alpha``.

    The normal-equation solver divides the ridge part by the population deviation
    of the target, so the strength is scaled back to mean ``alpha`` on the raw
    target. Features come scaled.
    """
    sigma = df.agg(F.stddev_pop(target)).first()[0]
    strength = alpha * share + alpha * (1 - share) * sigma
    data = assemble(df, columns, F.col(target).alias("label"))
    return LinearRegression(
        regParam=strength,
        elasticNetParam=alpha * share / strength if strength else 0.0,
        standardization=False,
        solver="normal",
        maxIter=500,
        tol=1e-10,
    ).fit(data)


def score_many(
    df: DataFrame, columns: Sequence[str], target: str, weights: Mapping[str, np.ndarray]
) -> DataFrame:
    """MAE, MSE, RMSE and R2 of many coefficient vectors in one pass over the test rows.

    ``weights`` maps a run name to intercept and coefficients over all ``columns``.
    """
    names = list(weights)
    coefficients = np.column_stack([weights[n] for n in names])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = matrix(pdf)
            x, y = np.column_stack([np.ones(len(pdf)), values[:, :-1]]), values[:, -1]
            error = x @ coefficients - y[:, None]
            mean = y.mean() if len(y) else 0.0
            yield pd.DataFrame({
                "run": names, "n": len(y), "absolute": np.abs(error).sum(axis=0), "square": (error**2).sum(axis=0),
                "y_sum": y.sum(), "y_spread": ((y - mean) ** 2).sum(),
            })

    schema = "run string, n long, absolute double, square double, y_sum double, y_spread double"
    slim = df.select(*numbered(columns), F.col(target).cast("double").alias("y"))
    parts = slim.mapInPandas(partial, schema).filter("n > 0")
    # total spread = spread inside the parts + spread of their means, without cancellation
    sums = parts.groupBy("run").agg(
        F.sum("n").alias("n"), F.sum("absolute").alias("absolute"), F.sum("square").alias("square"),
        F.sum("y_spread").alias("inside"),
        F.sum(F.col("y_sum")).alias("y_sum"),
        F.sum(F.col("y_sum") * F.col("y_sum") / F.col("n")).alias("means_square"),
    )
    spread = F.col("inside") + F.col("means_square") - F.col("y_sum") * F.col("y_sum") / F.col("n")
    return sums.select(
        "run",
        (F.col("absolute") / F.col("n")).alias("mae"),
        (F.col("square") / F.col("n")).alias("mse"),
        F.sqrt(F.col("square") / F.col("n")).alias("rmse"),
        (1 - F.col("square") / spread).alias("r2"),
    )
