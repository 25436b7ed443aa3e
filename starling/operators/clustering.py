"""k-means with restarts, elbow table and principal components.

Restarts, cluster counts and feature sets advance together: one pass over the
rows assigns and sums for every run still moving, so fifty restarts read the
data as often as one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starling.functions.columns import named, numbered
from starling.operators.features import matrix
from starling.operators.silhouette import cluster_totals, squared_means


@dataclass(frozen=True)
class KMeansConfig:
    name: str
    features: tuple[str, ...]
    k: int
    n_init: int = 10
    seed: int = 42


@dataclass
class Clustering:
    """Centres over the run's own columns, and the sum of squared distances to them."""

    columns: list[str]
    centres: np.ndarray
    inertia: float


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distance = (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)
    label = distance.argmin(axis=1)
    return label, np.maximum(distance[np.arange(len(x)), label], 0.0)


def _spread_start(x: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Starting centres among weighted points, each drawn by its squared distance to those before it."""
    chosen = [int(rng.choice(len(x), p=weight / weight.sum()))]
    distance = ((x - x[chosen[0]]) ** 2).sum(axis=1) * weight
    while len(chosen) < k:
        total = distance.sum()
        pick = int(rng.choice(len(x), p=distance / total)) if total > 0 else int(rng.integers(len(x)))
        chosen.append(pick)
        distance = np.minimum(distance, ((x - x[pick]) ** 2).sum(axis=1) * weight)
    return x[chosen].copy()


def starting_points(
    df: DataFrame, row_id: str, columns: Sequence[str], wanted: dict[tuple, int], rounds: int = 5
) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
    """Candidates for first centres out of all rows, and the number of rows nearest to each.

    ``wanted`` maps (column numbers, seed) to the rows drawn per round. The first round draws
    evenly, every later one by the squared distance to the candidates so far, so that a
    small cluster far off is found among however many rows. A draw keeps the rows with the
    least ``-log(u) / distance``, ``u`` being a hash of row id, seed and round: one pass per
    round for all sets, and the same rows whichever task sees them.
    """
    sets = list(wanted)
    found: dict[tuple, np.ndarray] = {s: np.zeros((0, len(s[0]))) for s in sets}
    seeds = sorted({seed for _, seed in sets})
    plain = numbered(columns)
    for turn in range(rounds):
        hashed = df.select(*plain, *[F.xxhash64(F.col(row_id), F.lit(seed), F.lit(turn)).alias(f"h{seed}") for seed in seeds])

        def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best = [(np.zeros(0), np.zeros((0, len(picks)))) for picks, _ in sets]
            for pdf in batches:
                values = matrix(pdf.iloc[:, : len(columns)])
                for i, (picks, seed) in enumerate(sets):
                    x = values[:, list(picks)]
                    distance = _nearest(x, found[sets[i]])[1] if len(found[sets[i]]) else np.ones(len(x))
                    u = ((pdf[f"h{seed}"].to_numpy().view(np.uint64) >> np.uint64(11)) + 0.5) * 2.0**-53
                    apart = distance > 0
                    order = np.concatenate([best[i][0], -np.log(u[apart]) / distance[apart]])
                    rows = np.concatenate([best[i][1], x[apart]])
                    least = np.argsort(order, kind="stable")[: wanted[sets[i]]]
                    best[i] = order[least], rows[least]
            for i, (order, rows) in enumerate(best):
                if len(order):
                    yield pd.DataFrame({"of": i, "place": order, "x": list(rows)})

        drawn = hashed.mapInPandas(draw, "of int, place double, x array<double>")
        rank = F.row_number().over(Window.partitionBy("of").orderBy("place", "x"))
        kept = drawn.withColumn("rank", rank).filter(F.col("rank") <= max(wanted.values())).orderBy("of", "rank").collect()
        for i, s in enumerate(sets):
            fresh = [r["x"] for r in kept if r["of"] == i and r["rank"] <= wanted[s]]
            if fresh:
                found[s] = np.concatenate([found[s], np.array(fresh)])
    sums = _assign_sums(df.select(*plain), {s: (list(s[0]), found[s]) for s in sets if len(found[s])})
    return {s: (found[s], sums[s][0]) for s in sums}


def fit_kmeans(
    df: DataFrame, row_id: str, columns_of: dict[str, list[str]], configs: Sequence[KMeansConfig],
    max_iter: int = 300, tol: float = 1e-4,
) -> dict[str, Clustering]:
    """Best of ``n_init`` restarts per config, all rows of ``df`` taking part in every step.

    ``df`` is read once per step; cache it when it is costly to compute.
    """
    columns = sorted({c for used in columns_of.values() for c in used})
    where = {c: i for i, c in enumerate(columns)}
    wanted: dict[tuple, int] = {}
    for c in configs:
        drawn_for = tuple(where[x] for x in columns_of[c.name]), c.seed
        wanted[drawn_for] = max(wanted.get(drawn_for, 0), 2 * c.k)
    starts = starting_points(df, row_id, columns, wanted)
    # the stop tolerance follows the variance of all rows
    variances = df.select(*numbered(columns)).agg(*[F.var_pop(f"x{i}") for i in range(len(columns))]).first()
    spread = max(1e-12, float(np.mean([v or 0.0 for v in variances])))
    # a run is (columns, k, seed, restart); configs that differ only in n_init share runs
    runs_of = {
        c.name: [(tuple(where[x] for x in columns_of[c.name]), c.k, c.seed, r) for r in range(c.n_init)]
        for c in configs
    }
    centres: dict[tuple, np.ndarray] = {}
    for run in {run for runs in runs_of.values() for run in runs}:
        picks, k, seed, restart = run
        points, weight = starts.get((picks, seed), (np.zeros((0, len(picks))), np.zeros(0)))
        if weight.sum() < k:
            raise ValueError(f"{weight.sum():.0f} rows cannot form {k} clusters")
        centres[run] = _spread_start(points, weight, k, np.random.default_rng([seed, restart, k]))
    slim = df.select(*numbered(columns))
    inertia: dict[tuple, float] = {}
    moving = set(centres)
    for step in range(max_iter + 1):
        if not moving:
            break
        sums = _assign_sums(slim, {run: (list(run[0]), centres[run]) for run in sorted(moving)})
        for run, (counts, totals, cost) in sums.items():
            inertia[run] = cost
            old = centres[run]
            new = np.where((counts > 0)[:, None], totals / np.maximum(counts, 1)[:, None], old)
            if step == max_iter or ((new - old) ** 2).sum() <= tol * spread:
                moving.discard(run)  # inertia belongs to the centres kept
            else:
                centres[run] = new
    out: dict[str, Clustering] = {}
    for config in configs:
        best = min(runs_of[config.name], key=lambda run: (inertia[run], run[3]))
        out[config.name] = Clustering(columns_of[config.name], centres[best], inertia[best])
    return out


CHUNK = 1024  # rows whose distances to all centres are held at once


def _add_chunk(total: np.ndarray, x: np.ndarray, centres: np.ndarray, spans: Sequence[tuple[int, int]]) -> None:
    """Add rows to ``total``: per centre, the number, coordinate sums, cost and squared norms of the rows nearest to it.

    ``centres`` holds those of many runs, ``spans`` where each run's begin and end; a row counts once per run.
    """
    norms = (x * x).sum(axis=1)
    distance = centres @ x.T
    distance *= -2.0
    distance += norms
    distance += (centres * centres).sum(axis=1)[:, None]
    member = np.empty_like(distance)
    for low, high in spans:
        nearest, label = distance[low].copy(), np.zeros(len(x), dtype=np.int64)
        for k in range(low + 1, high):
            closer = distance[k] < nearest
            label[closer] = k - low
            np.minimum(nearest, distance[k], out=nearest)
        for k in range(low, high):
            member[k] = label == k - low
        total[low:high, -2] += np.bincount(label, np.maximum(nearest, 0.0), high - low)
    sums = member @ np.column_stack([np.ones(len(x)), x, norms])
    total[:, :-2] += sums[:, :-1]
    total[:, -1] += sums[:, -1]


def _assign_sums(slim: DataFrame, runs: dict, with_norms: bool = False) -> dict:
    """Per run: rows per cluster, coordinate sums per cluster, cost (and sums of squared norms).

    Runs over the same columns share one product of rows and centres.
    """
    names = list(runs)
    alike: dict[tuple[int, ...], list[int]] = {}
    for i, name in enumerate(names):
        alike.setdefault(tuple(runs[name][0]), []).append(i)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups = []
        for used, members in alike.items():
            ends = np.cumsum([0, *(len(runs[names[i]][1]) for i in members)])
            total = np.zeros((ends[-1], len(used) + 3))
            groups.append((list(used), members, np.concatenate([runs[names[i]][1] for i in members]), list(zip(ends, ends[1:])), total))
        seen = False
        for pdf in batches:
            values = matrix(pdf)
            seen = seen or len(values) > 0
            for at in range(0, len(values), CHUNK):
                for used, _, centres, spans, total in groups:
                    _add_chunk(total, np.ascontiguousarray(values[at : at + CHUNK, used]), centres, spans)
        if groups and seen:
            frame = lambda i, t: pd.DataFrame({"run": i, "cell": np.arange(t.size), "total": t.ravel()})
            yield pd.concat([frame(i, total[low:high]) for _, members, _, spans, total in groups for i, (low, high) in zip(members, spans)])

    cells = slim.mapInPandas(partial, "run int, cell int, total double")
    table = cells.groupBy("run", "cell").agg(F.sum("total").alias("total")).toArrow().to_pandas()
    out = {}
    for i, part in table.groupby("run"):
        used, centre = runs[names[i]]
        flat = np.zeros(len(centre) * (len(used) + 3))
        flat[part["cell"].to_numpy()] = part["total"].to_numpy()
        grid = flat.reshape(len(centre), len(used) + 3)
        found = (grid[:, 0], grid[:, 1:-2], float(grid[:, -2].sum()))
        out[names[i]] = (*found, grid[:, -1]) if with_norms else found
    return out


def mean_silhouettes(df: DataFrame, models: dict[str, Clustering]) -> dict[str, float]:
    """Mean squared-distance silhouette of many clusterings, in two passes for all of them."""
    columns = sorted({c for m in models.values() for c in m.columns})
    where = {c: i for i, c in enumerate(columns)}
    slim = df.select(*numbered(columns))
    runs = {name: ([where[c] for c in m.columns], m.centres) for name, m in models.items()}
    totals = {}
    for name, (counts, sums, _, norms) in _assign_sums(slim, runs, with_norms=True).items():
        totals[name] = (sums, norms, counts)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = matrix(pdf)
            for name, (used, centre) in runs.items():
                x = values[:, used]
                own = _nearest(x, centre)[0]
                sums, norms, counts = totals[name]
                a, b = squared_means(x, own, sums, norms, counts)
                top = np.maximum(a, b)
                score = np.where((counts[own] == 1) | (top == 0), 0.0, (b - a) / np.where(top == 0, 1.0, top))
                yield pd.DataFrame({"run": [name], "total": [score.sum()], "n": [len(x)]})

    parts = slim.mapInPandas(partial, "run string, total double, n long")
    rows = parts.groupBy("run").agg((F.sum("total") / F.sum("n")).alias("score")).collect()
    return {r["run"]: r["score"] for r in rows}


def assign(df: DataFrame, row_id: str, model: Clustering, keep: Sequence[str] = ()) -> DataFrame:
    """Row id, ``cluster`` and ``features`` (the model's columns as one array)."""
    width = len(model.columns)
    centres = model.centres

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.stack(pdf["features"].to_numpy()) if len(pdf) else np.zeros((0, width))
            yield pdf.assign(cluster=_nearest(x, centres)[0].astype("int32"))

    features = F.array(*numbered(model.columns)).alias("features")
    slim = df.select(F.col(row_id), *keep, features)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields)
    return slim.mapInPandas(label, f"{fields}, cluster int")


def nearest_mean(df: DataFrame, row_id: str, features: str, cluster: str) -> DataFrame:
    """One reassignment: each row's cluster and the cluster whose mean is nearest to it."""
    rows = cluster_totals(df, features, cluster).orderBy("cluster", "position").collect()
    labels = sorted({r["cluster"] for r in rows})
    # the last position holds the squared norms
    sums = np.array([[r["total"] / r["n"] for r in rows if r["cluster"] == c][:-1] for c in labels])
    columns = [f"v{i}" for i in range(sums.shape[1])]
    wide = df.select(row_id, cluster, *[F.col(features)[i].alias(c) for i, c in enumerate(columns)])
    kept = wide.withColumnRenamed(cluster, "_own")
    placed = assign(kept, row_id, Clustering(columns, sums, float("nan")), keep=["_own"])
    named_label = F.element_at(F.array(*[F.lit(c) for c in labels]), F.col("cluster") + 1)
    return placed.select(row_id, F.col("_own").alias(cluster), named_label.alias("nearest"))


def covariances(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Means and population covariances in one pass.

    Tasks keep counts, means and centred co-moments, which are merged; raw products, which
    cancel where a mean is far larger than a deviation, are never formed.
    """
    width, names = len(columns), ("n", "mean", "moment")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            if batch.num_rows:
                own = _moments(batch)
                found = own if found is None else _merged(found, own)
        if found is not None:
            yield pa.RecordBatch.from_arrays([pa.array([m.ravel()], pa.list_(pa.float64())) for m in found], names=names)

    parts = df.select(*numbered(columns)).mapInArrow(partial, ", ".join(f"{n} array<double>" for n in names)).collect()
    if not parts:
        return np.full(width, np.nan), np.full((width, width), np.nan)
    n, mean, moment = reduce(_merged, [tuple(np.array(m).reshape(width, width) for m in part) for part in parts])
    some = np.maximum(n, 1)
    return np.where(n > 0, mean, np.nan).diagonal().copy(), np.where(n > 0, moment / some, np.nan)


Moments = tuple[np.ndarray, np.ndarray, np.ndarray]


def _moments(batch: pa.RecordBatch) -> Moments:
    """Of the rows that have both columns of a pair: their number, the first column's mean, and the centred co-moment."""
    given = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
    x = np.where(given, np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]), 0.0)
    valid = given.astype(float)
    n = valid.T @ valid
    some = np.maximum(n, 1)
    centre = x.sum(axis=0) / some.diagonal()
    apart = np.where(given, x - centre, 0.0)
    beside = apart.T @ valid
    return n, centre[:, None] + beside / some, apart.T @ apart - beside * beside.T / some


def _merged(a: Moments, b: Moments) -> Moments:
    (n, mean, moment), (m, other, more) = a, b
    total = np.maximum(n + m, 1)
    gap = np.where((n > 0) & (m > 0), other - mean, 0.0)
    return n + m, np.where(n > 0, mean, other) + gap * m / total, moment + more + gap * gap.T * n * m / total


def loadings(covariance: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` components as columns. A component's sign is arbitrary: its largest loading, the first of equals, is made positive."""
    values, axes = np.linalg.eigh(covariance)
    axes = axes[:, np.argsort(-values, kind="stable")[:k]]
    return axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])


def principal_components(df: DataFrame, row_id: str, columns: Sequence[str], k: int = 2) -> DataFrame:
    """Coordinates ``pc1, pc2, ...`` of the centred columns on their first components."""
    means, covariance = covariances(df, columns)
    if np.isnan(covariance).any():  # no rows
        return df.limit(0).select(row_id, *[F.lit(None).cast("double").alias(f"pc{i + 1}") for i in range(k)])
    axes = loadings(covariance, k)
    place = lambda n: sum(((named(c).cast("double") - float(m)) * float(a) for c, m, a in zip(columns, means, axes[:, n])), F.lit(0.0))
    return df.select(row_id, *[place(n).alias(f"pc{n + 1}") for n in range(axes.shape[1])])


def lloyd(df: DataFrame, columns: Sequence[str], centres: np.ndarray, steps: int) -> Iterator[Clustering]:
    """The state before each of ``steps`` Lloyd steps from given centres, its inertia that of the rows at their nearest centre.

    A centre without rows stays where it is.
    """
    for _ in range(steps):
        sums, counts, inertia = _step(df, columns, centres)
        yield Clustering(list(columns), centres, inertia)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)


def _step(df: DataFrame, columns: Sequence[str], centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sums and counts of the rows nearest to each centre, and the sum of their squared distances; one pass."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(centres), len(columns) + 2))
        for pdf in batches:
            x = matrix(pdf)
            if len(x):
                nearest, distance = _nearest(x, centres)
                np.add.at(total, nearest, np.column_stack([x, np.ones(len(x)), distance]))
        yield pd.DataFrame({"k": np.repeat(np.arange(len(centres)), total.shape[1]), "p": np.tile(np.arange(total.shape[1]), len(centres)), "v": total.ravel()})

    parts = df.select(*numbered(columns)).mapInPandas(partial, "k int, p int, v double").groupBy("k", "p").agg(F.sum("v").alias("v"))
    total = np.zeros((len(centres), len(columns) + 2))
    for row in parts.collect():
        total[row["k"], row["p"]] = row["v"]
    return total[:, :-2], total[:, -2], float(total[:, -1].sum())
