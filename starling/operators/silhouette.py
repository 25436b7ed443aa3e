"""Silhouette values: squared distances in linear work, plain distances in exact blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _value(df: DataFrame) -> DataFrame:
    """``silhouette`` from ``size`` (own cluster), ``a`` (own mean) and ``b`` (nearest other mean)."""
    score = (F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0))
    # a row alone in its cluster scores 0, and so does one with a = b = 0
    return df.withColumn("silhouette", F.when(F.col("size") == 1, 0.0).otherwise(F.coalesce(score, F.lit(0.0))))


def cluster_totals(df: DataFrame, features: str, cluster: str) -> DataFrame:
    """Per cluster: rows, vector sum and sum of squared norms, summed inside tasks first."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["x"].to_numpy()).astype(float)
            for label in pdf["cluster"].unique():
                rows = x[(pdf["cluster"] == label).to_numpy()]
                sums = np.append(rows.sum(axis=0), (rows * rows).sum())
                yield pd.DataFrame(
                    {"cluster": label, "position": np.arange(len(sums)), "total": sums, "n": len(rows)}
                )

    slim = df.select(F.col(cluster).cast("int").alias("cluster"), F.col(features).cast("array<double>").alias("x"))
    parts = slim.mapInPandas(partial, "cluster int, position int, total double, n long")
    return parts.groupBy("cluster", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def squared_means(
    x: np.ndarray, own: np.ndarray, sums: np.ndarray, norms: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Mean squared distance to the own cluster and to the nearest other one, from cluster totals."""
    distance = np.maximum((x * x).sum(axis=1)[:, None] * counts - 2 * x @ sums.T + norms, 0.0)
    at = np.arange(len(x))
    a = distance[at, own] / np.maximum(counts[own] - 1, 1)
    mean = distance / np.where(counts > 0, counts, np.nan)
    mean[at, own] = np.inf
    return a, np.nanmin(mean, axis=1)


def silhouette_squared(df: DataFrame, row_id: str, features: str, cluster: str) -> DataFrame:
    """Silhouette per row on squared distances, from cluster totals (clusters x dimensions numbers)."""
    totals: dict[int, np.ndarray] = {}
    sizes: dict[int, int] = {}
    for row in cluster_totals(df, features, cluster).orderBy("cluster", "position").collect():
        totals[row["cluster"]] = np.append(totals.get(row["cluster"], np.array([])), row["total"])
        sizes[row["cluster"]] = row["n"]
    labels = sorted(totals)
    sums = np.stack([totals[c][:-1] for c in labels])
    norms = np.array([totals[c][-1] for c in labels])
    counts = np.array([sizes[c] for c in labels], dtype=float)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["x"].to_numpy()).astype(float)
            own = np.searchsorted(labels, pdf["cluster"].to_numpy())
            a, b = squared_means(x, own, sums, norms, counts)
            yield pd.DataFrame(
                {"id": pdf["id"], "cluster": pdf["cluster"], "size": counts[own].astype("int64"), "a": a, "b": b}
            )

    slim = df.select(
        F.col(row_id).alias("id"), F.col(cluster).cast("int").alias("cluster"),
        F.col(features).cast("array<double>").alias("x"),
    )
    scored = slim.mapInPandas(score, "id long, cluster int, size long, a double, b double")
    return _value(scored).select("id", "cluster", "silhouette")


# points on either side of the distances held at once: they stay in the cache of a core
_TILE = 256
# numbers of a block's vectors, and clusters of a block: they bound a task's memory
_BLOCK_NUMBERS, _BLOCK_CLUSTERS = 2**21, 128
# blocks of fewer rows are not worth a task; groups of clusters that are laid out one after the other; tasks at most
_FEW_ROWS, _GROUPS, _TASKS = 1024, 1024, 4096


def _tiles(points: np.ndarray, starts: np.ndarray) -> list[tuple[slice, np.ndarray, slice, np.ndarray]]:
    """Per tile its rows, their points, the clusters they are of, and where among them each of these begins."""
    out = []
    for low in range(0, len(points), _TILE):
        high = min(low + _TILE, len(points))
        first, last = np.searchsorted(starts, low, "right") - 1, np.searchsorted(starts, high, "left")
        out.append((slice(low, high), points[low:high], slice(first, last), np.maximum(starts[first:last] - low, 0)))
    return out


def distance_sums(x: np.ndarray, y: np.ndarray, x_starts: np.ndarray, y_starts: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the distances of each x to the y of every cluster, and of each y to the x of every cluster.

    Points are sorted by cluster, ``x_starts`` and ``y_starts`` tell where each begins. One product gives a tile of
    distances; points are moved next to zero first, where squares lose least. ``same``: both are one block, whose
    pairs meet once too.
    """
    middle = x.mean(axis=0)
    x, y = x - middle, y - middle
    # (-2x, x², 1) times (y, 1, y²) is the squared distance
    left = np.column_stack([-2 * x, (x * x).sum(axis=1), np.ones(len(x))])
    right = np.column_stack([y, np.ones(len(y)), (y * y).sum(axis=1)])
    to_y, to_x = np.zeros((len(x), len(y_starts))), np.zeros((len(x_starts), len(y)))
    held, ones = np.empty((_TILE, _TILE)), np.ones(_TILE)
    across = _tiles(right, y_starts)
    for i, (rows, part, own, begins) in enumerate(_tiles(left, x_starts)):
        ends = [*begins[1:], len(part)]
        for columns, points, others, starts in across[i:] if same else across:
            distance = np.matmul(part, points.T, out=held[: len(part), : len(points)])
            np.sqrt(np.maximum(distance, 0.0, out=distance), out=distance)
            diagonal = same and rows == columns
            if diagonal:
                np.fill_diagonal(distance, 0.0)
            to_y[rows, others] += np.add.reduceat(distance, starts, axis=1)
            if not diagonal:
                for cluster, low, high in zip(range(own.start, own.stop), begins, ends):
                    to_x[cluster, columns] += ones[: high - low] @ distance[low:high]
    return (to_y + to_x.T,) * 2 if same else (to_y, to_x.T)


class _Block:
    """Rows of a block by cluster; those without a vector or a cluster are counted and have no distances."""

    def __init__(self, rows: pa.Table):
        coded = rows["cluster"].combine_chunks().dictionary_encode("encode")
        codes, vectors = coded.indices.to_numpy(), rows["x"].combine_chunks()
        self.rows, self.labels = rows.select(["id", "cluster"]), coded.dictionary
        self.counts = np.bincount(codes, minlength=len(self.labels))
        known = np.flatnonzero(pc.and_(vectors.is_valid(), rows["cluster"].combine_chunks().is_valid()))
        self.known = known[np.argsort(codes[known], kind="stable")]
        self.present, self.starts = np.unique(codes[self.known], return_index=True)
        vectors = vectors.take(pa.array(self.known))
        if len(pc.unique(pc.list_value_length(vectors))) > 1:
            raise ValueError("vectors differ in length")
        self.x = vectors.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(self.known), -1 if len(self.known) else 0)

    def sums(self, totals: np.ndarray, other: _Block) -> pa.Table:
        """A row per row and cluster of the other block; ``totals`` are those of known rows and present clusters."""
        shape = self.rows.num_rows, len(other.labels)
        spots = np.ix_(self.known, other.present)
        every, none = np.zeros(shape), np.ones(shape, dtype=bool)
        every[spots], none[spots] = totals, False
        rows = self.rows.take(pa.array(np.repeat(np.arange(shape[0]), shape[1])))
        return pa.table({
            "id": rows["id"], "cluster": rows["cluster"],
            "other_cluster": other.labels.take(pa.array(np.tile(np.arange(shape[1]), shape[0]))),
            "total": pa.array(every.ravel(), mask=none.ravel()), "n": np.tile(other.counts, shape[0]),
        })


def _meet(key: tuple, rows: pa.Table) -> pa.Table:
    """Distance sums of two blocks that meet, in both directions, or of one that meets itself."""
    pair = key[1].as_py()
    second = (math.isqrt(8 * pair + 1) - 1) // 2
    first = pair - second * (second + 1) // 2
    home = rows["home"].to_numpy()
    a, b = (_Block(rows.filter(pa.array(home == block))) for block in ((first, first) if first == second else (first, second)))
    if len(a.known) and len(b.known):
        to_b, to_a = distance_sums(a.x, b.x, a.starts, b.starts, first == second)
    else:
        to_b, to_a = np.zeros((len(a.known), len(b.present))), np.zeros((len(b.known), len(a.present)))
    return a.sums(to_b, b) if first == second else pa.concat_tables([a.sums(to_b, b), b.sums(to_a, a)])


def _laid_out(slim: DataFrame, block_rows: int) -> tuple[Column, int]:
    """The block of a row, and the number of blocks: clusters lie one after the other and are cut into equal parts.

    So a block meets few clusters of another, and what it emits grows with blocks plus clusters, not with their
    product. A cluster takes some room of its own, or many small ones would share a block. The driver sees one row
    per group of clusters. Inside its group a row's place is a hash of its id.
    """
    group = F.pmod(F.xxhash64("cluster"), F.lit(_GROUPS)).cast("int")
    clusters = slim.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width"))
    found = clusters.groupBy(group.alias("group")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("clusters"), F.max("width").alias("width")).collect()
    rows, width = sum(r["n"] for r in found), max((r["width"] or 0 for r in found), default=0)
    most = max(1, min(block_rows, _BLOCK_NUMBERS // max(width, 1)))
    room = np.zeros(_GROUPS)
    for r in found:
        room[r["group"]] = r["n"] + r["clusters"] * most / _BLOCK_CLUSTERS
    cores = slim.sparkSession.sparkContext.defaultParallelism
    # fewer rows still make several pairs a core
    blocks = max(1, math.ceil(room.sum() / most), min(-(-rows // _FEW_ROWS), int((8 * cores) ** 0.5 + 1)))
    ends = np.cumsum(room)
    constant = lambda values: F.split(F.lit(",".join(map(repr, values.tolist()))), ",").cast("array<double>")
    share = F.shiftrightunsigned(F.xxhash64("id"), 11) * F.lit(2.0**-53)
    place = F.get(constant(ends - room), group) + share * F.get(constant(room), group)
    return F.least(F.floor(place * F.lit(blocks / max(ends[-1], 1.0))), F.lit(blocks - 1)).cast("int"), blocks


def silhouette_exact(df: DataFrame, row_id: str, features: str, cluster: str, block_rows: int = 32768) -> DataFrame:
    """Silhouette per row on plain distances, exact.

    Every row must meet every other, so the work is quadratic. Rows are laid
    out over blocks by cluster and id; each pair of blocks meets once, in a task
    of its own that emits distance sums per row and cluster in both directions,
    never pairs. No cluster is gathered anywhere, whatever its share of the rows.
    """
    kind = df.select(features).schema[0].dataType
    exact = "array<float>" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "array<double>"
    slim = df.select(
        F.col(row_id).cast("long").alias("id"), F.col(cluster).cast("int").alias("cluster"),
        F.col(features).cast(exact).alias("x"),  # floats become doubles in the tasks
    )
    home, blocks = _laid_out(slim, block_rows)
    pairs = blocks * (blocks + 1) // 2
    copies = slim.withColumn("home", home).withColumn("partner", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    second = F.greatest("home", "partner").cast("long")
    dealt = copies.withColumn("pair", F.shiftright(second * (second + 1), 1) + F.least("home", "partner")).drop("partner")
    tasks = min(pairs, _TASKS)
    sums = (
        dealt.withColumn("task", F.pmod("pair", F.lit(tasks)).cast("int")).repartitionById(tasks, "task")
        .groupBy("task", "pair").applyInArrow(_meet, "id long, cluster int, other_cluster int, total double, n long")
        .groupBy("id", "cluster", "other_cluster")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    own = F.col("cluster") == F.col("other_cluster")
    # the distance to oneself is 0, so only the divisor leaves it out
    per_row = sums.groupBy("id", "cluster").agg(
        F.max(F.when(own, F.col("n"))).alias("size"),
        F.max(F.when(own, F.col("total") / F.greatest(F.col("n") - 1, F.lit(1)))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    return _value(per_row).select("id", "cluster", "silhouette")


def mean_silhouette(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg("silhouette").alias("silhouette"))
