"""Classification trees grown exactly, all runs together, level by level, as tables.

Every midpoint between neighbouring values is tried; nothing is binned away. Values are counted
per (run, node, feature) first. Their running sums are taken in two steps, inside slices of
a feature's value range and over the slices, so no task sees all values of a feature.
Nodes are rows of a table, named by their path (``""``, ``L``, ``LR``, ...), of any depth; rows of data meet them
by joins, in growing and in scoring.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.functions.columns import named
from starling.operators.tree import TreeConfig
from starling.session import broadcast_if_small

Keep = Callable[[DataFrame], DataFrame]
SLICES = 64  # of a feature's values in a node, about equally full
DIGITS = 10  # of a gain that decide: equal ones fall to the first feature, then the lowest threshold
MOST_CLASSES = 1000

NODES = "run string, node string, depth int, rows long, label string, impurity double, feature string, threshold double, gain double"


def classes(df: DataFrame, label: str) -> list[str]:
    found = [r[0] for r in df.select(F.col(label).cast("string")).filter(F.col(label).isNotNull()).distinct().limit(MOST_CLASSES + 1).collect()]
    if len(found) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} classes")
    return sorted(found)


def _impurity(counts: Sequence[Column], entropy: Column) -> Column:
    total = sum(counts[1:], counts[0])
    share = lambda c: c / total
    gini = F.lit(1.0) - sum((share(c) * share(c) for c in counts[1:]), share(counts[0]) * share(counts[0]))
    bits = lambda c: F.when(c > 0, -share(c) * F.log2(share(c))).otherwise(0.0)
    return F.when(total <= 0, 0.0).when(entropy, sum((bits(c) for c in counts[1:]), bits(counts[0]))).otherwise(gini)


def _best_splits(counts: DataFrame, known: int) -> DataFrame:
    """The best split per ``run, node`` from ``counts(run, node, f, value, n, c0...)`` with the run's settings."""
    place, sums = ["run", "node", "f"], ["n", *(f"c{k}" for k in range(known))]
    edges = counts.groupBy(*place).agg(F.percentile_approx("value", [i / SLICES for i in range(1, SLICES)], 1000).alias("edges"))
    cut = counts.join(edges, place).withColumn("slice", F.size(F.filter("edges", lambda e: e < F.col("value")))).drop("edges")
    slices = cut.groupBy(*place, "slice").agg(*[F.sum(c).alias(c) for c in sums], F.min("value").alias("lowest"))
    over = Window.partitionBy(*place).orderBy("slice")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        *place, "slice", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"before_{c}") for c in sums],
        *[F.sum(c).over(Window.partitionBy(*place)).alias(f"all_{c}") for c in sums], F.lead("lowest").over(over).alias("beyond"),
    )
    inside = Window.partitionBy(*place, "slice").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = cut.select(*place, "slice", "value", "entropy", "min_leaf", F.lead("value").over(inside).alias("next"), *[F.sum(c).over(upto).alias(c) for c in sums])
    each = each.join(slices, [*place, "slice"])
    left = lambda c: F.col(f"before_{c}") + F.col(c)
    right = lambda c: F.col(f"all_{c}") - left(c)
    each = each.withColumn("next", F.coalesce("next", "beyond")).filter(
        F.col("next").isNotNull() & (left("n") >= F.col("min_leaf")) & (right("n") >= F.col("min_leaf"))
    )
    cs = [f"c{k}" for k in range(known)]
    weight = lambda side: sum((side(c) for c in cs[1:]), side(cs[0]))
    whole = [F.col(f"all_{c}") for c in cs]
    total = sum(whole[1:], whole[0])
    after = (weight(left) * _impurity([left(c) for c in cs], F.col("entropy")) + weight(right) * _impurity([right(c) for c in cs], F.col("entropy"))) / total
    gain = F.round(_impurity(whole, F.col("entropy")) - after, DIGITS)
    middle = F.col("value") / 2 + F.col("next") / 2
    # two neighbours so close that their middle rounds up: the lower one itself
    middle = F.when(middle >= F.col("next"), F.col("value")).otherwise(middle)
    way = F.struct((-gain).alias("order"), "f", middle.alias("threshold"))
    best = each.groupBy("run", "node").agg(F.min(way).alias("best")).filter("best.order < 0")
    return best.select("run", "node", F.col("best.f").alias("f"), F.col("best.threshold").alias("threshold"), (-F.col("best.order")).alias("gain"))


def _counted(base: DataFrame, keep: Keep) -> DataFrame:
    """The rows with ``w``, how many rows each stands for: equal ones become one row where that halves their number."""
    columns = base.columns
    rows, kinds = base.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(*columns))).first()
    if 2 * kinds > rows:
        return base.withColumn("w", F.lit(1).cast("long"))
    return keep(base.groupBy(*columns).agg(F.count("*").alias("w")))


def grow(df: DataFrame, features: Sequence[str], label: str, runs: Sequence[TreeConfig], keep: Keep) -> DataFrame:
    """The nodes of one tree per run, as ``NODES``; ``feature`` is null at a leaf.

    A row goes left where its value is at most the threshold. Rows without label or with a missing feature of the
    run are an error of the caller's: prepare them first. Balanced class weights count a class by
    total / (classes * its rows), as everywhere here; ``rows``, and the least sizes, are plain counts.
    """
    spark = df.sparkSession
    known = classes(df, label)
    fixed = ["used", "entropy", "min_leaf", "min_split", "max_depth", "balanced"]
    setting = lambda r: F.struct(
        F.lit(r.name).alias("run"), F.array(*[F.lit(features.index(f)) for f in r.features]).alias("used"), F.lit(r.criterion == "entropy").alias("entropy"),
        F.lit(r.min_samples_leaf).alias("min_leaf"), F.lit(r.min_samples_split).alias("min_split"), F.lit(r.max_depth).cast("int").alias("max_depth"),
        F.lit(r.class_weight == "balanced").alias("balanced"),
    )
    if not known:
        return spark.createDataFrame([], NODES)
    number = F.col("label")
    sizes = df.groupBy(F.col(label).cast("string").alias("label")).count().collect()
    size = {r["label"]: r["count"] for r in sizes if r["label"] is not None}
    heavy = {v: sum(size.values()) / (len(known) * size[v]) for v in known}
    cells = F.array(*[named(f).cast("double") for f in features])
    base = df.filter(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), cells.alias("x"))
    # a copy per run of the stated list
    state = _counted(base, keep).withColumn("s", F.explode(F.array(*map(setting, runs)))).select("label", "x", "w", "s.*", F.lit("").alias("node"))
    nodes, depth = [], 0
    while True:
        state = keep(state)
        weight = lambda k: F.when(F.col("balanced"), F.lit(heavy[known[k]])).otherwise(F.lit(1.0))
        count = lambda k: F.sum(F.when(number == known[k], weight(k) * F.col("w")).otherwise(0.0)).alias(f"c{k}")
        held = state.groupBy("run", "node").agg(F.sum("w").alias("n"), *[F.first(c).alias(c) for c in fixed], *[count(k) for k in range(len(known))])
        counts_of = [F.col(f"c{k}") for k in range(len(known))]
        held = keep(held.withColumn("impurity", _impurity(counts_of, F.col("entropy"))))
        open_ = held.filter((F.col("impurity") > 0) & (F.col("n") >= F.col("min_split")) & (F.col("max_depth").isNull() | (F.col("max_depth") > depth)))
        open_ = keep(open_.select("run", "node"))
        each = state.join(broadcast_if_small(open_, open_), ["run", "node"])
        each = each.select("run", "node", "label", "w", "entropy", "min_leaf", "balanced", F.explode(F.transform("used", lambda i: F.struct(i.alias("f"), F.get("x", i).alias("value")))).alias("c"))
        counts = each.groupBy("run", "node", F.col("c.f").alias("f"), F.col("c.value").alias("value")).agg(
            F.sum("w").alias("n"), F.first("entropy").alias("entropy"), F.first("min_leaf").alias("min_leaf"), *[count(k) for k in range(len(known))])
        splits = keep(_best_splits(keep(counts), len(known)))
        # of equal classes the first; balanced weights make them equal but for rounding
        most = F.array_max(F.array(*[F.struct(F.round(f"c{k}", DIGITS - 1).alias("c"), F.lit(-k).alias("k"), F.lit(v).alias("v")) for k, v in enumerate(known)]))["v"]
        names = F.array(*[F.lit(f) for f in features])
        nodes.append(held.join(splits, ["run", "node"], "left").select(
            "run", "node", F.lit(depth).alias("depth"), F.col("n").alias("rows"), most.alias("label"), "impurity",
            F.get(names, F.col("f")).alias("feature"), "threshold", "gain",
        ))
        if splits.isEmpty():
            break
        moved = state.join(broadcast_if_small(splits.select("run", "node", "f", "threshold"), splits), ["run", "node"])
        side = F.when(F.get("x", F.col("f")) <= F.col("threshold"), "L").otherwise("R")
        state = moved.withColumn("node", F.concat("node", side)).drop("f", "threshold")
        depth += 1
    out = nodes[0]
    for part in nodes[1:]:
        out = out.unionByName(part)
    return keep(out)


def predict(df: DataFrame, row_id: str, nodes: DataFrame, keep: Keep, max_depth: int | None = None, min_split: int = 0) -> DataFrame:
    """``row_id, run, label``: each row goes down each tree, one join a level, to a leaf or to where the limits cut it.

    Growth is greedy, so a tree cut at a depth or at nodes of few rows is the one grown with these limits.
    """
    columns = [r[0] for r in nodes.select("feature").filter("feature IS NOT NULL").distinct().collect()]
    cells = F.array(*[F.struct(F.lit(c).alias("name"), named(c).cast("double").alias("value")) for c in columns]) if columns else F.expr("cast(array() as array<struct<name:string,value:double>>)")
    ends = F.col("feature").isNull() | (F.col("rows") < min_split)
    cut = nodes.withColumn("stop", ends | (F.col("depth") >= max_depth) if max_depth is not None else ends)
    runs = [r[0] for r in cut.select("run").distinct().collect()]
    if not runs:
        return df.select(F.col(row_id), F.lit("").alias("run"), F.lit("").alias("label")).limit(0)
    at = df.select(F.col(row_id), cells.alias("x"), F.explode(F.array(*map(F.lit, runs))).alias("run"), F.lit("").alias("node"))
    done, depth = [], 0
    while True:
        level = keep(cut.filter(F.col("depth") == depth).drop("depth"))
        if level.isEmpty():
            break
        here = keep(at.join(broadcast_if_small(level, level), ["run", "node"]))
        done.append(here.filter("stop").select(row_id, "run", "label"))
        value = F.get(F.filter("x", lambda c: c["name"] == F.col("feature")), F.lit(0))["value"]
        side = F.when(value <= F.col("threshold"), "L").otherwise("R")
        at = here.filter("NOT stop").withColumn("node", F.concat("node", side)).select(row_id, "x", "run", "node")
        depth += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return keep(out)
