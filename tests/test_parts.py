"""Sparse levels, stable covariances, stated starts, sheets with rejects, mixed logs, stored preprocessing."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators import clustering, features, growth, regression, silhouette, sparse
from starling.operators.regression import SgdConfig
from starling.operators.tree import TreeConfig
from starling.plans import experiments
from starling.session import measured_bytes, scratch
from starling.sources import files
from starling.sources.runlog import NOTEBOOK_COLUMNS, STAGING_COLUMNS, WAREHOUSE_COLUMNS, read_mixed_logs


def test_fifty_thousand_levels_fit(spark):
    """Closed form of one category with a free intercept; a third of all rows have one level."""
    rows = 150_000
    df = spark.range(rows).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 50_000)).alias("c"), ((F.col("id") * 7919) % 1000 / 10).alias("y"))
    alpha = 0.001
    with scratch(spark) as keep:
        levels = sparse.fit_levels(df, [], ["c"], keep)
        assert levels.count() > 33_000 and levels.agg(F.countDistinct("idx"), F.max("idx")).first() == (levels.count(), levels.count() - 1)
        encoded = keep(sparse.encode(df, [], ["c"], levels, "y"))
        found = {(r.feature, r.value): r.coefficient for r in sparse.ridge(encoded, "y", levels, alpha, keep).collect()}
    groups = df.groupBy("c").agg(F.count("*").alias("n"), F.avg("y").alias("y")).toPandas()
    strength = alpha * rows
    share = groups.n * strength / (groups.n + strength)
    intercept = (share * groups.y).sum() / share.sum()
    assert found["(intercept)", None] == pytest.approx(intercept, rel=1e-6)
    expected = groups.n * (groups.y - intercept) / (groups.n + strength)
    assert np.allclose([found["c", v] for v in groups.c], expected, atol=1e-6)


def test_sparse_ridge_equals_a_dense_solution(spark):
    draw = np.random.default_rng(2)
    rows = [(i, float(draw.normal()), draw.choice(["a", "b", "c", None]), draw.choice(["x", "y"]), float(draw.normal(5))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, n double, c string, `d.e` string, y double")
    with scratch(spark) as keep:
        levels = sparse.fit_levels(df, ["n"], ["c", "d.e"], keep)
        encoded = keep(sparse.encode(df, ["n"], ["c", "d.e"], levels, "id", "y"))
        coefficients = keep(sparse.ridge(encoded, "y", levels, 0.1, keep))
        found = {(r.feature, r.value): r.coefficient for r in coefficients.collect()}
        predicted = {r.id: r.predicted for r in sparse.predict(encoded, coefficients, levels, "id").collect()}
        unseen = sparse.encode(spark.createDataFrame([(1, 2.0, "zz", None)], "id long, n double, c string, `d.e` string"), ["n"], ["c", "d.e"], levels, "id").first()
    names = [("(intercept)", None), ("n", None), ("c", "a"), ("c", "b"), ("c", "c"), ("d.e", "x"), ("d.e", "y")]
    x = np.array([[1.0, n, c == "a", c == "b", c == "c", d == "x", d == "y"] for _, n, c, d, _ in rows], dtype=float)
    y = np.array([r[-1] for r in rows])
    w = np.linalg.solve(x.T @ x / len(y) + np.diag([0.0] + [0.1] * 6), x.T @ y / len(y))
    assert np.allclose([found[n] for n in names], w, atol=1e-7) and set(found) == set(names)
    assert np.allclose([predicted[i] for i in range(len(y))], x @ w, atol=1e-6)
    assert [(e.idx, e.value) for e in unseen.entries] == [(0, 1.0), (1, 2.0)]


def test_covariances_of_values_far_from_zero(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(20_000, 2)) @ np.array([[1.0, 0.6], [0.0, 0.8]]) + np.array([1e9, -3e8])
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, `b.c` double").repartition(7)
    means, found = clustering.covariances(df, ["a", "b.c"])
    centred = x - x.mean(axis=0)
    assert np.allclose(found, centred.T @ centred / len(x), rtol=1e-6) and np.allclose(means, x.mean(axis=0), rtol=1e-12)
    plane = clustering.principal_components(df, "id", ["a", "b.c"]).orderBy("id").toPandas()
    values = np.linalg.eigvalsh(centred.T @ centred / len(x))[::-1]
    assert np.allclose(plane[["pc1", "pc2"]].var(ddof=0), values, rtol=1e-6) and abs(plane.pc1.mean()) < 1e-6
    assert clustering.principal_components(df.filter("false"), "id", ["a", "b.c"]).count() == 0


def test_steps_from_stated_centres(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(500, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    centres = x[:4].copy()
    centres[3] = 99.0  # no row is nearest to it
    for state in clustering.lloyd(df, ["a", "b", "c"], centres.copy(), 4):
        far = ((x[:, None] - centres[None]) ** 2).sum(axis=2)
        assert np.allclose(state.centres, centres) and state.inertia == pytest.approx(far.min(axis=1).sum())
        near = far.argmin(axis=1)
        centres = np.array([x[near == k].mean(axis=0) if (near == k).any() else centres[k] for k in range(4)])


def test_recursive_steps_equal_a_plain_loop(spark):
    draw = np.random.default_rng(5)
    x, y = draw.uniform(size=300), draw.uniform(size=300) + 1
    sums = spark.createDataFrame([tuple(map(float, (x.mean(), (x * x).mean(), y.mean(), (x * y).mean(), (y * y).mean())))], "mx double, mxx double, my double, mxy double, myy double")
    got = {(r.schedule, r.step): (r.eta, r.w0, r.w1, r.loss) for r in regression.descent_steps(sums, 60).collect()}
    for name, eta0 in regression.SCHEDULES:
        w, eta, stale, best = np.zeros(2), eta0, 0, (y * y).mean() / 2
        for step in range(60):
            used = eta0 / (1 + step) ** 0.25 if name == "invscaling" else eta
            error = w[0] + w[1] * x - y
            w = w - used * np.array([error.mean(), (error * x).mean() + 0.0001 * w[1]])
            loss = ((w[0] + w[1] * x - y) ** 2).mean() / 2 + 0.0001 / 2 * w[1] ** 2
            stale = stale + 1 if loss >= best * 0.999 else 0
            best, eta = min(best, loss), used
            if stale >= 2:
                eta, stale = (used / 5 if name == "adaptive" else used), 0
            assert got[name, step + 1] == pytest.approx((eta, *w, loss))
    assert got["adaptive", 60][0] < 0.9


def test_one_diverging_run_leaves_the_others(spark, tables):
    grid = [SgdConfig("fine", ("quality", "area"), 50, 0.005, "constant"), SgdConfig("wild", ("quality", "area"), 50, 500.0, "constant")]
    rows = experiments.regression_grid(experiments.profile(tables), grid).collect()
    assert [r.experiment for r in rows] == ["fine", "wild"] and rows[0].status == "OK" and rows[0].rmse > 0
    assert "diverges" in rows[1].status and rows[1].rmse is None


def test_stored_preprocessing_scores_like_the_fitted_one(spark, tmp_path):
    rows = [(1, 1.0, "a", "x"), (2, None, None, "y"), (3, 5.0, "b", "x"), (4, 9.0, "a", None)]
    df = spark.createDataFrame(rows, "id long, n double, `c.d` string, e string")
    fitted = features.fit_preprocessing(df, ["n"], ["c.d", "e"])
    fitted.table(spark).write.parquet(f"{tmp_path}/prepared")
    back = features.Prepared.read(spark.read.parquet(f"{tmp_path}/prepared"))
    assert back == fitted
    both = [sorted(map(tuple, p.transform(df, ["id"]).collect())) for p in (fitted, back)]
    assert both[0] == both[1]


SHEET = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType()), T.StructField("price", T.DoubleType())])


def test_rejected_lines_carry_their_numbers(spark, tmp_path):
    for n in range(3):
        lines = ["k,name,price"]
        for i in range(5000):
            bad = {17: "x,y,z", 18: f"{i}", 4000: f"{i},a,b,c", 4001: ""}.get(i)
            lines.append(bad if bad is not None else f'{i},"name, ""{i}""",{i}.5')
        (tmp_path / f"sheet{n}.csv").write_text("\n".join(lines) + "\n")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # many splits a file
    try:
        good, rejected = files.read_sheet_checked(spark, str(tmp_path), SHEET)
        assert good.rdd.getNumPartitions() > 0 and good.count() == 3 * 4996
        assert sorted((r.line, r.text) for r in rejected.collect()) == sorted([(19, "x,y,z"), (20, "18"), (4002, "4000,a,b,c")] * 3)
        assert good.filter(f"name <> concat('name, \"', k, '\"') OR line <> k + 2 OR price <> k + 0.5").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def test_logs_of_any_layout_and_headers_anywhere(spark, tmp_path):
    header = ",".join
    record = lambda columns, **v: ",".join(str(v.get(c, 0 if c.startswith("aantal") else c)) for c in columns)
    (tmp_path / "a.csv").write_text("\n".join([
        "stray line above any header", header(WAREHOUSE_COLUMNS), record(WAREHOUSE_COLUMNS, aantal_dwh_na=3, melding='"no such ""table"",\n\nsorry"'),
        record(WAREHOUSE_COLUMNS, aantal_dwh_na=4), header(STAGING_COLUMNS), record(STAGING_COLUMNS, aantal_doel_na=5, melding=f'"like a header:\n{header(NOTEBOOK_COLUMNS)}"'),
        header(WAREHOUSE_COLUMNS), record(WAREHOUSE_COLUMNS, aantal_dwh_na="many"), "",
    ]))
    (tmp_path / "b.csv").write_text("\n".join([header(NOTEBOOK_COLUMNS), record(NOTEBOOK_COLUMNS, aantal=6, melding="x")]))
    got = read_mixed_logs(spark, str(tmp_path)).orderBy("file", "line").collect()
    assert [r.layout for r in got] == [15, 15, 14, 15, 7] and [r.line for r in got] == [3, 6, 8, 11, 2]
    assert [r.aantal_dwh_na for r in got] == [3, 4, None, None, None] and [r.aantal_doel_na for r in got] == [None, None, 5, None, None]
    assert got[0].melding == 'no such "table",\n\nsorry' and got[2].melding == f"like a header:\n{header(NOTEBOOK_COLUMNS)}"
    assert got[4].aantal == 6 and got[4].run_id is None and got[0].run_id == "run_id"


def test_broadcast_sizes_are_measured(spark):
    df = spark.createDataFrame([(1, "x" * 1000, [1, 2, 3], None), (2, None, None, ["ab", "c"])], "a long, s string, l array<long>, t array<string>")
    assert 1000 < measured_bytes(df) < 2000 and measured_bytes(df.select("a")) == 16 and measured_bytes(df.filter("false")) == 0
    wide = spark.range(1000).select(F.sequence(F.lit(1), F.lit(500)).alias("l"))
    assert measured_bytes(wide) > 1000 * 500 * 8


@pytest.mark.parametrize("block_rows, offset", [(8192, 0.0), (40, 0.0), (40, 1e6)])
def test_plain_silhouettes_of_block_pairs(spark, block_rows, offset):
    """Every pair of blocks meets once; a far offset and equal points lose no digits that count."""
    draw = np.random.default_rng(8)
    x = draw.normal(size=(260, 3)) + draw.integers(0, 3, 260)[:, None] * 2.0 + offset
    x[50:55] = x[49]
    own = draw.integers(0, 4, 260)
    own[0] = 9  # alone in its cluster
    df = spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, own))], "id long, f array<double>, c int")
    got = {r.id: r.silhouette for r in silhouette.silhouette_exact(df.repartition(5), "id", "f", "c", block_rows).collect()}
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for i in range(len(x)):
        mine = own == own[i]
        if mine.sum() == 1:
            expected = 0.0
        else:
            a, b = far[i, mine].sum() / (mine.sum() - 1), min(far[i, own == c].mean() for c in set(own) - {own[i]})
            expected = (b - a) / max(a, b)
        assert got[i] == pytest.approx(expected, abs=1e-7)


def test_cluster_runs_rank_by_plain_distances(spark, tables):
    grid = [c for c in experiments.CLUSTER_GRID if c.name in ("exp 15", "exp 16")]
    small = [type(c)(c.name, c.features, c.k, n_init=2) for c in grid]
    rows = experiments.cluster_grid(experiments.profile(tables), small, plain=True).collect()
    assert len(rows) == 2 and rows[0].silhouette >= rows[1].silhouette and all(-1 <= r.silhouette <= 1 for r in rows)


def grown_by_hand(x, y, weight, used, entropy, min_leaf, min_split, max_depth, path="", depth=0):
    """Nodes by path: (rows, label, feature, threshold), every midpoint tried, equal gains to the first feature and value."""
    known = sorted(weight)

    def impurity(part):
        mass = np.array([(part == k).sum() * weight[k] for k in known])
        p = mass[mass > 0] / mass.sum()
        return (-(p * np.log2(p)).sum() if entropy else 1 - (p * p).sum()) if len(part) else 0.0

    heavy = lambda part: sum((part == k).sum() * weight[k] for k in known)
    label = max(known, key=lambda k: (round((y == k).sum() * weight[k], 9), -known.index(k)))
    out, best = {path: (len(y), label, None, None)}, None
    if impurity(y) > 0 and len(y) >= min_split and (max_depth is None or depth < max_depth):
        for f in used:
            values = np.unique(x[:, f])
            for low, high in zip(values, values[1:]):
                left = x[:, f] <= low
                if min(left.sum(), (~left).sum()) >= min_leaf:
                    after = (heavy(y[left]) * impurity(y[left]) + heavy(y[~left]) * impurity(y[~left])) / heavy(y)
                    way = (-round(impurity(y) - after, 10), f, low / 2 + high / 2)
                    if way[0] < 0 and (best is None or way < best):
                        best = way
    if best:
        _, f, threshold = best
        out[path] = (len(y), label, f, threshold)
        left = x[:, f] <= threshold
        for side, rows in (("L", left), ("R", ~left)):
            out |= grown_by_hand(x[rows], y[rows], weight, used, entropy, min_leaf, min_split, max_depth, path + side, depth + 1)
    return out


def test_trees_grow_exactly_and_score_by_joins(spark):
    draw = np.random.default_rng(11)
    n = 240
    x = np.column_stack([draw.normal(size=n), draw.integers(0, 5, n), draw.integers(0, 2, n) * 1.0])
    y = np.array([("a", "b", "c")[int(v)] for v in (x[:, 0] > 0).astype(int) + (draw.uniform(size=n) > 0.8)])
    df = spark.createDataFrame([(i, *map(float, r), str(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, u double, `v.w` double, z double, y string")
    names = ("u", "v.w", "z")
    runs = [
        TreeConfig("deep", names), TreeConfig("entropy", names, 4, criterion="entropy"), TreeConfig("leaf", names, 5, 30, 12),
        TreeConfig("balanced", names, 3, class_weight="balanced"), TreeConfig("few", ("v.w", "z"), 3),
    ]
    size = {k: (y == k).sum() for k in "abc"}
    with scratch(spark) as keep:
        nodes = growth.grow(df.repartition(5), names, "y", runs, keep)
        found = {(r.run, r.node): (r.rows, r.label, r.feature, r.threshold) for r in nodes.collect()}
        guesses = {}
        for limits in ({}, {"max_depth": 2}, {"min_split": 40}):
            got = growth.predict(df, "id", nodes, keep, **limits).collect()
            assert len(got) == n * len(runs)
            guesses[str(limits)] = {(r.run, r.id): r.label for r in got}
    expected = {}
    for r in runs:
        weight = {k: n / (3 * size[k]) if r.class_weight else 1.0 for k in "abc"}
        by_hand = grown_by_hand(x, y, weight, [names.index(f) for f in r.features], r.criterion == "entropy", r.min_samples_leaf, r.min_samples_split, r.max_depth)
        for path, (rows, label, f, threshold) in by_hand.items():
            expected[r.name, path] = (rows, label, None if f is None else names[f], threshold)
        for key, depth, split in (("{}", 99, 0), ("{'max_depth': 2}", 2, 0), ("{'min_split': 40}", 99, 40)):
            for i in range(n):
                path = ""
                while by_hand[path][2] is not None and len(path) < depth and by_hand[path][0] >= split:
                    path += "L" if x[i, by_hand[path][2]] <= by_hand[path][3] else "R"
                assert guesses[key][r.name, i] == by_hand[path][1]
    assert found.keys() == expected.keys() and max(len(p) for _, p in found) > 6
    for key, (rows, label, feature, threshold) in expected.items():
        assert found[key][:3] == (rows, label, feature) and found[key][3] == (threshold if threshold is None else pytest.approx(threshold))


def test_trees_of_nothing(spark):
    df = spark.createDataFrame([], "id long, u double, y string")
    with scratch(spark) as keep:
        nodes = growth.grow(df, ("u",), "y", [TreeConfig("r", ("u",))], keep)
        assert nodes.count() == 0 and growth.predict(df, "id", nodes, keep).count() == 0
