"""Work that must not grow faster than the tables: what passes through the driver, what is shuffled, held and repeated."""

from __future__ import annotations

from datetime import datetime

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from shop import shop, write_shop

from starling import session
from starling.operators import clustering, growth, silhouette
from starling.operators.tree import TreeConfig
from starling.plans import facts, registry, sample_loads, warehouse_load
from starling.plans.oracle import ORACLES
from starling.plans.staging_load import load_staging
from starling.plans.tables import Tables
from starling.schemas import STAGING, STAR, STAR_BANDS
from starling.session import scratch
from starling.sources.store import Store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def star_of(spark, root):
    """The star after two loads, the second with a moved customer, a raised wage and a new sale."""
    data, star = shop(), Store(spark, f"{root}/star", STAR, STAR_BANDS)
    staging = Store(spark, f"{root}/staging", STAGING)
    for moment in (datetime(2024, 1, 1), datetime(2024, 1, 2)):
        load_staging(spark, write_shop(spark, data, f"{root}/src-{moment:%d}"), staging, moment)
        load = warehouse_load.WarehouseLoad(spark, staging, star, moment)
        load.run()
        data["Fiets_Verkoop"]["Klant"][0] = (1, "Jan Jansen", "Laan 1", "Leidschendam", "M", "1990-01-01")
        data["Fiets_Verkoop"]["Monteur"][0] = (1, "Tom", "Delft", 25.0, 1)
        data["Fiets_Verkoop"]["Fiets_Verkoop"].append((6, "2023-05-03", 1, 500.0, 1, 1, 1))
    return star, load


def test_many_rows_are_never_sent_through_the_driver(spark, tmp_path, monkeypatch):
    few, load = star_of(spark, str(tmp_path / "few"))
    assert "Broadcast" in plan(load._look_up(load._staged("Fiets_Verkoop_Klant").withColumn("klant_bk", F.col("naam")), "Klant"))
    monkeypatch.setattr(session, "SENT_ROWS", 0)
    monkeypatch.setattr(session, "SENT_NUMBERS", 0)
    monkeypatch.setattr(warehouse_load, "SENT_ROWS", 0)
    many, load = star_of(spark, str(tmp_path / "many"))
    for found in (load._sales("Fiets_Verkoop", 1), load._purchases("Accessoire_Inkoop", 1), load._people("Onderhoud"), load.product()):
        assert "Broadcast" not in plan(found)
    for table in STAR:
        rows = lambda star: sorted(map(str, star.read(table).collect()))
        assert rows(few) == rows(many) and (rows(few) or table == "Onderhoud")


def test_orders_meet_their_lines_once_for_all_runs(spark, tables):
    with scratch(spark) as keep:
        orders = keep(sample_loads.orders_with_lines(tables))
        for first in (True, False):
            for system in ("Fiets_Verkoop", "Accessoire_Verkoop", "Fiets_Inkoop", "Accessoire_Inkoop"):
                shared = sample_loads.Sources(tables, first, orders).table(system, system)
                assert "Exchange" not in plan(shared) and "lineitem" not in plan(shared)
                own = sample_loads.Sources(tables, first).table(system, system)
                assert sorted(map(str, shared.collect())) == sorted(map(str, own.collect())) != []


def test_bands_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    star = Store(spark, str(tmp_path), {"Verkoop": STAR["Verkoop"]}, STAR_BANDS)
    names = STAR["Verkoop"].names
    row = [F.col("id").cast(f.dataType).alias(f.name) if f.name != "verkoopnr" else (F.col("id") * 5_000_000).alias("verkoopnr") for f in STAR["Verkoop"].fields]
    df = spark.range(1, 9).coalesce(1).select(*row)
    with monkeypatch.context() as patch:
        patch.delattr(type(df), "repartition")
        star.publish("Verkoop", df, "a")
    assert sorted(map(tuple, star.read("Verkoop").collect())) == sorted(map(tuple, df.select(names).collect()))
    assert [r.verkoopnr for r in star.near("Verkoop", df.filter("verkoopnr = 40000000")).collect()] == [40_000_000]


def test_lines_are_not_sorted_to_meet_orders(spark, tables, monkeypatch):
    expected = sorted(map(tuple, registry.fact_optional_fk(tables).collect()))
    monkeypatch.setattr(facts, "fits_broadcast", lambda *a: False)
    joined = facts.sales_with_keys(tables)
    assert "ShuffledHashJoin [l_orderkey" in plan(joined)
    assert sorted(map(tuple, registry.fact_optional_fk(tables).collect())) == expected != []


def test_covariances_of_many_columns_with_gaps(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 12)) + 1e6
    x[draw.uniform(size=x.shape) < 0.2] = np.nan
    x[:, 11] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    names = [f"c{i}" for i in range(12)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    means, found = clustering.covariances(df, names)
    sums = df.agg(*[F.avg(c) for c in names], *[F.covar_pop(a, b) for a in names for b in names]).first()
    number = lambda v: np.nan if v is None else v
    assert np.allclose(means, [number(v) for v in sums[:12]], equal_nan=True, rtol=1e-12)
    assert np.allclose(found, np.array([number(v) for v in sums[12:]]).reshape(12, 12), equal_nan=True, atol=1e-8)
    # one row of sums a task, however many pairs of columns
    assert clustering._merged(*[clustering._moments(b) for b in df.limit(100).toArrow().to_batches(50)][:2])[0].shape == (12, 12)


def test_runs_over_the_same_columns_share_their_product(spark):
    draw = np.random.default_rng(6)
    x = np.concatenate([draw.normal(size=(60, 3)), np.zeros((5, 3))])
    runs = [draw.normal(size=(k, 3)) for k in (2, 5)] + [np.array([[1.0, 0, 0], [-1.0, 0, 0]])]  # the zeros tie: the first centre has them
    ends = np.cumsum([0, *map(len, runs)])
    total = np.zeros((ends[-1], 6))
    clustering._add_chunk(total, x, np.concatenate(runs), list(zip(ends, ends[1:])))
    for centres, low, high in zip(runs, ends, ends[1:]):
        label, distance = clustering._nearest(x, centres)
        member = (label[:, None] == np.arange(len(centres))).astype(float)
        assert np.allclose(total[low:high], member.T @ np.column_stack([np.ones(len(x)), x, distance, (x * x).sum(axis=1)]))


def test_equal_rows_of_a_tree_are_counted_once(spark):
    few = [(float(a), float(b), "x" if a + 2 * b > 3 else "y") for a in range(4) for b in range(3)]
    one = spark.createDataFrame(few, "a double, b double, y string")
    runs = [TreeConfig("leaf", ("a", "b"), 4, min_samples_leaf=40), TreeConfig("balanced", ("a", "b"), 4, class_weight="balanced")]
    largest = []

    def counting(keep):
        def kept(df):
            out = keep(df)
            largest.append(out.count())
            return out
        return kept

    with scratch(spark) as keep:
        nodes = growth.grow(one.crossJoin(spark.range(40)).drop("id").repartition(3), ("a", "b"), "y", runs, counting(keep))
        found = sorted((r.run, r.node, r.rows, r.label, r.feature, r.threshold) for r in nodes.na.fill({"feature": "", "threshold": 0.0}).collect())
        assert max(largest) <= len(few) * len(runs) * 2
        alone = [TreeConfig("leaf", ("a", "b"), 4), TreeConfig("balanced", ("a", "b"), 4, class_weight="balanced")]
        plain = growth.grow(one, ("a", "b"), "y", alone, keep).na.fill({"feature": "", "threshold": 0.0}).collect()
    assert found == sorted((r.run, r.node, r.rows * 40, r.label, r.feature, r.threshold) for r in plain)
    assert {r[2] for r in found if r[1] == ""} == {480}


@pytest.mark.parametrize("copies", [1, 3])
def test_rows_stand_for_as_many_as_were_alike(spark, copies):
    df = spark.range(50).select(F.col("id").cast("string").alias("label"), F.array(F.col("id").cast("double")).alias("x"))
    with scratch(spark) as keep:
        found = growth._counted(df.crossJoin(spark.range(copies).withColumnRenamed("id", "copy")).drop("copy"), keep)
        assert {(r.w) for r in found.collect()} == {copies} and found.count() == 50


def rows_from_python(df):
    """Rows that the Python functions of ``df`` returned."""
    df.collect()
    nodes, found = [df._jdf.queryExecution().executedPlan()], 0
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        else:
            metric = node.metrics().get("pythonNumRowsReceived")
            found += metric.get().value() if metric.isDefined() else 0
            nodes.extend(node.children().apply(i) for i in range(node.children().size()))
    return found


def test_plain_silhouettes_emit_blocks_plus_clusters(spark):
    """Sums leave the tasks per row and cluster of the block it meets: never all clusters for every block."""
    draw = np.random.default_rng(9)
    rows, clusters, block_rows = 1200, 8, 100
    df = spark.createDataFrame([(i, draw.normal(size=2).tolist(), int(draw.integers(0, clusters))) for i in range(rows)], "id long, f array<double>, c int")
    found = rows_from_python(silhouette.silhouette_exact(df, "id", "f", "c", block_rows))
    blocks = rows // block_rows + 1
    assert rows * blocks <= found <= rows * (blocks + clusters + 4)


@pytest.mark.parametrize("dims", [2, 64])
def test_distance_sums_over_tiles(dims):
    draw = np.random.default_rng(10)
    x, y = draw.normal(size=(700, dims)) + 50, draw.normal(size=(530, dims)) + 50
    x_starts, y_starts = np.array([0, 1, 256, 600]), np.array([0, 255, 256, 257, 500, 529])
    far = lambda a, b: np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    to_y, to_x = silhouette.distance_sums(x, y, x_starts, y_starts, False)
    assert np.allclose(to_y, np.add.reduceat(far(x, y), y_starts, axis=1), rtol=1e-11)
    assert np.allclose(to_x, np.add.reduceat(far(y, x), x_starts, axis=1), rtol=1e-11)
    to_x = silhouette.distance_sums(x, x, x_starts, x_starts, True)[0]
    assert np.allclose(to_x, np.add.reduceat(far(x, x), x_starts, axis=1), rtol=1e-11)


def test_plain_silhouettes_of_rows_without_vector_or_cluster(spark, tmp_path):
    """As in SQL: they are counted with their cluster, and score 0; keys may repeat."""
    draw = np.random.default_rng(11)
    rows = [(i % 190, draw.normal(size=3).astype("float32").tolist() if i % 9 else None, i % 4 if i % 13 else None) for i in range(200)]
    rows += [(300 + i, None, 7) for i in range(3)] + [(310, [0.5, 1.0, 2.0], 8), (None, [0.5, 1.5, 2.0], 1), (None, [4.5, 1.5, 2.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    with duckdb.connect() as sql:
        sql.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
        expected = sorted(sql.execute(ORACLES["silhouette_small"]).fetchall(), key=str)
    assert sorted(map(tuple, registry.silhouette_small(Tables(spark, str(tmp_path))).collect()), key=str) == expected
    blocked = silhouette.silhouette_exact(df, "vec_id", "embedding", "label", 20)
    assert sorted((r.id, r.cluster, round(r.silhouette, 6)) for r in blocked.na.fill(-1).collect()) == sorted((-1 if i is None else i, -1 if c is None else c, v) for i, c, v in expected)
    assert silhouette.silhouette_exact(df.filter("false"), "vec_id", "embedding", "label").count() == 0
    with pytest.raises(Exception, match="differ in length"):
        silhouette.silhouette_exact(df.withColumn("embedding", F.slice("embedding", 1, F.col("label") + 1)), "vec_id", "embedding", "label").collect()
