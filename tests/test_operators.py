"""Hand-written cases for keys, dimensions, facts, staging and quality."""

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starling.functions import columns as C
from starling.functions import dates as D
from starling import session
from starling.operators import dims, facts, frames, keys, quality, scd, staging
from starling.sources import files

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
DIM = "sk long, bk string, city string, size long"
HISTORY = "sk long, bk string, wage double, begin_tijd timestamp, eind_tijd timestamp"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# keys


def test_business_key_never_null(spark):
    df = spark.createDataFrame([(None, "1990-01-01", 1), ("Jan", None, None)], "a string, b string, n long")
    assert [r[0] for r in df.select(C.business_key("a", "b", "n")).collect()] == ["None_1990-01-01_1", "Jan_None_None"]
    assert [r[0] for r in df.select(C.source_key("X_", "n")).collect()] == ["X_1", None]


@pytest.mark.parametrize("parts", [1, 7])
def test_first_source_wins_whatever_the_partitioning(spark, parts):
    branches = [[(f"k{i}", i, "one") for i in range(50)], [(f"k{i}", i, "two") for i in range(25, 75)]]
    union = staging.union_branches([spark.createDataFrame(b, "bk string, n long, src string") for b in branches], "_b")
    kept = keys.first_per_key(union.repartition(parts), ["bk"], ["_b", "n"])
    assert rows(kept.groupBy("src").count()) == [("one", 50), ("two", 25)]


@pytest.mark.parametrize("parts", [1, 5])
def test_dense_keys_are_dense_unique_and_stable(spark, parts):
    df = spark.range(5000).withColumn("k", F.concat(F.lit("key"), "id")).repartition(parts)
    got = keys.dense_keys(df, ["k"], "sk", start=12)
    assert sorted(r.sk for r in got.collect()) == list(range(13, 5013))
    again = keys.dense_keys(df.repartition(3), ["k"], "sk", start=12)
    assert rows(got, "k", "sk") == rows(again, "k", "sk")
    assert rows(keys.dense_keys(df.limit(0), ["k"], "sk")) == []
    with pytest.raises(ValueError):
        keys.dense_keys(df, ["k"], "sk", digits=5)


def test_first_per_key_limits_rows_before_the_shuffle(spark):
    """A key with a third of the rows sends one row per input partition."""
    df = spark.range(30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    plan = keys.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert keys.first_per_key(df, ["k"], ["id"]).count() == 20001


# dimensions


def test_scd1(spark):
    dim = spark.createDataFrame([(1, "a", "Delft", 1), (2, "b", None, None), (3, "gone", "X", 9)], DIM)
    inc = spark.createDataFrame([("a", "Leiden", 1), ("b", None, None), ("c", "Gouda", 3)], "bk string, city string, size long")
    tracked = ["city", "size"]
    got = scd.scd1_merge(dim, inc, "bk", tracked, "sk")
    assert rows(got) == [(1, "a", "Leiden", 1), (2, "b", None, None), (3, "gone", "X", 9), (4, "c", "Gouda", 3)]
    assert scd.count_actions(scd.classify(dim, inc, "bk", tracked, "sk")).first() == (1, 1, 1)
    assert rows(scd.scd1_merge(got, inc, "bk", tracked, "sk")) == rows(got)


def test_a_value_set_to_null_is_an_update(spark):
    dim = spark.createDataFrame([(1, "a", "Delft", 1)], DIM)
    inc = spark.createDataFrame([("a", None, 1)], "bk string, city string, size long")
    assert rows(scd.scd1_merge(dim, inc, "bk", ["city", "size"], "sk")) == [(1, "a", None, 1)]


def test_one_new_key_does_not_touch_unchanged_ones(spark):
    dim = spark.createDataFrame([(i, f"k{i}", "X", i) for i in range(9)], DIM)
    inc = spark.createDataFrame([(f"k{i}", "X", i) for i in range(10)], "bk string, city string, size long")
    assert scd.count_actions(scd.classify(dim, inc, "bk", ["city", "size"], "sk")).first() == (1, 0, 9)


def test_scd2(spark):
    first = spark.createDataFrame([("tom", 19.5), ("els", 20.0), ("old", 1.0)], "bk string, wage double")
    history = scd.scd2_initial(first, "bk", "sk", T1).select("sk", "bk", "wage", "begin_tijd", "eind_tijd")
    inc = spark.createDataFrame([("tom", 219.5), ("els", 20.0), ("new", 5.0)], "bk string, wage double")
    merged = scd.scd2_merge(history, inc, "bk", ["wage"], "sk", T2)
    assert rows(merged, "bk", "wage", "begin_tijd", "eind_tijd") == sorted([
        ("tom", 19.5, T1, T2), ("tom", 219.5, T2, None), ("els", 20.0, T1, None), ("old", 1.0, T1, None),
        ("new", 5.0, T2, None)], key=repr)
    assert sorted(r.sk for r in merged.collect()) == [1, 2, 3, 4, 5]
    again = scd.scd2_merge(merged, inc, "bk", ["wage"], "sk", T3)
    assert rows(again) == rows(merged)
    closed = scd.scd2_merge(merged, inc, "bk", ["wage"], "sk", T3, close_missing=True)
    assert rows(closed.filter("bk = 'old'"), "eind_tijd") == [(T3,)]


def test_scd2_random_runs_keep_the_invariants(spark):
    """At most one open version, touching half-open intervals, dense unique keys."""
    rng = random.Random(5)
    history = spark.createDataFrame([], HISTORY)
    moments = [datetime(2024, 1, d) for d in range(1, 5)]
    for moment in moments:
        wages = [(f"k{i}", float(rng.choice([1, 2, None or 3]))) for i in rng.sample(range(12), 8)]
        inc = spark.createDataFrame(wages, "bk string, wage double")
        before = scd.count_actions(scd.classify(scd.current(history), inc, "bk", ["wage"], "sk")).first()
        merged = scd.scd2_merge(history, inc, "bk", ["wage"], "sk", moment)
        data = merged.collect()
        assert sum(before) == len(wages)
        assert len(data) == history.count() + before[0] + before[1]
        history = spark.createDataFrame(data, HISTORY)
    versions = {}
    for r in sorted(history.collect(), key=lambda r: (r.bk, r.begin_tijd)):
        versions.setdefault(r.bk, []).append(r)
    for mine in versions.values():
        assert [v.eind_tijd for v in mine[:-1]] == [v.begin_tijd for v in mine[1:]] and mine[-1].eind_tijd is None
    assert sorted(r.sk for r in history.collect()) == list(range(1, history.count() + 1))


def test_scd2_closed_versions_pass_by_the_joins(spark):
    """One key may hold most of the history; only its open row is joined."""
    old = [(i, "hot", float(i), T1, T2) for i in range(1, 400)]
    history = spark.createDataFrame([*old, (400, "hot", 400.0, T2, None), (401, "b", 1.0, T2, None)], HISTORY)
    inc = spark.createDataFrame([("hot", 7.0), ("b", 1.0)], "bk string, wage double")
    merged = scd.scd2_merge(history, inc, "bk", ["wage"], "sk", T3)
    assert merged.count() == 402
    assert rows(merged.filter("eind_tijd IS NULL"), "sk", "bk", "wage") == [(401, "b", 1.0), (402, "hot", 7.0)]


def test_scd2_append_and_current_by_max(spark):
    history = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 1.0)], "sk long, bk string, wage double")
    assert rows(scd.current_by_max(history, ["bk"], "sk")) == [(2, "a", 2.0), (3, "b", 1.0)]
    inc = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 4.0)], "bk string, wage double")
    added = scd.scd2_append(history, inc, "bk", ["wage"], "sk")
    assert {(r.bk, r.wage) for r in added.collect()} == {("a", 1.0), ("c", 4.0)}
    assert sorted(r.sk for r in added.collect()) == [4, 5]
    assert [r.sk for r in scd.history_of(history, "bk", "sk", "a").collect()] == [1, 2]


def test_insert_only(spark):
    dim = spark.createDataFrame([(7, "a", "Delft", 1)], DIM)
    inc = spark.createDataFrame([("a", "Leiden", 5), ("b", "Gouda", 2)], "bk string, city string, size long")
    assert rows(scd.insert_only(dim, inc, "bk", "sk")) == [(8, "b", "Gouda", 2)]


def test_date_dim(spark):
    texts = [("2024-01-01",), ("bad",), (None,), ("2024-01-01 10:00:00",), ("12:30:00",), ("2024-02-30",)]
    df = spark.createDataFrame(texts, "datum string")
    empty = spark.createDataFrame([], "datum_key long")
    got = dims.date_dim([(df, "datum"), (spark.sql("select timestamp'2024-05-09 23:59:59' as ts"), "ts")], empty)
    assert rows(got) == [(20240101, "2024-01-01", 1, 1, 1, 2024), (20240509, "2024-05-09", 9, 5, 2, 2024)]
    assert rows(dims.date_dim([(df, "datum")], got)) == []


def test_period_dim(spark):
    schema = "inkoopmaand long, inkoopjaar long"
    existing = spark.createDataFrame([(12, 11, 2024), (5, None, 2023)], f"periode_key long, {schema}")
    seen = spark.createDataFrame([(1, 2025), (12, 2024), (11, 2024), (None, 2023), (1, 2025)], schema)
    assert rows(dims.period_dim([seen], existing)) == [(13, 12, 2024), (14, 1, 2025)]


# staging


def test_consolidate_keeps_repeats_inside_a_source(spark):
    schema = "k long, v string"
    existing = spark.createDataFrame([(1, "t")], schema)
    first = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a2")], schema)
    second = spark.createDataFrame([(2, "b"), (3, "b")], schema)
    assert rows(staging.consolidate([first, second], existing, ["k"])) == [(2, "a"), (2, "a2"), (3, "b")]


def test_align(spark):
    df = spark.createDataFrame([(1, "x", "extra")], "k int, v string, w string")
    target = spark.createDataFrame([], "k long, v string, n double").schema
    got = staging.align(df, target)
    assert got.schema == target and rows(got) == [(1, "x", None)]


def test_reconcile(spark):
    counts = spark.createDataFrame([(10, 5, 14), (9, 5, 14)], "aantal_bron long, aantal_doel_voor long, aantal_doel_na long")
    assert rows(staging.reconcile(counts), "aantal_verwerkt", "status") == [(9, "OK"), (9, "WARNING")]


# facts


def test_lookup_rejects_and_increment(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "nr long, bk string")
    dim = spark.createDataFrame([(10, "a"), (11, "b")], "sk long, business_key string")
    found = facts.lookup(fact, dim, "bk", "sk")
    assert found.columns == ["nr", "bk", "sk"]
    assert rows(facts.reject_missing(found, ["sk"])) == [(1, "a", 10)]
    assert rows(quality.missing_keys(found, ["sk"], ["nr", "bk"])) == [(2, "zz", None), (3, None, None)]
    loaded = spark.createDataFrame([(1, "a", 10)], found.schema)
    assert rows(facts.new_rows(found, loaded, ["nr"]), "nr") == [(2,), (3,)]
    few = facts.new_rows(found, loaded, ["nr"], batch=fact)
    assert rows(few, "nr") == [(2,), (3,)]


def test_few_new_rows_do_not_shuffle_the_history(spark, tmp_path):
    spark.range(100000).select(F.col("id").alias("nr"), F.lit(1).alias("v")).write.parquet(f"{tmp_path}/history")
    history = spark.read.parquet(f"{tmp_path}/history")
    batch = spark.range(99990, 100010).select(F.col("id").alias("nr"))
    fresh = facts.new_rows(batch, history, ["nr"], batch=batch)
    assert rows(fresh) == [(i,) for i in range(100000, 100010)]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("FileScan")
    assert "LeftSemi" in plan[:scan] and "Exchange hashpartitioning" not in plan[plan.index("LeftSemi"):scan]


def test_broadcast_is_bound_by_rows(spark):
    side = spark.range(1000).select("id", F.lit("x").alias("name"))
    # 8 bytes for the number, 16 and the measured length for the text
    assert session.fits_broadcast(side, side, max_bytes=25000) and not session.fits_broadcast(side, side, max_bytes=24999)
    wide = side.withColumn("name", F.repeat("name", 1000))
    assert not session.fits_broadcast(wide, wide, max_bytes=72000)
    assert session.fits_broadcast(wide.select("id"), wide, max_bytes=8000) and not session.fits_broadcast(wide.select("id"), wide, max_bytes=7999)
    assert "UnresolvedHint" in session.broadcast_if_small(side, side)._jdf.queryExecution().logical().toString()
    assert "Hint" not in session.broadcast_if_small(side, side, 10)._jdf.queryExecution().logical().toString()


def test_staging_uses_the_named_folder_and_cleans_up(spark):
    folder = session.shared_dir(spark)
    with session.scratch(spark) as stage:
        staged = stage(spark.range(10))
        assert staged.count() == 10 and folder in staged.inputFiles()[0]
        inside = len(files.list_names(spark, folder))
    assert len(files.list_names(spark, folder)) == inside - 1
    assert session.stage(spark.range(100), "id").rdd.getNumPartitions() > 1


def test_null_safe_lookup(spark):
    fact = spark.createDataFrame([(1, None, 2024), (2, 5, 2024)], "nr long, m long, y long")
    dim = spark.createDataFrame([(1, None, 2024)], "sk long, m long, y long")
    got = facts.lookup(fact, dim, ["m", "y"], "sk", dim_key=["m", "y"], null_safe=True)
    assert rows(got, "nr", "sk") == [(1, 1), (2, None)]


def test_maintenance_measures(spark):
    df = spark.createDataFrame([("09:00", "10:30", 20.0), ("23:30:00", "00:15:00", 10.0), ("x", "10:00", 1.0)],
                               "starttijd string, eindtijd string, uurloon double")
    assert rows(facts.maintenance_measures(df), "duur", "kosten") == [(0.75, 7.5), (1.5, 30.0), (None, None)]


def test_hot_lookup_key_is_split(spark):
    """A key with a third of the facts: the shuffled lookup splits its partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string"))
        fact = spark.range(0, 120000, 1, 8).select("id", key.alias("bk"))
        dim = spark.range(5000).select(F.col("id").alias("sk"), F.col("id").cast("string").alias("business_key"))
        dim = dim.unionByName(spark.createDataFrame([(-1, "hot")], dim.schema))
        found = facts.lookup(fact, dim, "bk", "sk")
        assert len(found.collect()) == 120000
        assert found.filter("sk = -1").count() == 40000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# quality


def test_quality_reports(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, None)], "k long, p long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(1, 2)]
    assert rows(quality.orphans(df, "p", parent, "id"), "k", "p") == [(1, 2)]
    assert rows(quality.final_counts({"a": df, "b": df.limit(0)})) == [("a", 3, "OK"), ("b", 0, "WARNING")]
    errors = []
    assert not quality.run_step(lambda: 1 / 0, errors.append) and len(errors) == 1
    assert quality.run_step(lambda: None, errors.append) and len(errors) == 1


# frames and functions


def test_frame_operators(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, a string")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "id long, b double")
    both = frames.side_by_side([a, b], "id")
    assert rows(both) == [(1, "x", None), (2, "y", 5.0), (3, None, 6.0)]
    assert rows(frames.append_row(a, id=9)) == [(1, "x"), (2, "y"), (9, None)]
    assert rows(frames.add_listed(a, "id", "lang", {1: "FR"}, "string")) == [(1, "x", "FR"), (2, "y", None)]
    assert rows(frames.drop_rows(a, "id", [1])) == [(2, "y")]
    assert frames.numeric_columns(both) == ["id", "b"] and frames.other_columns(both) == ["a"]
    assert rows(files.columns_of(b)) == [(0, "id", "bigint", 2), (1, "b", "double", 2)]


def test_value_functions(spark):
    df = spark.createDataFrame([("yes", "12", "Branch Manager"), ("no", "x", None), ("?", None, "Clerk")],
                               "g string, n string, p string")
    got = df.select(
        C.map_values("g", {"yes": 1, "no": 0}), C.to_number("n") + 1, C.flag_contains("p", "Manager"),
        C.replace_value("p", "Branch Manager", "General Manager"), C.full_name("g", "p"))
    assert [tuple(r) for r in got.collect()] == [
        (1, 13.0, "Ja", "General Manager", "yes Branch Manager"), (0, None, "Nee", None, None),
        (None, None, "Nee", "Clerk", "? Clerk")]


def test_date_functions(spark):
    df = spark.createDataFrame([("16-8-2013", "2013-08-16"), ("2013-08-16", "junk"), (None, None)], "d string, i string")
    got = df.select(D.pattern_day("d"), D.years_since(D.pattern_day("d"), 2026), D.date_key("i"))
    assert [tuple(r) for r in got.collect()] == [(date(2013, 8, 16), 13, 20130816), (None, None, None), (None, None, None)]


def test_sheet_scan(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text('price,note\n1.5,"two\nlines"\n,"say ""hi"""\n')
    schema = spark.createDataFrame([], "price double, note string").schema
    assert rows(files.read_sheet(spark, str(path), schema)) == [(1.5, "two\nlines"), (None, 'say "hi"')]
    assert files.row_count(spark, str(tmp_path / "absent.parquet")) == 0
    assert "part" in files.table_names(spark, "/root/testdata/sf0.001")
