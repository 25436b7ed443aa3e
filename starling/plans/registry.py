"""Queries over the sample tables, one per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions import columns as C
from starling.functions import dates as D
from starling.operators import (
    clustering, dims, features, frames, growth, keys, metrics, quality, regression, scd, silhouette, sparse, staging,
)
from starling.operators import facts as fact_ops
from starling.operators.tree import TreeConfig
from starling.plans import experiments as grids
from starling.plans import facts, sample_loads
from starling.plans.relational import QUESTIONS
from starling.plans.tables import LINE_ID, Tables
from starling.session import scratch, shared_dir, stage
from starling.sources import files

RUN_TS = datetime(2021, 1, 1)
KLANT_TRACKED = ["klantnr", "naam", "woonplaats", "adres"]
MONTEUR_TRACKED = ["monteurnr", "naam", "woonplaats", "uurloon"]

QUERIES: dict[str, Callable[[Tables], DataFrame]] = dict(QUESTIONS)


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# sources


@query
def scan_constants(t: Tables) -> DataFrame:
    plain = t.part.select(F.col("p_partkey").alias("productnr"), F.col("p_name").alias("soort"))
    return files.select_constants(plain, product_type=("accessoire", "string"), kleur=(None, "string"), source_id=(2, "int"))


@query
def preview_orders(t: Tables) -> DataFrame:
    return files.preview(t.orders.select("o_orderkey", "o_totalprice"), 10, "o_orderkey")


@query
def table_counts(t: Tables) -> DataFrame:
    count = lambda name: getattr(t, name).agg(F.count("*").alias("aantal")).select(F.lit(name).alias("tabel"), "aantal")
    return staging.union_branches([count(n) for n in ("customer", "lineitem", "orders", "part", "supplier")])


@query
def column_types(t: Tables) -> DataFrame:
    return files.columns_of(t.orders)


# staging


def _klant_consolidated(t: Tables) -> DataFrame:
    existing = t.stored_klant().select("klantnr")
    branches = [b.withColumn("bron", F.lit(i)) for i, b in enumerate(t.klant_sources(), 1)]
    return staging.consolidate(branches, existing, ["klantnr"])


@query
def stage_first_wins(t: Tables) -> DataFrame:
    return _klant_consolidated(t).select("klantnr", "naam", "woonplaats", "bron")


@query
def stage_union_conform(t: Tables) -> DataFrame:
    suppliers, makers = t.leverancier_sources()
    same = ["leveranciernr", "naam", "adres", "woonplaats"]
    conformed = staging.conform(
        makers, {"leveranciernr": "fabrikantnr", "naam": "naam", "adres": "adres", "woonplaats": "plaats"}
    )
    return staging.union_branches([suppliers.select(same), conformed], number="tak")


@query
def stage_align(t: Tables) -> DataFrame:
    target = t.empty("p_partkey bigint, p_name string, p_size bigint, kleur string").schema
    return staging.align(t.part, target)


@query
def stage_reconcile(t: Tables) -> DataFrame:
    delivered = staging.union_branches(t.klant_sources()).select("klantnr")
    before = t.stored_klant().select("klantnr")
    after = before.unionByName(_klant_consolidated(t).select("klantnr"))
    branches = t.filiaal().select("filiaalnr")
    counts = [
        staging.load_counts("Klant", delivered, before, after),
        staging.load_counts("Filiaal", branches, branches.filter("false"), branches),
    ]
    return staging.reconcile(staging.union_branches(counts))


# keys


@query
def bk_natural(t: Tables) -> DataFrame:
    return t.klant_branches().select("source_id", "klantnr", "business_key")


@query
def bk_source(t: Tables) -> DataFrame:
    first, second = t.klant_sources()
    named = lambda df, prefix: df.select("klantnr", C.source_key(prefix, "klantnr").alias("business_key"))
    return staging.union_branches([named(first, "FIETS_VERKOOP_"), named(second, "ACCESSOIRE_VERKOOP_")])


@query
def sk_dense(t: Tables) -> DataFrame:
    return keys.dense_keys(t.orders.select("o_orderkey"), ["o_orderkey"], "order_key", start=100)


@query
def dedupe_first(t: Tables) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey"]
    return keys.first_per_key(t.lineitem.select(*LINE_ID), ["l_orderkey", "l_linenumber"], order)


@query
def dedupe_branches(t: Tables) -> DataFrame:
    kept = keys.first_per_key(t.klant_branches(), ["business_key"], ["source_id", "klantnr"])
    return kept.select("business_key", "source_id", "klantnr", "woonplaats")


# dimensions


def _klant_incoming(t: Tables) -> DataFrame:
    return keys.first_per_key(t.klant_branches(), ["business_key"], ["source_id", "klantnr"])


@query
def scd1_snapshot(t: Tables) -> DataFrame:
    return scd.scd1_merge(t.stored_klant(), _klant_incoming(t), "business_key", KLANT_TRACKED, "klant_key")


@query
def scd1_counts(t: Tables) -> DataFrame:
    classified = scd.classify(t.stored_klant(), _klant_incoming(t), "business_key", KLANT_TRACKED, "klant_key")
    return scd.count_actions(classified)


@query
def scd2_history(t: Tables) -> DataFrame:
    return scd.scd2_merge(t.stored_monteur(), t.monteur(), "business_key", MONTEUR_TRACKED, "monteur_key", RUN_TS)


@query
def scd2_close_missing(t: Tables) -> DataFrame:
    remaining = t.monteur().filter("regio <> 1")
    merged = scd.scd2_merge(
        t.stored_monteur(), remaining, "business_key", MONTEUR_TRACKED, "monteur_key", RUN_TS, close_missing=True
    )
    return merged.select("business_key", "uurloon", "begin_tijd", "eind_tijd")


@query
def scd2_counts(t: Tables) -> DataFrame:
    """Step counters: a changed row counts as an update and as an insert."""
    open_rows = scd.current(t.stored_monteur())
    counts = scd.count_actions(
        scd.classify(open_rows, t.monteur(), "business_key", MONTEUR_TRACKED, "monteur_key")
    )
    before = t.stored_monteur().agg(F.count("*")).scalar()
    return counts.select(
        before.alias("aantal_dwh_voor"),
        (F.col("aantal_insert") + F.col("aantal_update")).alias("aantal_insert"),
        "aantal_update",
        F.col("aantal_skip").alias("aantal_skipped"),
        (before + F.col("aantal_insert") + F.col("aantal_update")).alias("aantal_dwh_na"),
    )


def _versions(t: Tables) -> DataFrame:
    return t.stored_monteur().drop("begin_tijd", "eind_tijd")


@query
def scd2_append_only(t: Tables) -> DataFrame:
    return scd.scd2_append(_versions(t), t.monteur(), "business_key", MONTEUR_TRACKED, "monteur_key")


@query
def scd2_first_load(t: Tables) -> DataFrame:
    loaded = scd.scd2_initial(t.filiaal(), "business_key", "filiaal_key", RUN_TS)
    return loaded.select("filiaal_key", "business_key", "provincie", "begin_tijd", "eind_tijd")


@query
def current_by_max(t: Tables) -> DataFrame:
    return scd.current_by_max(_versions(t), ["business_key"], "monteur_key").select(
        "business_key", "monteur_key", "uurloon"
    )


@query
def current_open(t: Tables) -> DataFrame:
    return scd.current(t.stored_monteur()).select("business_key", "monteur_key", "uurloon")


@query
def version_history(t: Tables) -> DataFrame:
    return scd.history_of(t.stored_monteur(), "business_key", "monteur_key")


@query
def dim_insert_only(t: Tables) -> DataFrame:
    stored = t.stored_klant().select("klant_key", "business_key", "klantnr", "naam")
    return scd.insert_only(stored, _klant_incoming(t), "business_key", "klant_key")


@query
def dim_date(t: Tables) -> DataFrame:
    stored = t.empty("datum_key bigint")
    return dims.date_dim([(t.orders, "o_orderdate"), (t.lineitem, "l_shipdate"), (t.events, "ts")], stored)


@query
def dim_period(t: Tables) -> DataFrame:
    return facts.periods(t)


# facts


@query
def fact_sales(t: Tables) -> DataFrame:
    return facts.fact_sales(t)


@query
def fact_purchase(t: Tables) -> DataFrame:
    return facts.fact_purchase(t)


@query
def fact_maintenance(t: Tables) -> DataFrame:
    return facts.fact_maintenance(t)


@query
def fact_rejects(t: Tables) -> DataFrame:
    missed = fact_ops.rejects(facts.sales_with_keys(t), facts.SALES_KEYS)
    return missed.groupBy("source_id").agg(F.count("*").alias("aantal_skipped"))


@query
def fact_optional_fk(t: Tables) -> DataFrame:
    required = [k for k in facts.SALES_KEYS if k != "monteur_key"]
    loaded = facts.fact_sales(t, required)
    return loaded.groupBy("source_id").agg(
        F.count("*").alias("rijen"), F.count(F.when(F.col("monteur_key").isNull(), 1)).alias("zonder_monteur")
    )


@query
def fact_increment(t: Tables) -> DataFrame:
    loaded = t.lineitem.filter(F.col("l_shipdate") < "1999-01-01").select(
        F.when(F.col("l_linestatus") == "O", 1).otherwise(2).alias("source_id"), *LINE_ID
    )
    return fact_ops.new_rows(facts.fact_purchase(t), loaded, facts.GRAIN)


@query
def fact_known_dates(t: Tables) -> DataFrame:
    known = dims.date_dim([(t.orders.filter("o_orderstatus = 'F'"), "o_orderdate")], t.empty("datum_key bigint"))
    kept = fact_ops.known_dates(t.lineitem.select(*LINE_ID, D.day_key("l_shipdate").alias("datum_key")), known)
    return kept.groupBy("datum_key").agg(F.count("*").alias("rijen"))


@query
def measures(t: Tables) -> DataFrame:
    """Turnover per day of sale."""
    sold = fact_ops.sales_measures(facts.fact_sales(t))
    return sold.groupBy("source_id", "datum_key").agg(F.round(F.sum("omzet"), 2).alias("omzet"))


@query
def measures_purchase(t: Tables) -> DataFrame:
    bought = fact_ops.purchase_measures(facts.fact_purchase(t))
    return bought.groupBy("periode_key").agg(F.round(F.sum("inkoopwaarde"), 2).alias("inkoopwaarde"))


@query
def measures_maintenance(t: Tables) -> DataFrame:
    visits = fact_ops.maintenance_measures(facts.fact_maintenance(t))
    return visits.select("onderhoudnr", F.round("duur", 6).alias("duur"), F.round("kosten", 6).alias("kosten"))


# quality


@query
def missing_keys(t: Tables) -> DataFrame:
    show = ["onderhoudnr", "product_bk", "monteur_bk", "filiaal_bk"]
    missing = quality.missing_keys(facts.maintenance_with_keys(t, named=True), facts.MAINTENANCE_KEYS, show)
    return missing.select(*show, *[F.col(k).cast("double").alias(k) for k in facts.MAINTENANCE_KEYS])


@query
def final_counts(t: Tables) -> DataFrame:
    return quality.final_counts({
        "Klant": t.dim_klant(), "Product": t.dim_product(), "Monteur": t.dim_monteur(), "Filiaal": t.dim_filiaal(),
        "Leverancier": t.dim_leverancier(), "InkoopPeriode": facts.periods(t),
        "Onderhoud": facts.fact_maintenance(t), "Leeg": t.part.filter("p_size < 0"),
    })


@query
def key_violations(t: Tables) -> DataFrame:
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query
def fk_orphans(t: Tables) -> DataFrame:
    return quality.orphans(t.events.select("event_id", "user_id"), "user_id", t.supplier, "s_suppkey")


# frames and scalar functions


@query
def contact_details(t: Tables) -> DataFrame:
    """Two projections of the staff side by side, with constant and mapped columns."""
    phones = t.customer.select(F.col("c_custkey").alias("staff"), F.col("c_nationkey").alias("extension"))
    mails = t.customer.select(F.col("c_custkey").alias("staff"), F.concat("c_name", F.lit("@shop")).alias("email"))
    both = frames.side_by_side([phones, mails], "staff")
    languages = {i: "FR" if i < 15 else "DE" for i in range(25)}
    spoken = frames.add_listed(both.withColumn("first_language", F.lit("EN")), "extension", "second_language", languages, "string")
    return spoken.select("staff", "extension", "email", "first_language", "second_language")


@query
def staff_changes(t: Tables) -> DataFrame:
    """Appended and dropped rows, a replaced value, a renamed and a dropped column, numbers from text."""
    staff = t.customer.select(
        F.col("c_custkey").alias("staff"), F.col("c_name").alias("last_name"),
        F.col("c_mktsegment").alias("position_en"), F.nullif(F.col("c_nationkey").cast("string"), F.lit("7")).alias("extension"),
        F.col("c_acctbal").alias("fax"),
    )
    more = frames.append_row(staff, staff=-1, last_name="New", position_en="BUILDING", extension="n/a")
    kept = frames.drop_rows(more, "staff", [98, 99, 100]).drop("fax")
    return kept.select(
        "staff", C.full_name("position_en", "last_name").alias("full_name"),
        C.replace_value("position_en", "MACHINERY", "General Manager").alias("position"),
        (C.to_number("extension") + 1).alias("extension"),
        C.map_values("position_en", {"BUILDING": 1, "FURNITURE": 0}).cast("double").alias("flag"),
    )


@query
def numeric_profile(t: Tables) -> DataFrame:
    """Minimum and maximum of every column chosen by type."""
    line = t.lineitem
    pick = frames.numeric_columns(line)
    cells = F.array(*[
        F.struct(F.lit(c).alias("kolom"), F.col(c).cast("double").alias("waarde")) for c in pick
    ])
    return line.select(F.explode(cells).alias("cell")).groupBy("cell.kolom").agg(
        F.min("cell.waarde").alias("laagste"), F.max("cell.waarde").alias("hoogste")
    )


@query
def date_parts(t: Tables) -> DataFrame:
    """Parts and keys of dates given as text, a few of them no dates."""
    raw = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")).when(
        F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    ).otherwise("onbekend")
    day = t.orders.select("o_orderkey", raw.alias("datum")).select("o_orderkey", D.parse_day("datum").alias("dag"))
    part = lambda c: c.cast("double")
    return day.select(
        "o_orderkey", part(D.day_key("dag")).alias("datum_key"), part(F.year("dag")).alias("jaar"),
        part(F.quarter("dag")).alias("kwartaal"), part(F.month("dag")).alias("maand"),
        part(F.weekofyear("dag")).alias("week"), part(F.dayofmonth("dag")).alias("dagnr"),
    )


@query
def pattern_dates(t: Tables) -> DataFrame:
    written = t.orders.select("o_orderkey", F.date_format("o_orderdate", "d-M-yyyy").alias("tekst"))
    return written.select(
        "o_orderkey", D.years_since(D.pattern_day("tekst"), 2026).cast("int").alias("jaren")
    )


# features


def _lines(t: Tables) -> DataFrame:
    """Lines with gaps where the discount is high, marked train or test by order."""
    gap = F.when(F.col("l_discount") < 0.09, F.col("l_quantity"))
    flag = F.when(F.col("l_tax") < 0.07, F.col("l_returnflag"))
    lines = t.lineitem.select(*LINE_ID, gap.alias("quantity"), flag.alias("flag"), "l_extendedprice", "l_linestatus", "l_tax")
    return features.split_hash(lines, ["l_orderkey"])


@query
def split_hash(t: Tables) -> DataFrame:
    return features.split_hash(t.orders.select("o_orderkey"), ["o_orderkey"])


@query
def impute_median(t: Tables) -> DataFrame:
    lines = _lines(t)
    medians = features.fit_medians(lines.filter("NOT is_test"), ["quantity", "l_extendedprice"])
    filled = features.impute_medians(lines, {"quantity": medians["quantity"]})
    return filled.select(*LINE_ID, "quantity", F.lit(medians["l_extendedprice"]).alias("median_price"))


@query
def impute_mode(t: Tables) -> DataFrame:
    lines = _lines(t)
    return features.impute(lines, features.fit_modes(lines.filter("NOT is_test"), ["flag"])).select(*LINE_ID, "flag")


@query
def scale_std(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", F.col("p_size").cast("double").alias("size"), "p_retailprice", F.lit(3.0).alias("flat"))
    scaled = features.scale(parts, features.fit_scaler(parts, ["size", "p_retailprice", "flat"]))
    return scaled.select("p_partkey", *[F.round(c, 4).alias(c) for c in ("size", "p_retailprice", "flat")])


@query
def onehot_unseen(t: Tables) -> DataFrame:
    """Levels learned without one type, which then encodes to zeros."""
    levels = features.fit_levels(t.part.filter("p_type <> 'PROMO'"), ["p_type"])
    coded = features.onehot(t.part.select("p_partkey", "p_type"), levels)
    return coded.select("p_partkey", *[F.col(f"`p_type={v}`").cast("int").alias(v.lower()) for v in levels["p_type"]])


@query
def dummies(t: Tables) -> DataFrame:
    levels = features.fit_levels(t.part, ["p_type"])
    coded = features.onehot(t.part.select("p_partkey", "p_type"), levels, drop_first=True)
    return coded.select("p_partkey", *[F.col(f"`p_type={v}`").cast("int").alias(v.lower()) for v in levels["p_type"][1:]])


@query
def class_weights(t: Tables) -> DataFrame:
    weights = features.class_weights(t.lineitem, "l_returnflag")
    return weights.select("l_returnflag", "aantal", F.round("gewicht", 6).alias("gewicht"))


# metrics, on predictions given by a rule


def _priced(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 2000 + 1000).alias("p"))


def _flags(t: Tables) -> DataFrame:
    rule = F.when(F.col("l_quantity") < 15, "A").when(F.col("l_quantity") < 30, "N").otherwise("R")
    return t.lineitem.select(F.col("l_returnflag").alias("y"), rule.alias("p"))


def _binary(t: Tables) -> DataFrame:
    late = F.when(F.col("l_shipdate") >= F.lit("1998-06-01").cast("timestamp"), 1).otherwise(0)
    return t.lineitem.select(F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("y"), late.alias("p"))


@query
def reg_metrics(t: Tables) -> DataFrame:
    found = metrics.regression_metrics(_priced(t), "y", "p")
    return found.select(F.round("mae", 2).alias("mae"), F.round("mse", 0).alias("mse"), F.round("rmse", 2).alias("rmse"), F.round("r2", 6).alias("r2"))


@query
def reg_bounds(t: Tables) -> DataFrame:
    return metrics.predicted_bounds(_priced(t), "y", "p")


@query
def cls_metrics(t: Tables) -> DataFrame:
    found = metrics.binary_metrics(metrics.pair_counts(_binary(t), "y", "p"))
    return found.select([F.round(c, 6).alias(c) for c in found.columns])


@query
def cls_weighted(t: Tables) -> DataFrame:
    found = metrics.weighted_metrics(metrics.pair_counts(_flags(t), "y", "p"))
    return found.select([F.round(c, 6).alias(c) for c in found.columns])


@query
def confusion(t: Tables) -> DataFrame:
    return metrics.confusion_matrix(metrics.pair_counts(_flags(t), "y", "p"), ["A", "N", "R"])


@query
def cluster_sizes(t: Tables) -> DataFrame:
    return metrics.cluster_sizes(t.embeddings, "label")


@query
def nearest_mean(t: Tables) -> DataFrame:
    return clustering.nearest_mean(t.embeddings, "vec_id", "embedding", "label")


@query
def silhouette_small(t: Tables) -> DataFrame:
    scored = silhouette.silhouette_exact(t.embeddings, "vec_id", "embedding", "label")
    return scored.select("id", "cluster", F.round("silhouette", 6).alias("silhouette")).orderBy("cluster", "silhouette")


@query
def silhouette_mean(t: Tables) -> DataFrame:
    scored = silhouette.mean_silhouette(silhouette.silhouette_exact(t.embeddings, "vec_id", "embedding", "label"))
    return scored.select(F.round("silhouette", 6).alias("silhouette"))


@query
def silhouette_linear(t: Tables) -> DataFrame:
    scored = silhouette.silhouette_squared(t.embeddings, "vec_id", "embedding", "label")
    return scored.select("id", "cluster", F.round("silhouette", 6).alias("silhouette"))


# experiments


@query
def reg_grid(t: Tables) -> DataFrame:
    return grids.regression_grid(grids.profile(t), grids.REGRESSION_GRID)


@query
def reg_optimum(t: Tables) -> DataFrame:
    return grids.optimum_coefficients(grids.profile(t), grids.REGRESSION_GRID[4])


@query
def reg_line(t: Tables) -> DataFrame:
    found = grids.line_fit(t.lineitem, "l_quantity", "l_extendedprice")
    return found.select(F.round("intercept", 4).alias("intercept"), F.round("slope", 4).alias("slope"))


@query
def reg_rows(t: Tables) -> DataFrame:
    """Actual and predicted price of every line."""
    found = grids.line_rows(t.lineitem, "l_quantity", "l_extendedprice", "l_orderkey", "l_linenumber")
    return found.select("l_orderkey", "l_linenumber", "actual", F.round("predicted", 2).alias("predicted"), F.round("residual", 2).alias("residual"))


@query
def ridge_levels(t: Tables) -> DataFrame:
    """Price by part: as many levels as parts, an intercept without penalty."""
    with scratch(t.spark) as keep:
        lines = t.lineitem.select("l_partkey", "l_extendedprice")
        levels = sparse.fit_levels(lines, [], ["l_partkey"], keep)
        encoded = keep(sparse.encode(lines, [], ["l_partkey"], levels, "l_extendedprice"))
        found = sparse.ridge(encoded, "l_extendedprice", levels, RIDGE, keep)
        return stage(found.select("feature", "value", F.round("coefficient", 2).alias("coefficient")))


@query
def ridge_pair(t: Tables) -> DataFrame:
    """Price by two numbers and an intercept."""
    with scratch(t.spark) as keep:
        lines = t.lineitem.select("l_quantity", "l_discount", "l_extendedprice")
        levels = sparse.fit_levels(lines, ["l_quantity", "l_discount"], [], keep)
        encoded = sparse.encode(lines, ["l_quantity", "l_discount"], [], levels, "l_extendedprice")
        found = sparse.ridge(keep(encoded), "l_extendedprice", levels, RIDGE, keep)
        return stage(found.select("feature", F.round("coefficient", 2).alias("coefficient")))


@query
def descent_steps(t: Tables) -> DataFrame:
    """Ten steps of each learning-rate schedule on the line of price by quantity."""
    x, y = F.col("l_quantity") / 50, F.col("l_extendedprice") / 50000
    sums = t.lineitem.agg(F.avg(x).alias("mx"), F.avg(x * x).alias("mxx"), F.avg(y).alias("my"), F.avg(x * y).alias("mxy"), F.avg(y * y).alias("myy"))
    found = regression.descent_steps(stage(sums), 10)
    return found.select("schedule", "step", *[F.round(c, 6).alias(c) for c in ("eta", "w0", "w1", "loss")])


# fixed values: strength of the ridge queries, starting centres of the Lloyd steps
RIDGE = 0.01
CENTRES = ((10.3, 0.2), (25.1, 5.4), (40.7, 10.1))


# fixed values: runs of two levels, by either criterion, with and without least sizes
SPLIT_FEATURES = ("l_quantity", "l_discount", "l_tax")
SPLIT_RUNS = (
    TreeConfig("gini", SPLIT_FEATURES, 2), TreeConfig("entropy", SPLIT_FEATURES, 2, criterion="entropy"),
    TreeConfig("gini, leaf 400", SPLIT_FEATURES, 2, min_samples_leaf=400), TreeConfig("entropy, split 3000", SPLIT_FEATURES, 2, 3000, 25, "entropy"),
    TreeConfig("two features", ("l_discount", "l_tax"), 1),
)


@query
def tree_splits(t: Tables) -> DataFrame:
    """Nodes of exact trees on the return flag of the lines."""
    with scratch(t.spark) as keep:
        lines = t.lineitem.select(*SPLIT_FEATURES, "l_returnflag")
        found = growth.grow(lines, SPLIT_FEATURES, "l_returnflag", SPLIT_RUNS, keep)
        rounded = [F.round(c, 6).alias(c) for c in ("impurity", "threshold", "gain")]
        return stage(found.select("run", "node", "rows", "label", "feature", *rounded))


@query
def lloyd_steps(t: Tables) -> DataFrame:
    """Three steps from stated centres: the centres and the sum of squared distances before each."""
    points = t.lineitem.select("l_quantity", (F.col("l_discount") * 100).alias("discount"))
    rows = [
        (step, k, float(c[0]), float(c[1]), state.inertia)
        for step, state in enumerate(clustering.lloyd(points, ["l_quantity", "discount"], np.array(CENTRES), 3)) for k, c in enumerate(state.centres)
    ]
    found = t.spark.createDataFrame(rows, "step int, cluster int, quantity double, discount double, inertia double")
    return found.select("step", "cluster", *[F.round(c, 4).alias(c) for c in ("quantity", "discount")], F.round("inertia", 2).alias("inertia"))


@query
def pca_pair(t: Tables) -> DataFrame:
    """Parts on the two components of size and price."""
    found = clustering.principal_components(t.part, "p_partkey", ["p_size", "p_retailprice"])
    return found.select("p_partkey", *[(F.round(c, 4) + 0.0).alias(c) for c in ("pc1", "pc2")])


@query
def preprocessed_rows(t: Tables) -> DataFrame:
    """Lines prepared with parameters that were fitted on the training lines, stored, and read back; the tax passes through."""
    lines = _lines(t)
    fitted = features.fit_preprocessing(lines.filter("NOT is_test"), ["quantity", "l_extendedprice"], ["flag"])
    ready = features.Prepared.read(stage(fitted.table(t.spark)))
    found = ready.transform(lines, [*LINE_ID, "l_tax"])
    flags = [F.col(f"`flag={v}`").cast("int").alias(f"flag_{v.lower()}") for v in ready.levels["flag"]]
    return found.select(*LINE_ID, "l_tax", *[(F.round(c, 4) + 0.0).alias(n) for c, n in (("quantity", "quantity"), ("l_extendedprice", "price"))], *flags)


@query
def ranked_results(t: Tables) -> DataFrame:
    """Two result sets as one ranking by error, best first, with places."""
    score = lambda name, slope, base: metrics.regression_metrics(
        t.lineitem.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * slope + base).alias("p")), "y", "p"
    ).select(F.lit(name).alias("experiment"), F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"))
    first = score("steep", 2000, 1000).unionByName(score("flat", 500, 30000))
    second = score("middle", 1500, 0).unionByName(score("level", 0, 38000))
    both = grids.combine([first, second], "rmse")
    return both.withColumn("place", F.row_number().over(Window.orderBy("rmse", "experiment")).cast("long"))


@query
def best_result(t: Tables) -> DataFrame:
    return grids.best(ranked_results(t).drop("place"), "rmse")


# files


SHEET = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


@query
def sheet_rejects(t: Tables) -> DataFrame:
    """Orders saved as a sheet with damaged lines, read back: rows and amounts of good lines, number of rejected ones."""
    price = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("EUR "), F.col("o_totalprice").cast("string"))).otherwise(F.col("o_totalprice").cast("string"))
    fields = ["o_orderkey", "o_custkey", "o_orderstatus", price, F.concat(F.lit('"'), F.replace("o_orderpriority", F.lit("-"), F.lit(', ""')), F.lit('"""'))]
    line = F.concat_ws(",", *[F.col(f).cast("string") if isinstance(f, str) else f for f in fields])
    # urgent orders lose their last fields
    line = F.when(F.col("o_orderpriority").startswith("1"), F.substring_index(line, ",", 3)).otherwise(line)
    folder = f"{shared_dir(t.spark)}/sheet-{uuid.uuid4().hex}"
    names = ",".join(f.split()[0] for f in SHEET.split(", "))

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one header a file, as a spreadsheet program writes it
        for number, batch in enumerate(batches):
            if not number:
                yield pa.RecordBatch.from_arrays([pa.array([names], batch.schema.field(0).type)], schema=batch.schema)
            yield batch

    t.orders.select(line.alias("value")).mapInArrow(headed, "value string").write.text(folder)
    good, rejected = files.read_sheet_checked(t.spark, folder, T._parse_datatype_string(SHEET))
    first = F.regexp_extract("text", "^[0-9]+", 0).cast("long")
    found = good.agg(
        F.lit("good").alias("kind"), F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("amount"),
        F.count(F.when(F.col("o_orderpriority").rlike('^[0-9], "[A-Z ]+"$'), 1)).alias("quoted"),
    ).unionByName(rejected.agg(
        F.lit("rejected").alias("kind"), F.count("*").alias("n"), F.sum(first).alias("keys"), F.lit(None).cast("double").alias("amount"),
        F.lit(0).cast("long").alias("quoted"),
    ))
    out = stage(found)
    files.delete(t.spark, folder)
    return out


@query
def mixed_logs(t: Tables) -> DataFrame:
    """Log files of all three layouts in one folder, the staging and warehouse log in one file with a header between."""
    return sample_loads.mixed_logs(t)


@query
def tree_leak(t: Tables) -> DataFrame:
    return grids.leak_check(grids.profile(t))


@query
def tree_grid(t: Tables) -> DataFrame:
    return grids.tree_grid(grids.profile(t), grids.TREE_GRID)


@query
def tree_confusion(t: Tables) -> DataFrame:
    """Test counts of the run with the wider minimum split, and of its cousin."""
    chosen = [g for g in grids.TREE_GRID if g.name in ("exp 7", "exp 8")]
    return grids.tree_confusions(grids.profile(t), chosen)


@query
def kmeans_grid(t: Tables) -> DataFrame:
    return grids.cluster_grid(grids.profile(t), grids.CLUSTER_GRID)


@query
def elbow(t: Tables) -> DataFrame:
    return grids.elbow(grids.profile(t))


@query
def pca2(t: Tables) -> DataFrame:
    return grids.cluster_plane(grids.profile(t))


@query
def best_run(t: Tables) -> DataFrame:
    return grids.best(grids.regression_grid(grids.profile(t), grids.REGRESSION_GRID), "rmse")


# the loads themselves, run twice

for load_query in (
    sample_loads.star_sales, sample_loads.star_purchase, sample_loads.star_maintenance, sample_loads.star_workers,
    sample_loads.star_log, sample_loads.staging_log, sample_loads.star_refresh_sales, sample_loads.star_refresh_log,
    sample_loads.star_source_sales, sample_loads.star_failed_log,
):
    query(load_query)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    bind = lambda fn: lambda spark, folder: fn(Tables(spark, folder))
    return {name: bind(fn) for name, fn in QUERIES.items()}
