from __future__ import annotations

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from shop import shop, write_shop

from starling.operators.quality import Step, run_graph
from starling.plans.staging_load import load_staging, load_unified
from starling.plans.warehouse_load import WarehouseLoad
from starling.schemas import STAGING, STAR, UNIFIED
from starling.sources.runlog import NOTEBOOK_COLUMNS, STAGING_COLUMNS, WAREHOUSE_COLUMNS, read_log
from starling.sources.store import Conflict, Store

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def steps(log, step):
    return {r["tabel"]: r for r in log.rows if r["stap"].startswith(step)}


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def load(spark, data, root, moment, **options):
    folders = write_shop(spark, data, f"{root}/src-{moment:%d}")
    staging = Store(spark, f"{root}/staging", STAGING)
    staged = load_staging(spark, folders, staging, moment)
    star = Store(spark, f"{root}/star", STAR)
    return staged, star, WarehouseLoad(spark, staging, star, moment, **options).run()


def test_incremental_runs(spark, tmp_path):
    root = str(tmp_path)
    data = shop()
    staged, star, log = load(spark, data, root, T1)
    assert {r["status"] for r in staged.rows} == {"OK"}
    assert [r["status"] for r in log.rows if r["stap"] != "EINDCONTROLE"] == ["OK"] * 12
    assert rows(star.read("Klant"), "business_key", "source_id") == [
        ("Jan Jansen_1990-01-01", 1), ("None_1991-02-02", 1), ("Piet_None", 2)]
    klant = steps(log, "SCD1")["Klant"]
    assert (klant["aantal_sdm"], klant["aantal_insert"], klant["aantal_skipped"]) == (4, 3, 0)
    datum = steps(log, "DIM")["Datum"]
    assert (datum["aantal_sdm"], datum["aantal_insert"], datum["aantal_dwh_na"]) == (9, 6, 6)
    verkoop = steps(log, "FACT")["Verkoop"]
    # seven sales, one without worker never extracted, two rejected
    assert (verkoop["aantal_sdm"], verkoop["aantal_insert"], verkoop["aantal_skipped"]) == (6, 4, 2)
    # the maintenance-only bike is unknown to the product dimension
    assert steps(log, "FACT")["Onderhoud"]["aantal_skipped"] == 1
    assert rows(star.read("InkoopPeriode"), "periode_key", "inkoopmaand", "inkoopjaar") == [(1, 1, 2023), (2, 2, 2023)]
    assert rows(star.read("Verkoop"), "verkoop_key") == [(1,), (2,), (3,), (4,)]

    # second run: a moved customer, a raised wage, a new sale
    first_key = {r.business_key: r.klant_key for r in star.read("Klant").collect()}
    data["Fiets_Verkoop"]["Klant"][0] = (1, "Jan Jansen", "Laan 1", "Leidschendam", "M", "1990-01-01")
    data["Accessoire_Verkoop"]["Klant"][0] = data["Fiets_Verkoop"]["Klant"][0]
    for source in ("Fiets_Verkoop", "Accessoire_Verkoop", "Onderhoud"):
        data[source]["Monteur"][0] = (1, "Tom", "Delft", 219.5, 1)
    data["Fiets_Verkoop"]["Fiets_Verkoop"].append((9999, "2024-01-01", 1, 500.0, 1, 1, 1))
    _, star, log = load(spark, data, root, T2)
    klant = steps(log, "SCD1")["Klant"]
    assert (klant["aantal_insert"], klant["aantal_update"], klant["aantal_skipped"]) == (0, 1, 2)
    moved = star.read("Klant").filter("woonplaats = 'Leidschendam'").collect()
    assert len(moved) == 1 and moved[0].klant_key == first_key["Jan Jansen_1990-01-01"]
    monteur = steps(log, "SCD2")["Monteur"]
    assert (monteur["aantal_insert"], monteur["aantal_update"], monteur["aantal_skipped"]) == (1, 1, 1)
    tom = star.read("Monteur").filter("business_key = 'Tom_Delft'").orderBy("monteur_key").collect()
    assert [(v.uurloon, v.begin_tijd, v.eind_tijd) for v in tom] == [(19.5, T1, T2), (219.5, T2, None)]
    assert steps(log, "FACT")["Verkoop"]["aantal_insert"] == 1
    sale = star.read("Verkoop").filter("verkoopnr = 9999").collect()
    assert [(s.source_id, s.datum_key, s.monteur_key, s.verkoop_key) for s in sale] == [(1, 20240101, tom[1].monteur_key, 5)]

    # third run: nothing new
    _, star, log = load(spark, data, root, T3)
    assert all(r["aantal_insert"] == r["aantal_update"] == 0 for r in log.rows)


def test_refresh_with_source_keys(spark, tmp_path):
    _, star, log = load(spark, shop(), str(tmp_path), T1, mode="refresh", keys="source")
    assert star.count("Klant") == 4 and star.count("Monteur") == 4 and star.count("Product") == 7
    assert steps(log, "FACT")["Onderhoud"]["aantal_insert"] == 2
    assert rows(star.read("Inkoop"), "source_id", "inkoopnr") == [(1, 1), (2, 1), (2, 2)]
    datum = steps(log, "DIM")["Datum"]
    assert datum["aantal_sdm"] == datum["aantal_insert"] + datum["aantal_skipped"]
    before = star.count("Verkoop")
    _, star, log = load(spark, shop(), str(tmp_path), T2, mode="refresh", keys="source")
    assert star.count("Verkoop") == before and star.read("Monteur").filter("eind_tijd IS NOT NULL").count() == 0


def test_failed_steps_are_isolated(spark, tmp_path):
    data = shop()
    del data["Fiets_Inkoop"]
    del data["Accessoire_Verkoop"]["Klant"]
    staged, star, log = load(spark, data, str(tmp_path), T1)
    errors = [(r["stap"], r["doel_tabel"]) for r in staged.rows if r["status"] == "ERROR"]
    assert errors == [("CONNECT", ""), ("EXTRACT", "Accessoire_Verkoop_Klant")]
    failed = {r["tabel"]: r["aantal_error"] for r in log.rows if r["status"] == "ERROR"}
    assert set(failed) == {"Klant", "Product", "Leverancier", "InkoopPeriode"}
    assert set(failed.values()) == {1}
    # facts that need a failed dimension are not loaded against what it left
    skipped = {r["tabel"]: r["melding"] for r in log.rows if r["status"] == "SKIPPED"}
    assert set(skipped) == {"Verkoop", "Onderhoud", "Inkoop"} and skipped["Onderhoud"].endswith("Product")
    assert log.rows[-1]["stap"] == "EINDE" and star.count("Monteur") == 2
    assert {r["tabel"] for r in log.rows if r["status"] == "WARNING"} >= {"Klant", "Verkoop", "Inkoop"}


def test_unified_staging_first_source_wins(spark, tmp_path):
    data = shop()
    data["Fiets_Verkoop"]["Filiaal"][0] = (1, "Anders", "Plein 1", "ZH")
    folders = write_shop(spark, data, f"{tmp_path}/src")
    store = Store(spark, f"{tmp_path}/unified", UNIFIED)
    load_unified(spark, folders, store, T1)
    assert rows(store.read("Filiaal"), "filiaalnr", "naam") == [(1, "Noord"), (2, "Zuid")]
    assert rows(store.read("Klant"), "klantnr") == [(1,), (2,), (3,)]
    again = load_unified(spark, folders, store, T2)
    assert all(r["aantal_verwerkt"] == 0 for r in again.rows)


def test_log_round_trip(spark, tmp_path):
    from starling.sources.runlog import RunLog

    log = RunLog("DWH", WAREHOUSE_COLUMNS, T1)
    log.add("SCD1", "ERROR", 'failed on "x"\n  no such table, sorry', tabel="Klant", aantal_error=1)
    log.add("FACT", tabel="Verkoop", aantal_insert=5)
    log.write(spark, f"{tmp_path}/log")
    log.write(spark, f"{tmp_path}/log")
    back = read_log(spark, f"{tmp_path}/log", WAREHOUSE_COLUMNS).collect()
    assert len(back) == 4
    assert {r.melding for r in back if r.stap == "SCD1"} == {'failed on "x"\n  no such table, sorry'}
    short = RunLog("DWH", NOTEBOOK_COLUMNS, T1)
    short.add("TEST", melding="sale added", tabel="Verkoop", actie="insert", aantal=1)
    assert short.frame(spark).collect() == [("2024-01-01 00:00:00", "TEST", "Verkoop", "insert", 1, "OK", "sale added")]
    header = ",".join(STAGING_COLUMNS)
    line = "r,2024-01-01 00:00:00,SDM,LOAD,a,b,c,insert,1,2,3,4,OK,x"
    (tmp_path / "two.csv").write_text(f"{header}\n{line}\n{header}\n{line}\n")
    assert [r.aantal_doel_na for r in read_log(spark, f"{tmp_path}/two.csv", STAGING_COLUMNS).collect()] == [4, 4]


def test_store_ignores_unfinished_loads(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"Datum": STAR["Datum"]})
    row = lambda k: spark.createDataFrame([(k, "2024-01-01", 1, 1, 1, 2024)], STAR["Datum"])
    assert store.count("Datum") == 0 and not store.exists("Datum") and store.tables() == []
    store.publish("Datum", row(1), "a")
    store.append("Datum", row(2), "b")
    assert rows(store.read("Datum"), "datum_key") == [(1,), (2,)]
    unfinished = tmp_path / "Datum" / "v00000002" / "load-c"
    unfinished.mkdir(parents=True)
    (unfinished / "part-0.parquet").write_bytes(b"half")
    assert store.count("Datum") == 2
    store.publish("Datum", row(3), "d")
    assert rows(store.read("Datum"), "datum_key") == [(3,)]
    with pytest.raises(ValueError):
        store.append("Datum", row(4), "d")
    with pytest.raises(ValueError):
        store.publish("Datum", row(4).drop("jaar"), "e")
    store.publish("Datum", row(5), "f")
    store.vacuum("Datum", keep=1)
    assert store.tables() == ["Datum"] and rows(store.read("Datum"), "datum_key") == [(5,)]


def owners(star):
    """Sales with the business keys that their surrogate keys point at."""
    sold = star.read("Verkoop").join(star.read("Klant"), "klant_key").join(star.read("Product"), "product_key")
    return rows(sold.selectExpr("verkoopnr", "coalesce(naam, '')", "productnr"), "*")


def test_failed_refresh_publishes_nothing(spark, tmp_path, monkeypatch):
    root, data = str(tmp_path), shop()
    _, star, log = load(spark, data, root, T1, mode="refresh")
    assert not [r for r in log.rows if r["status"] == "ERROR"]
    before, counts = owners(star), {t: star.count(t) for t in star.schemas}
    assert before
    for i in range(10):
        data["Fiets_Verkoop"]["Klant"].append((100 + i, f"Aaa {i}", "Laan 1", "Delft", "M", "1980-01-01"))

    def fail(self, stage):
        raise RuntimeError("sales are broken")

    with monkeypatch.context() as patch:
        patch.setattr(WarehouseLoad, "verkoop", fail)
        _, star, log = load(spark, data, root, T2, mode="refresh")
    assert [r["stap"] for r in log.rows if r["status"] == "ERROR"] == ["FACT", "PUBLISH"]
    assert owners(star) == before and {t: star.count(t) for t in star.schemas} == counts
    _, star, log = load(spark, data, root, T3, mode="refresh")
    assert owners(star) == before and star.count("Klant") == counts["Klant"] + 10


def test_unchanged_run_writes_no_table(spark, tmp_path):
    root, data = str(tmp_path), shop()
    load(spark, data, root, T1)
    files = lambda: sorted(str(p) for p in (tmp_path / "star").rglob("*.parquet"))
    first = files()
    load(spark, data, root, T2)
    assert files() == first


def test_unified_staging_waits_for_a_missing_source(spark, tmp_path):
    folders = write_shop(spark, shop(), f"{tmp_path}/src")
    part = {k: v for k, v in folders.items() if k != "Accessoire_Verkoop"}
    store = Store(spark, f"{tmp_path}/unified", UNIFIED)
    log = load_unified(spark, part, store, T1)
    missing = {r["doel_tabel"] for r in log.rows if r["stap"] == "EXTRACT" and r["status"] == "ERROR"}
    assert "Klant" in missing and store.count("Klant") == 0
    load_unified(spark, part, store, T1, allow_missing=True)
    assert store.count("Klant") > 0


def numbers(spark, first, count, step=1):
    return spark.range(first, first + count * step, step).selectExpr("id AS k", "cast(id AS string) AS name")


NUMBERS = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])


@pytest.mark.parametrize("kind", ["publish", "append"])
def test_of_two_runs_from_one_version_one_wins(spark, tmp_path, kind):
    """Both have read version 1 and written their rows before either commits."""
    Store(spark, str(tmp_path), {"N": NUMBERS}).publish("N", numbers(spark, 0, 3), "base")
    stores, both = [Store(spark, str(tmp_path), {"N": NUMBERS}) for _ in range(2)], threading.Barrier(2)

    def write(n):
        store, load = stores[n], stores[n]._load
        assert store.count("N") == 3
        store._load = lambda *a: (load(*a), both.wait())[0]
        try:
            getattr(store, kind)("N", numbers(spark, 10 * (n + 1), 5), f"run{n}")
            return True
        except Conflict:
            return False

    with ThreadPoolExecutor(2) as pool:
        won = list(pool.map(write, range(2)))
    assert sorted(won) == [False, True]
    fresh, winner = Store(spark, str(tmp_path), {"N": NUMBERS}), won.index(True)
    expected = [10 * (winner + 1) + i for i in range(5)] + ([0, 1, 2] if kind == "append" else [])
    assert [r[0] for r in rows(fresh.read("N"), "k")] == sorted(expected) and fresh.count("N") == len(expected)
    assert fresh.highest("N") == max(expected)
    # the loser left nothing behind and, having read the table anew, may try again
    assert len(list((tmp_path / "N").glob("_load=*"))) == 2
    again = Store(spark, str(tmp_path), {"N": NUMBERS})
    again.append("N", numbers(spark, 100, 1), "retry")
    assert again.count("N") == len(expected) + 1


def test_of_two_refreshes_one_becomes_current(spark, tmp_path):
    stores = [Store(spark, str(tmp_path), {"N": NUMBERS}) for _ in range(2)]
    branches = [s.branch("same-id") for s in stores]
    for n, branch in enumerate(branches):
        branch.publish("N", numbers(spark, n, 1), "x")
    stores[1].switch(branches[1])
    with pytest.raises(Conflict):
        stores[0].switch(branches[0])
    assert rows(Store(spark, str(tmp_path), {"N": NUMBERS}).read("N"), "k") == [(1,)]


def test_a_store_reads_one_state_until_it_commits(spark, tmp_path):
    reader, writer = (Store(spark, str(tmp_path), {"N": NUMBERS}) for _ in range(2))
    writer.publish("N", numbers(spark, 0, 2), "a")
    assert reader.count("N") == 2
    writer.append("N", numbers(spark, 5, 2), "b")
    assert reader.count("N") == 2 and writer.count("N") == 4 and Store(spark, str(tmp_path), {"N": NUMBERS}).count("N") == 4


def test_an_increment_reads_the_bands_of_its_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"N": NUMBERS}, {"N": ("k", 100)})
    store.publish("N", numbers(spark, 0, 1000), "a")
    store.append("N", spark.createDataFrame([(None, "none"), (1005, "x")], NUMBERS), "b")
    near = store.near("N", spark.createDataFrame([(520, "new"), (None, "y")], NUMBERS))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(_band#" in plan and "= 5)" in plan
    read = [r[0] for r in near.select(F.input_file_name()).distinct().collect()]
    assert {p.split("_band=")[1].split("/")[0] for p in read} == {"5"}
    assert near.columns == ["k", "name"] and [r.k for r in near.orderBy("k").collect()] == list(range(500, 600))
    assert store.count("N") == 1002 and store.highest("N") == 1005 and store.read("N").count() == 1002
    assert store.near("N", numbers(spark, 5000, 3)).count() == 0


def test_increments_in_bands_equal_increments_of_whole_histories(spark, tmp_path, monkeypatch):
    bands = {"Verkoop": ("verkoopnr", 2), "Inkoop": ("inkoopnr", 1), "Onderhoud": ("onderhoudnr", 1)}
    results = {}
    for name, given in (("plain", None), ("bands", bands)):
        data = shop()
        for moment in (T1, T2):
            folders = write_shop(spark, data, f"{tmp_path}/{name}/src-{moment:%d}")
            staging, star = Store(spark, f"{tmp_path}/{name}/staging", STAGING), Store(spark, f"{tmp_path}/{name}/star", STAR, given)
            load_staging(spark, folders, staging, moment)
            log = WarehouseLoad(spark, staging, star, moment).run()
            # a corrected date is no new sale; a new number is
            data["Fiets_Verkoop"]["Fiets_Verkoop"][0] = (1, "2023-09-09", 1, 500.0, 1, 1, 1)
            data["Fiets_Verkoop"]["Fiets_Verkoop"].append((9999, "2024-01-01", 1, 500.0, 1, 1, 1))
        assert steps(log, "FACT")["Verkoop"]["aantal_insert"] == 1
        results[name] = {t: rows(star.read(t), *STAR[t].names) for t in bands}
    assert results["plain"] == results["bands"]


def test_closed_versions_are_written_once(spark, tmp_path):
    root, data = str(tmp_path), shop()
    closed = lambda: {p for p in (tmp_path / "star" / "Monteur").rglob("*.parquet") if "-closed-" in str(p)}
    wages, seen = [19.5, 30.0, 40.0, 50.0], set()
    for day, wage in enumerate(wages, 1):
        for source in ("Fiets_Verkoop", "Accessoire_Verkoop", "Onderhoud"):
            data[source]["Monteur"][0] = (1, "Tom", "Delft", wage, 1)
        _, star, _ = load(spark, data, root, datetime(2024, 1, day))
        assert seen <= closed()
        seen = closed()
        tom = star.read("Monteur").filter("business_key = 'Tom_Delft'").orderBy("monteur_key").collect()
        assert [v.uurloon for v in tom] == wages[:day] and [v.eind_tijd for v in tom][:-1] == [datetime(2024, 1, d) for d in range(2, day + 1)]
        assert tom[-1].eind_tijd is None and len({v.monteur_key for v in tom}) == day
        assert star.read("Monteur", "open").count() == 2 and star.read("Monteur", "closed").count() == day - 1
    # each closed version stands in one file of one load, and one load holds the closed version of one run
    assert [spark.read.parquet(str(p)).count() for p in sorted(seen)].count(1) == len(wages) - 1


def test_a_half_written_commit_is_no_version(spark, tmp_path):
    store = Store(spark, str(tmp_path), {"N": NUMBERS})
    store.publish("N", numbers(spark, 0, 2), "a")
    (tmp_path / "N" / "_commits" / "00000002").write_text('{"version": 2, "loa')
    fresh = Store(spark, str(tmp_path), {"N": NUMBERS})
    assert fresh.count("N") == 2
    with pytest.raises(Conflict):  # the number is taken; whoever took it may still be writing
        fresh.publish("N", numbers(spark, 0, 1), "b")


def test_steps_run_when_what_they_need_is_done():
    ran, failed, skipped = [], [], {}

    def work(name):
        def run():
            ran.append(name)
            if name == "b":
                raise RuntimeError("broken")
        return run

    needs = {"a": (), "b": (), "c": ("a",), "d": ("a", "b"), "e": ("d", "c"), "f": ("c",)}
    graph = [Step(n, work(n), needs[n]) for n in "fedcba"]
    done = run_graph(graph, 3, lambda s, e: failed.append((s.name, str(e))), lambda s, lost: skipped.update({s.name: lost}))
    assert done == {"a", "c", "f"} and failed == [("b", "broken")] and skipped == {"d": ["b"], "e": ["d"]}
    assert sorted(ran) == ["a", "b", "c", "f"] and ran.index("a") < ran.index("c") < ran.index("f")
    with pytest.raises(ValueError):
        run_graph([Step("a", work("a"), ("b",)), Step("b", work("a"), ("a",))], 2, print, print)
    with pytest.raises(ValueError):
        run_graph([Step("a", work("a"), ("z",))], 2, print, print)
