"""Runs of the staging and warehouse loads over the sample tables.

Orders are sales and purchases of their first and last part, suppliers are workers and
makers, nations are branches, events are workshop visits. Between the runs customers move,
wages rise, and later sales, purchases and visits arrive.

A series of runs is done once per session and folder; its tables stay in the shared folder,
as the results of the queries are read from them.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.operators.quality import run_together
from starling.operators.scd import current
from starling.plans.staging_load import load_staging
from starling.plans.tables import FIRST_SEGMENTS, ONLY_FIRST_SEGMENTS, Tables
from starling.plans.warehouse_load import WarehouseLoad
from starling.schemas import SOURCES, STAGING, STAR, STAR_BANDS
from starling.session import scratch, sent_if_few, shared_dir
from starling.sources.files import CODEC
from starling.sources.runlog import NOTEBOOK_COLUMNS, STAGING_COLUMNS, WAREHOUSE_COLUMNS, read_log, read_mixed_logs
from starling.sources.store import Store

# fixed values: times of the runs, and what the first of them knows
RUNS = (datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3))
FIRST_ORDERS_BEFORE = "1998-01-01"
FIRST_EVENTS_WITHOUT = "error"


def orders_with_lines(t: Tables) -> DataFrame:
    """Orders with what the sales and purchases take from their lines; both systems and all runs share it."""
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("sold"), F.max("l_partkey").alias("bought"), F.min("l_suppkey").alias("monteur"),
        F.sum("l_quantity").cast("long").alias("aantal"), F.max("l_shipdate").alias("last"),
    )
    heads = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return heads.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")


class Sources:
    """The source tables as one run finds them; ``orders`` holds the stored :func:`orders_with_lines`."""

    def __init__(self, t: Tables, first: bool, orders: DataFrame | None = None):
        self.t, self.first = t, first
        self.orders = orders_with_lines(t) if orders is None else orders

    def klant(self, system: str) -> DataFrame:
        segment = F.col("c_mktsegment")
        if system == "Fiets_Verkoop":
            served, town = segment.isin(*FIRST_SEGMENTS), "City "
        else:
            served, town = ~F.coalesce(segment.isin(*ONLY_FIRST_SEGMENTS), F.lit(False)), "Town "
        moved = F.when(F.col("c_acctbal") > 8000, "Old ").otherwise(town)
        return self.t.klant(served, moved if self.first else town)

    def fabrikant(self) -> DataFrame:
        return self.leverancier().withColumnsRenamed({"leveranciernr": "fabrikantnr", "woonplaats": "plaats"})

    def leverancier(self) -> DataFrame:
        return self.t.leverancier_sources()[0]

    def fiets(self) -> DataFrame:
        return self.t.part.select(
            F.col("p_partkey").alias("fietsnr"), F.col("p_type").alias("soort"), F.col("p_brand").alias("merk"),
            F.col("p_name").alias("type"), F.col("p_retailprice").alias("standaardprijs"),
            F.col("p_retailprice").alias("inkoopprijs"), F.lit(None).cast("string").alias("kleur"),
            F.col("p_size").cast("long").alias("fabrikant"),
        )

    def accessoire(self) -> DataFrame:
        return self.fiets().select(
            F.col("fietsnr").alias("accessoirenr"), F.col("merk").alias("naam"), "standaardprijs", "inkoopprijs", "soort",
            F.col("fabrikant").alias("leverancier"),
        )

    def filiaal(self) -> DataFrame:
        return self.t.filiaal().drop("business_key").withColumn("filiaalnr", F.col("filiaalnr").cast("long"))

    def monteur(self) -> DataFrame:
        wage = F.col("s_acctbal")
        earlier = F.when(wage > 5000, wage - 100).otherwise(wage)
        return self.t.supplier.join(self.t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("monteurnr"), F.col("s_name").alias("naam"), F.col("n_name").alias("woonplaats"),
            (earlier if self.first else wage).alias("uurloon"), F.col("s_nationkey").cast("long").alias("filiaal"),
        )

    def _orders(self, system: str) -> DataFrame:
        own = F.coalesce(F.col("o_orderstatus") == "O", F.lit(False))
        found = self.orders.filter(own if system.startswith("Fiets") else ~own)
        return found.filter(F.col("o_orderdate") < FIRST_ORDERS_BEFORE) if self.first else found

    def verkoop(self, system: str) -> DataFrame:
        return self._orders(system).select(
            F.col("o_orderkey").alias(f"{system.lower()}nr"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("datum"),
            "aantal", F.col("o_totalprice").alias("verkoopprijs"), F.col("o_custkey").alias("klant"),
            F.col("sold").alias("fiets" if system.startswith("Fiets") else "accessoire"), "monteur",
        )

    def inkoop(self, system: str) -> DataFrame:
        number = lambda c: c.cast("long")
        return self._orders(system).select(
            F.col("o_orderkey").alias("inkoopnr"), number(F.month("last")).alias("inkoopmaand"),
            number(F.year("last")).alias("inkoopjaar"), "aantal",
            F.col("bought").alias("fiets" if system.startswith("Fiets") else "accessoire"),
        )

    def onderhoud(self) -> DataFrame:
        other: Column = F.coalesce(F.col("event_type") != FIRST_EVENTS_WITHOUT, F.lit(True))
        visits = self.t.events.filter(other) if self.first else self.t.events
        end = F.col("ts") + F.make_dt_interval(secs=F.floor("value"))
        return visits.select(
            F.col("event_id").alias("onderhoudnr"), F.date_format("ts", "yyyy-MM-dd").alias("datum"),
            F.date_format("ts", "HH:mm:ss").alias("starttijd"), F.date_format(end, "HH:mm:ss").alias("eindtijd"),
            F.col("user_id").alias("fiets"), F.col("user_id").alias("monteur"),
        )

    def table(self, system: str, name: str) -> DataFrame:
        if name == system and name != "Onderhoud":
            return self.verkoop(system) if name.endswith("Verkoop") else self.inkoop(system)
        if name == "Klant":
            return self.klant(system)
        return getattr(self, name.lower())()

    def write(self, root: str, without: tuple[str, str] | None = None) -> dict[str, str]:
        """Write all source tables but one."""
        folders = {system: f"{root}/{system}" for system in SOURCES}
        run_together([
            lambda s=system, n=name: self.table(s, n).write.option("compression", CODEC).parquet(f"{folders[s]}/{n}.parquet")
            for system, tables in SOURCES.items() for name, _ in tables if (system, name) != without
        ], 4)
        return folders


@dataclass(frozen=True)
class Run:
    first: bool  # the sources as the first run finds them
    mode: str = "incremental"
    keys: str = "natural"
    without: tuple[str, str] | None = None  # a source table that is missing


# a missing source table: its dimension fails, the facts that need it are skipped
MISSING = ("Accessoire_Verkoop", "Klant")
SERIES = {
    "increments": (Run(True), Run(False)),
    "refreshed": (Run(True), Run(True, "refresh"), Run(False)),
    "source_keys": (Run(False, keys="source"),),
    "failed": (Run(False, without=MISSING),),
}
_done: dict[tuple[str, str, str], tuple[Store, str]] = {}


def loaded(t: Tables, series: str = "increments") -> tuple[Store, str]:
    """The star after a series of runs, and the folder of their logs."""
    spark = t.spark
    key = (spark.sparkContext.applicationId, t.folder, series)
    if key not in _done:
        root = f"{shared_dir(spark)}/loads-{uuid.uuid4().hex}"
        staging, star = Store(spark, f"{root}/staging", STAGING), Store(spark, f"{root}/star", STAR, STAR_BANDS)
        sources: dict[bool, dict[str, str]] = {}
        with scratch(spark) as keep:
            orders = keep(orders_with_lines(t))
            for moment, run in zip(RUNS, SERIES[series]):
                if run.first not in sources:
                    sources[run.first] = Sources(t, run.first, orders).write(f"{root}/source-{moment:%Y%m%d}", run.without)
                load_staging(spark, sources[run.first], staging, moment).write(spark, f"{root}/log-staging")
                WarehouseLoad(spark, staging, star, moment, run.mode, run.keys).run().write(spark, f"{root}/log-star")
        _done[key] = star, root
    return _done[key]


def _named(fact: DataFrame, star: Store, table: str, key: str, *columns: Column) -> DataFrame:
    """Business key, and more columns, of the member that a fact's surrogate key points at."""
    member = star.read(table).select(key, F.col("business_key").alias(table.lower()), *columns)
    return fact.join(sent_if_few(member, star.count(table)), key, "left").drop(key)


def _sales(star: Store) -> DataFrame:
    fact = _named(star.read("Verkoop").drop("verkoop_key"), star, "Klant", "klant_key", F.col("woonplaats"))
    fact = _named(fact, star, "Product", "product_key")
    fact = _named(fact, star, "Filiaal", "filiaal_key")
    return _named(fact, star, "Monteur", "monteur_key", F.round("uurloon", 2).alias("uurloon"))


def star_sales(t: Tables) -> DataFrame:
    return _sales(loaded(t)[0])


def star_refresh_sales(t: Tables) -> DataFrame:
    """Sales after a full refresh between two increments, under the keys that the refresh issued."""
    return _sales(loaded(t, "refreshed")[0])


def star_source_sales(t: Tables) -> DataFrame:
    """Sales whose members carry keys qualified by their system."""
    return _sales(loaded(t, "source_keys")[0]).drop("woonplaats", "uurloon", "verkoopprijs", "aantal")


def star_purchase(t: Tables) -> DataFrame:
    star, _ = loaded(t)
    fact = _named(star.read("Inkoop").drop("inkoop_key"), star, "Product", "product_key")
    fact = _named(fact, star, "Leverancier", "lev_key")
    return fact.join(star.read("InkoopPeriode"), "periode_key", "left").drop("periode_key")


def star_maintenance(t: Tables) -> DataFrame:
    star, _ = loaded(t)
    fact = star.read("Onderhoud").drop("onderhoud_key").withColumn("uurloon", F.round("uurloon", 2))
    for table, key in (("Product", "product_key"), ("Monteur", "monteur_key"), ("Filiaal", "filiaal_key")):
        fact = _named(fact, star, table, key)
    return fact


def star_workers(t: Tables) -> DataFrame:
    """Versions of every worker, and whether a version is the open one."""
    star, _ = loaded(t)
    versions = star.read("Monteur")
    opened = sent_if_few(current(versions).select("monteur_key", F.lit(True).alias("open")), star.count("Monteur"))
    return versions.join(opened, "monteur_key", "left").select(
        "business_key", F.round("uurloon", 2).alias("uurloon"), "begin_tijd", "eind_tijd",
        F.coalesce("open", F.lit(False)).alias("open"),
    )


def _steps(t: Tables, series: str) -> DataFrame:
    log = read_log(t.spark, f"{loaded(t, series)[1]}/log-star", WAREHOUSE_COLUMNS)
    return log.filter(F.col("stap").rlike("^(SCD|DIM|FACT)")).select(
        "run_id", "tabel", "status", "aantal_insert", "aantal_update", "aantal_dwh_na")


def star_log(t: Tables) -> DataFrame:
    """Counters of every step of both runs, read back from the log files."""
    return _steps(t, "increments")


def star_refresh_log(t: Tables) -> DataFrame:
    """Counters of an increment, a full refresh, and another increment."""
    return _steps(t, "refreshed")


def star_failed_log(t: Tables) -> DataFrame:
    """Counters of a run that misses one source table: a failed step, skipped facts, and the rest as ever."""
    return _steps(t, "failed")


def staging_log(t: Tables) -> DataFrame:
    """Rows delivered and loaded per staging table in both runs, read back from the log files."""
    log = read_log(t.spark, f"{loaded(t)[1]}/log-staging", STAGING_COLUMNS)
    return log.filter("stap = 'LOAD'").select("run_id", "doel_tabel", "status", "aantal_bron", "aantal_doel_na")


def mixed_logs(t: Tables) -> DataFrame:
    """Loads and steps of three log layouts: both logs of the runs in one file, a header before each, and a third beside it."""
    root = loaded(t)[1]
    folder = f"{shared_dir(t.spark)}/mixed-{uuid.uuid4().hex}"

    def lines(columns: list[str], place: int, frame: DataFrame) -> DataFrame:
        header = t.spark.createDataFrame([(place, ",".join(columns))], "place int, value string")
        return header.unionByName(frame.select(F.lit(place + 1).alias("place"), F.to_csv(F.struct(*columns), {"escape": '"'}).alias("value")))

    staged, star = read_log(t.spark, f"{root}/log-staging", STAGING_COLUMNS), read_log(t.spark, f"{root}/log-star", WAREHOUSE_COLUMNS)
    noted = star.withColumns({"aantal": F.col("aantal_dwh_na"), "melding": F.concat(F.col("tabel"), F.lit(' is "checked",\nand once more'))})
    both = lines(STAGING_COLUMNS, 0, staged).unionByName(lines(WAREHOUSE_COLUMNS, 2, star))
    for name, rows in (("both", both), ("notes", lines(NOTEBOOK_COLUMNS, 0, noted))):
        # the log of few runs: one file
        rows.repartition(1).sortWithinPartitions("place").select("value").write.text(f"{folder}/{name}")
    found = read_mixed_logs(t.spark, f"{folder}/*").filter(F.col("stap").rlike("^(SCD|DIM|FACT|LOAD)"))
    return found.select(
        "layout", "timestamp", F.coalesce("tabel", "doel_tabel").alias("tabel"), "status",
        F.coalesce("aantal_dwh_na", "aantal_doel_na", "aantal").alias("aantal"),
        F.when(F.col("layout") == len(NOTEBOOK_COLUMNS), F.col("melding")).alias("melding"),
    )
