"""Load the star schema from staging.

Two settings cover the variants: ``mode`` is ``incremental`` (merge into what is
there) or ``refresh`` (rebuild everything); ``keys`` is ``natural`` (attributes
shared by the systems) or ``source`` (number qualified by system). A refresh
issues new surrogate keys; they are stable in incremental mode only. It becomes
visible as one unit once every step has succeeded, so facts never meet the keys
of another run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.functions.columns import business_key, source_key
from starling.functions.dates import date_key
from starling.operators import scd
from starling.operators.dims import date_dim, period_dim
from starling.operators.facts import integer_keys, lookup, new_rows, reject_missing
from starling.operators.keys import dense_keys, first_per_key
from starling.operators.quality import Step, run_graph
from starling.operators.staging import conform, union_branches
from starling.session import SENT_ROWS, broadcast_if_few, scratch, sent_if_few
from starling.sources import files
from starling.sources.runlog import WAREHOUSE_COLUMNS, RunLog
from starling.sources.store import Store


Stage = Callable[[DataFrame], DataFrame]
OPEN, CLOSED = "open", "closed"  # parts of a type 2 dimension in the store


@dataclass(frozen=True)
class Dimension:
    """A slowly changing dimension; the natural key names its attributes."""

    table: str
    sk: str
    natural: tuple[str, ...]
    tracked: tuple[str, ...]
    kind: int


# fixed values: keys and tracked columns
DIMENSIONS = {
    d.table: d
    for d in (
        Dimension("Klant", "klant_key", ("naam", "geboortedatum"),
                  ("source_id", "klantnr", "naam", "woonplaats", "adres", "geslacht", "geboortedatum"), 1),
        Dimension("Product", "product_key", ("product_type", "productnr"),
                  ("productnr", "product_type", "soort", "merk", "type", "kleur", "fabrikant"), 1),
        Dimension("Leverancier", "lev_key", ("naam", "adres"), ("leveranciernr", "naam", "adres", "woonplaats"), 1),
        Dimension("Monteur", "monteur_key", ("naam", "woonplaats"), ("monteurnr", "naam", "woonplaats", "uurloon"), 2),
        Dimension("Filiaal", "filiaal_key", ("adres",), ("filiaalnr", "naam", "adres", "provincie"), 2),
    )
}

# systems in order of precedence; the order of the two key strategies differs
KLANT_SYSTEMS = (("Fiets_Verkoop", 1), ("Accessoire_Verkoop", 2))
PERSONNEL_SYSTEMS = {
    "natural": ("Accessoire_Verkoop", "Fiets_Verkoop", "Onderhoud"),
    "source": ("Fiets_Verkoop", "Accessoire_Verkoop", "Onderhoud"),
}
PRODUCT_SYSTEMS = {
    "natural": ("Accessoire_Verkoop", "Accessoire_Inkoop", "Fiets_Verkoop", "Fiets_Inkoop"),
    "source": ("Fiets_Verkoop", "Fiets_Inkoop", "Onderhoud", "Accessoire_Verkoop", "Accessoire_Inkoop"),
}
SUPPLIER_SYSTEMS = ("Accessoire_Verkoop", "Accessoire_Inkoop", "Fiets_Verkoop", "Fiets_Inkoop")
PURCHASE_SYSTEMS = {
    "natural": (("Accessoire_Inkoop", 1), ("Fiets_Inkoop", 2)),
    "source": (("Fiets_Inkoop", 1), ("Accessoire_Inkoop", 2)),
}


def is_accessory(system: str) -> bool:
    return system.startswith("Accessoire")


class WarehouseLoad:
    def __init__(
        self, spark: SparkSession, staging: Store, star: Store, run_ts: datetime,
        mode: str = "incremental", keys: str = "natural", product_systems: Sequence[str] | None = None,
    ):
        if mode not in ("incremental", "refresh") or keys not in ("natural", "source"):
            raise ValueError(f"unknown mode {mode} or keys {keys}")
        self.spark, self.staging, self.run_ts = spark, staging, run_ts
        self.refresh, self.natural = mode == "refresh", keys == "natural"
        self.keys = keys
        self.product_systems = tuple(product_systems or PRODUCT_SYSTEMS[keys])
        self.log = RunLog("DWH", WAREHOUSE_COLUMNS, run_ts)
        self.published = star
        self.star = star.branch(self.log.run_id) if self.refresh else star

    # extracts

    def _staged(self, name: str) -> DataFrame:
        if not self.staging.exists(name):
            raise FileNotFoundError(f"no such table: {name}")
        return self.staging.read(name)

    def _makers(self, system: str) -> int:
        return self.staging.count(f"{system}_{'Leverancier' if is_accessory(system) else 'Fabrikant'}")

    def _union(self, frames: Sequence[DataFrame]) -> DataFrame:
        return union_branches(frames, number="_branch")

    def _key(self, dim: str, system: str, number: str | Column, *parts: str | Column) -> Column:
        """Business key of a row of ``system`` under the chosen strategy."""
        if self.natural:
            return business_key(*parts)
        prefix = f"{system.upper()}_"
        if dim == "Leverancier" and not is_accessory(system):
            prefix += "FABRIKANT_"
        return source_key(prefix, number)

    def klant(self) -> DataFrame:
        branch = lambda system, number: self._staged(f"{system}_Klant").select(
            self._key("Klant", system, "klantnr", "naam", "geboortedatum").alias("business_key"),
            F.lit(number).cast("long").alias("source_id"),
            "klantnr", "naam", "woonplaats", "adres", "geslacht", "geboortedatum",
        )
        return self._union([branch(*s) for s in KLANT_SYSTEMS])

    def _maker(self, system: str) -> DataFrame:
        """Suppliers of a system under shared names, whatever the system calls them."""
        if is_accessory(system):
            return self._staged(f"{system}_Leverancier")
        return conform(self._staged(f"{system}_Fabrikant"), {
            "leveranciernr": "fabrikantnr", "naam": "naam", "adres": "adres", "woonplaats": "plaats"})

    def _products(self, system: str) -> DataFrame:
        if is_accessory(system):
            own = conform(self._staged(f"{system}_Accessoire"), {
                "productnr": "accessoirenr", "product_type": F.lit("accessoire"), "soort": "soort", "merk": "naam",
                "type": F.lit(None).cast("string"), "kleur": F.lit(None).cast("string"), "maker": "leverancier"})
        else:
            own = conform(self._staged(f"{system}_Fiets"), {
                "productnr": "fietsnr", "product_type": F.lit("fiets"), "soort": "soort", "merk": "merk",
                "type": "type", "kleur": "kleur", "maker": "fabrikant"})
        names = self._maker(system).select(F.col("leveranciernr").alias("maker"), F.col("naam").alias("fabrikant"))
        key = self._key("Product", system, "productnr", "product_type", "productnr")
        return own.join(sent_if_few(names, self._makers(system)), "maker", "left").drop("maker").withColumn("business_key", key)

    def product(self) -> DataFrame:
        return self._union([self._products(s) for s in self.product_systems])

    def leverancier(self) -> DataFrame:
        key = lambda s: self._key("Leverancier", s, "leveranciernr", "naam", "adres")
        return self._union([self._maker(s).withColumn("business_key", key(s)) for s in SUPPLIER_SYSTEMS])

    def monteur(self) -> DataFrame:
        key = lambda s: self._key("Monteur", s, "monteurnr", "naam", "woonplaats")
        return self._union([
            self._staged(f"{s}_Monteur").drop("filiaal").withColumn("business_key", key(s))
            for s in PERSONNEL_SYSTEMS[self.keys]
        ])

    def filiaal(self) -> DataFrame:
        key = lambda s: self._key("Filiaal", s, "filiaalnr", "adres")
        return self._union([
            self._staged(f"{s}_Filiaal").withColumn("business_key", key(s)) for s in PERSONNEL_SYSTEMS[self.keys]
        ])

    # dimension steps

    def _merge(self, dim: Dimension, source: DataFrame, stage: Stage) -> None:
        """Merge deduplicated source rows; the first branch wins on the business key."""
        order = ["_branch", *[c for c in source.columns if c.endswith("nr")], *dim.tracked]
        incoming = stage(first_per_key(source, ["business_key"], order).drop("_branch"))
        delivered, before, start = source.count(), self.star.count(dim.table), self.star.highest(dim.table)
        if self.refresh:
            stored, start = self.star.read(dim.table).limit(0), 0
        else:
            # closed versions are neither read nor written again
            stored = self.star.read(dim.table, OPEN if dim.kind == 2 else None)
        most = max(delivered, before)
        stored, incoming = sent_if_few(stored, most), sent_if_few(incoming, most)
        actions = scd.count_actions(scd.classify(stored, incoming, "business_key", dim.tracked, dim.sk)).first()
        # an unchanged dimension keeps its version
        if self.refresh or actions["aantal_insert"] or actions["aantal_update"]:
            if dim.kind == 1:
                state = scd.scd1_merge(stored, incoming, "business_key", dim.tracked, dim.sk)
                self.star.publish(dim.table, state, self.log.run_id)
            else:
                state = stage(scd.scd2_step(stored, incoming, "business_key", dim.tracked, dim.sk, self.run_ts, start))
                parts = {OPEN: state.filter(F.col(scd.END).isNull()), CLOSED: state.filter(F.col(scd.END).isNotNull())}
                self.star.commit(dim.table, parts if actions["aantal_update"] else {OPEN: parts[OPEN]}, self.log.run_id, kept=(CLOSED,))
        inserts = actions["aantal_insert"] + (actions["aantal_update"] if dim.kind == 2 else 0)
        skipped = delivered - inserts if self.refresh else actions["aantal_skip"]
        self.log.add(
            f"SCD{dim.kind}", tabel=dim.table, actie="refresh" if self.refresh else "merge",
            melding=f"{delivered} rows of {dim.table}", aantal_sdm=delivered, aantal_dwh_voor=0 if self.refresh else before,
            aantal_insert=inserts, aantal_update=actions["aantal_update"], aantal_skipped=skipped,
            aantal_dwh_na=self.star.count(dim.table),
        )

    def _extend(self, table: str, delivered: int, distinct: int, fresh: DataFrame) -> None:
        """Add rows to a generated dimension."""
        before = 0 if self.refresh else self.star.count(table)
        if self.refresh:
            self.star.publish(table, fresh, self.log.run_id)
        elif not fresh.isEmpty():
            self.star.append(table, fresh, self.log.run_id)
        after = self.star.count(table)
        inserted = after - before
        self.log.add(
            "DIM", tabel=table, actie="refresh" if self.refresh else "insert", melding=f"{delivered} rows of {table}",
            aantal_sdm=delivered, aantal_dwh_voor=before, aantal_insert=inserted,
            aantal_skipped=(delivered if self.refresh else distinct) - inserted, aantal_dwh_na=after,
        )

    def _existing(self, table: str) -> DataFrame:
        stored = self.star.read(table)
        return stored.limit(0) if self.refresh else stored

    def datum(self, stage: Stage) -> None:
        columns = [(self._staged(n), "datum") for n in ("Fiets_Verkoop", "Accessoire_Verkoop", "Onderhoud")]
        every = stage(date_dim(columns, self._existing("Datum").limit(0)))
        fresh = every.join(self._existing("Datum").select("datum_key"), "datum_key", "left_anti")
        self._extend("Datum", sum(df.count() for df, _ in columns), every.count(), fresh)

    def periode(self, stage: Stage) -> None:
        frames = [self._staged(n) for n in ("Fiets_Inkoop", "Accessoire_Inkoop")]
        pairs = reduce(DataFrame.unionByName, [f.select("inkoopmaand", "inkoopjaar") for f in frames])
        fresh = stage(period_dim(frames, self._existing("InkoopPeriode")))
        self._extend("InkoopPeriode", pairs.count(), pairs.distinct().count(), fresh)

    # fact steps

    def _look_up(self, rows: DataFrame, *dims: str) -> DataFrame:
        for name in dims:
            dim = self.star.read(name)
            dim = sent_if_few(scd.current(dim) if DIMENSIONS[name].kind == 2 else dim, self.star.count(name))
            short = "lev" if name == "Leverancier" else name.lower()
            rows = lookup(rows, dim, f"{short}_bk", DIMENSIONS[name].sk)
        return rows

    def _people(self, system: str) -> DataFrame:
        """Workers of a system with the surrogate keys of themselves and their branch.

        Like :meth:`_buyers`, keys are looked up on the few source rows of the
        dimension, so that the facts join once per dimension and not twice.
        """
        workers = self._staged(f"{system}_Monteur").select(
            F.col("monteurnr").alias("monteur"), "filiaal", "uurloon",
            self._key("Monteur", system, "monteurnr", "naam", "woonplaats").alias("monteur_bk"),
        )
        if self.natural:
            branches = self._staged(f"{system}_Filiaal").select(
                F.col("filiaalnr").alias("filiaal"),
                self._key("Filiaal", system, "filiaalnr", "adres").alias("filiaal_bk"),
            )
            workers = workers.join(sent_if_few(branches, self.staging.count(f"{system}_Filiaal")), "filiaal")
        else:
            workers = workers.withColumn("filiaal_bk", self._key("Filiaal", system, "filiaal"))
        keyed = self._look_up(workers, "Monteur", "Filiaal").drop("filiaal", "monteur_bk", "filiaal_bk")
        return broadcast_if_few(keyed, self.staging.count(f"{system}_Monteur"))

    def _sales(self, system: str, number: int) -> DataFrame:
        kind = "accessoire" if is_accessory(system) else "fiets"
        sold = self._staged(system).select(
            F.lit(number).cast("long").alias("source_id"), F.col(f"{system.lower()}nr").alias("verkoopnr"),
            "klant", "monteur", date_key("datum").alias("datum_key"), "verkoopprijs", "aantal",
            self._key("Product", system, kind, F.lit(kind), kind).alias("product_bk"),
        )
        if self.natural:
            customers = self._staged(f"{system}_Klant").select(
                F.col("klantnr").alias("klant"), business_key("naam", "geboortedatum").alias("klant_bk"))
            keyed = self._look_up(customers, "Klant").drop("klant_bk")
            sold = sold.join(broadcast_if_few(keyed, self.staging.count(f"{system}_Klant")), "klant")
        else:
            sold = self._look_up(sold.withColumn("klant_bk", self._key("Klant", system, "klant")), "Klant")
        return sold.join(self._people(system).drop("uurloon"), "monteur")

    def _insert(self, table: str, sk: str, grain: list[str], found: DataFrame, required: list[str], stage: Stage) -> None:
        """Reject rows with missing keys, keep new grains, number them, append."""
        wanted = [c for c in self.star.schemas[table].names if c != sk]
        # the looked-up batch is written once and read for counting and for the anti join
        batch = stage(found.select(*wanted))
        delivered = batch.count()
        complete = integer_keys(reject_missing(batch, required), required)
        skipped = delivered - complete.count()
        # row count and highest key stand beside the version; of the history only the batch's own bands are read
        before, start = (0, 0) if self.refresh else (self.star.count(table), self.star.highest(table))
        # numbering reads its input twice; the anti join should run once
        # without history every complete row is new
        if not before:
            fresh = complete
        else:
            few = delivered <= SENT_ROWS
            fresh = stage(new_rows(complete, sent_if_few(self.star.near(table, complete), max(before, delivered)), grain, batch if few else None))
        numbered = dense_keys(fresh, grain, sk, start, digits=4)
        if self.refresh:
            self.star.publish(table, numbered, self.log.run_id)
        elif not fresh.isEmpty():
            self.star.append(table, numbered, self.log.run_id)
        after = self.star.count(table)
        self.log.add(
            "FACT", tabel=table, actie="refresh" if self.refresh else "insert_incremental",
            melding=f"{delivered} rows of {table}", aantal_sdm=delivered, aantal_dwh_voor=before, aantal_insert=after - before,
            aantal_skipped=skipped, aantal_dwh_na=after,
        )

    def verkoop(self, stage: Stage) -> None:
        sold = union_branches([self._sales(*s) for s in KLANT_SYSTEMS])
        found = self._look_up(sold, "Product")
        required = ["klant_key", "product_key", "filiaal_key", "datum_key"]
        if self.natural:
            required.append("monteur_key")
        self._insert("Verkoop", "verkoop_key", ["source_id", "verkoopnr"], found, required, stage)

    def onderhoud(self, stage: Stage) -> None:
        visits = self._staged("Onderhoud").withColumn(
            "product_bk", self._key("Product", "Onderhoud", "fiets", F.lit("fiets"), "fiets")
        ).join(self._people("Onderhoud"), "monteur")
        found = self._look_up(visits, "Product")
        self._insert("Onderhoud", "onderhoud_key", ["onderhoudnr"], found, ["product_key", "monteur_key", "filiaal_key"], stage)

    def _purchases(self, system: str, number: int) -> DataFrame:
        kind, maker = ("accessoire", "leverancier") if is_accessory(system) else ("fiets", "fabrikant")
        goods = self._staged(f"{system}_{kind.capitalize()}").select(
            F.col(f"{kind}nr").alias(kind), F.col(maker).alias("maker"), "inkoopprijs")
        rows = self.staging.count(f"{system}_{kind.capitalize()}")
        bought = self._staged(system).join(sent_if_few(goods, rows), kind)
        if self.natural:
            makers = self._maker(system).select(
                F.col("leveranciernr").alias("maker"), business_key("naam", "adres").alias("lev_bk"))
            keyed = self._look_up(makers, "Leverancier").drop("lev_bk")
            bought = bought.join(broadcast_if_few(keyed, self._makers(system)), "maker")
        else:
            named = bought.withColumn("lev_bk", self._key("Leverancier", system, "maker"))
            bought = self._look_up(named, "Leverancier")
        return bought.select(
            F.lit(number).cast("long").alias("source_id"), "inkoopnr", "inkoopmaand", "inkoopjaar", "aantal",
            "inkoopprijs", "lev_key", self._key("Product", system, kind, F.lit(kind), kind).alias("product_bk"),
        )

    def inkoop(self, stage: Stage) -> None:
        bought = union_branches([self._purchases(*s) for s in PURCHASE_SYSTEMS[self.keys]])
        pair = ["inkoopmaand", "inkoopjaar"]
        found = self._look_up(bought, "Product")
        found = lookup(found, self.star.read("InkoopPeriode"), pair, "periode_key", dim_key=pair, null_safe=True)
        self._insert("Inkoop", "inkoop_key", ["source_id", "inkoopnr"], found, ["product_key", "periode_key", "lev_key"], stage)

    # the run

    def steps(self) -> list[tuple[str, str, Callable[[Stage], None], tuple[str, ...]]]:
        """Log step, table, work, and the tables that must have been loaded in this run before."""
        merge = lambda name, extract: (f"SCD{DIMENSIONS[name].kind}", name,
                                       lambda stage: self._merge(DIMENSIONS[name], extract(), stage), ())
        return [
            merge("Klant", self.klant), merge("Product", self.product), merge("Leverancier", self.leverancier),
            ("DIM", "Datum", self.datum, ()), ("DIM", "InkoopPeriode", self.periode, ()),
            merge("Monteur", self.monteur), merge("Filiaal", self.filiaal),
            ("FACT", "Verkoop", self.verkoop, ("Klant", "Product", "Datum", "Monteur", "Filiaal")),
            ("FACT", "Onderhoud", self.onderhoud, ("Product", "Datum", "Monteur", "Filiaal")),
            ("FACT", "Inkoop", self.inkoop, ("Product", "Leverancier", "InkoopPeriode")),
        ]

    def _scratched(self, work: Callable[[Stage], None]) -> None:
        with scratch(self.spark) as stage:
            work(stage)

    def run(self, workers: int = 4) -> RunLog:
        """A failed step is logged and leaves its table as it was; facts that need its table are skipped.

        A refresh with a failed step leaves all tables as they were.
        """
        self.log.add("START", melding=f"{self.keys} keys", actie="start_pipeline")
        start, steps = len(self.log.rows), self.steps()
        names = {table: step for step, table, _, _ in steps}
        run_graph(
            [Step(table, lambda w=work: self._scratched(w), needs) for _, table, work, needs in steps], workers,
            lambda s, e: self.log.add(names[s.name], "ERROR", str(e), tabel=s.name, actie="load", aantal_error=1),
            lambda s, lost: self.log.add(names[s.name], "SKIPPED", f"needs {', '.join(lost)}", tabel=s.name, actie="skip"),
        )
        self.log.sort_since(start, "tabel", list(names))
        failed = any(r["status"] == "ERROR" for r in self.log.rows)
        if self.refresh and failed:
            files.delete(self.spark, self.star.root)
            self.log.add("PUBLISH", "ERROR", f"generation of {self.log.run_id} dropped", actie="publish", aantal_error=1)
        elif self.refresh:
            self.published.switch(self.star)
        self.star = self.published
        for table in self.star.schemas:
            if not failed:
                self.star.vacuum(table)
            rows = self.star.count(table)
            self.log.add("EINDCONTROLE", "OK" if rows else "WARNING",
                         f"{table}: {rows}",
                         tabel=table, actie="count", aantal_dwh_na=rows)
        self.log.add("EINDE", melding=f"{len(self.log.rows)} entries", actie="end_pipeline")
        return self.log
