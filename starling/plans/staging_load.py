"""Copy source systems into staging, with reconciliation and a run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from starling.operators.quality import run_step, run_together
from starling.operators.staging import align, consolidate
from starling.schemas import SOURCES, UNIFIED_SOURCES
from starling.sources.files import exists, read_table
from starling.sources.runlog import STAGING_COLUMNS, RunLog
from starling.sources.store import Store


def _final_counts(store: Store, log: RunLog) -> None:
    for target in store.schemas:
        def count(target: str = target) -> None:
            rows = store.count(target)
            log.add("EINDCONTROLE", "OK" if rows else "WARNING", f"{target}: {rows}", doel_tabel=target, actie="count", aantal_doel_na=rows)

        run_step(count, lambda e, target=target: log.add(
            "EINDCONTROLE", "ERROR", str(e), doel_tabel=target, actie="count"))


def _refresh(spark: SparkSession, folder: str, name: str, target: str, store: Store, log: RunLog) -> None:
    where = {"bron_database": folder, "bron_tabel": name, "doel_tabel": target}
    if not exists(spark, f"{folder}/{name}.parquet"):
        log.add("EXTRACT", "ERROR", f"no {folder}/{name}.parquet", actie="select", **where)
        return

    def load() -> None:
        raw = read_table(spark, folder, name)
        before, delivered = store.count(target), raw.count()
        log.add("RESET", doel_tabel=target, actie="delete", aantal_doel_voor=before, aantal_verwerkt=before)
        store.publish(target, align(raw, store.schemas[target]), log.run_id)
        after = store.count(target)
        fits = after == delivered
        log.add("LOAD", "OK" if fits else "WARNING",
                f"{after} of {delivered} rows", actie="insert",
                aantal_bron=delivered, aantal_verwerkt=after, aantal_doel_na=after, **where)

    run_step(load, lambda e: log.add("LOAD", "ERROR", str(e), actie="insert", **where))


def load_staging(
    spark: SparkSession, folders: dict[str, str], store: Store, run_ts: datetime, workers: int = 4
) -> RunLog:
    """Full refresh of every staging table from its source folder of Parquet tables.

    A missing source or table is logged and skipped. A table becomes visible
    only when its load is complete; until then readers keep the previous one.
    """
    log = RunLog("SDM", STAGING_COLUMNS, run_ts)
    log.add("START", melding=f"{len(folders)} sources", actie="start_pipeline")
    present = {s: f for s, f in folders.items() if exists(spark, f)}
    for source in SOURCES:
        if source not in present:
            log.add("CONNECT", "ERROR", f"no folder for {source}", bron_database=folders.get(source, source),
                    actie="open_database")
    loads = [(present[s], name, target) for s, tables in SOURCES.items() if s in present for name, target in tables]
    start = len(log.rows)
    run_together([lambda one=one: _refresh(spark, *one, store, log) for one in loads], workers)
    log.sort_since(start, "doel_tabel", [target for _, _, target in loads])
    _final_counts(store, log)
    log.add("EINDE", melding=f"{len(log.rows)} entries", actie="end_pipeline")
    return log


def load_unified(
    spark: SparkSession, folders: dict[str, str], store: Store, run_ts: datetime, workers: int = 4,
    allow_missing: bool = False,
) -> RunLog:
    """Add new keys to one shared table per entity, the first source winning.

    Which source wins depends on all of them: a target with a missing source is logged and
    not loaded, unless ``allow_missing`` says that the others may do.
    """
    log = RunLog("SDM", STAGING_COLUMNS, run_ts)

    def load(target: str, key: str, systems: list[str]) -> None:
        paths = {s: f"{folders[s]}/{target}.parquet" for s in systems if s in folders}
        found = [p for p in paths.values() if exists(spark, p)]
        missing = [s for s in systems if s not in paths or not exists(spark, paths[s])]
        for system in missing:
            log.add("EXTRACT", "ERROR", f"no {target} in {system}", bron_database=system, bron_tabel=target,
                    doel_tabel=target, actie="select")
        if not found or missing and not allow_missing:
            raise FileNotFoundError(f"{target} lacks {', '.join(missing) or 'every source'}")
        frames = [align(spark.read.parquet(p), store.schemas[target]) for p in found]
        before = store.count(target)
        store.append(target, consolidate(frames, store.read(target), [key]), log.run_id)
        after = store.count(target)
        log.add("LOAD", doel_tabel=target, actie="insert", aantal_bron=sum(f.count() for f in frames),
                aantal_doel_voor=before, aantal_verwerkt=after - before, aantal_doel_na=after)

    def isolated(target: str, key: str, systems: list[str]) -> None:
        run_step(lambda: load(target, key, systems),
                 lambda e: log.add("LOAD", "ERROR", str(e), doel_tabel=target, actie="insert"))

    run_together([lambda t=t, ks=ks: isolated(t, *ks) for t, ks in UNIFIED_SOURCES.items()], workers)
    log.sort_since(0, "doel_tabel", list(UNIFIED_SOURCES))
    _final_counts(store, log)
    return log
