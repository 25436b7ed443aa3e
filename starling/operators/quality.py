"""Reports that replace unenforced constraints, and isolated steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import any_null


def missing_keys(fact: DataFrame, keys: Sequence[str], show: Sequence[str]) -> DataFrame:
    """Rows with any key missing, with the business keys that found no match."""
    return fact.filter(any_null(keys)).select(*show, *keys)


def final_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; an empty table is a WARNING."""
    count = lambda name, df: df.agg(F.count("*").alias("aantal")).select(F.lit(name).alias("tabel"), "aantal")
    counts = reduce(DataFrame.unionByName, [count(n, df) for n, df in tables.items()])
    return counts.withColumn("status", F.when(F.col("aantal") > 0, "OK").otherwise("WARNING"))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("aantal")).filter("aantal > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose reference is set but has no parent."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def run_together(steps: Sequence[Callable[[], object]], workers: int) -> None:
    """Run independent steps from several driver threads; their jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=workers) as pool:
        list(pool.map(lambda step: step(), steps))


@dataclass(frozen=True)
class Step:
    """A named piece of work and the names of the steps that must have succeeded before it."""

    name: str
    work: Callable[[], object]
    needs: tuple[str, ...] = ()


def run_graph(
    steps: Sequence[Step], workers: int, on_error: Callable[[Step, Exception], None], on_skip: Callable[[Step, list[str]], None],
) -> set[str]:
    """Run each step as soon as those it needs are done; returns the names that succeeded.

    A failure is handed over and the run goes on. Steps that need a failed or skipped one are
    skipped, and told which.
    """
    waiting, done, lost = {s.name: s for s in steps}, set(), set()
    unknown = {n for s in steps for n in s.needs} - set(waiting)
    if unknown:
        raise ValueError(f"no such steps: {sorted(unknown)}")
    with ThreadPoolExecutor(max_workers=workers) as pool:
        running: dict[Future, Step] = {}
        while waiting or running:
            for step in list(waiting.values()):
                missing = [n for n in step.needs if n in lost]
                if missing:
                    on_skip(waiting.pop(step.name), missing)
                    lost.add(step.name)
                elif all(n in done for n in step.needs):
                    running[pool.submit(step.work)] = waiting.pop(step.name)
            if not running:
                if waiting and not any(n in lost for s in waiting.values() for n in s.needs):
                    raise ValueError(f"steps need each other: {sorted(waiting)}")
                continue
            finished, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in finished:
                step, error = running.pop(future), future.exception()
                if error is None:
                    done.add(step.name)
                elif isinstance(error, Exception):
                    lost.add(step.name)
                    on_error(step, error)
                else:
                    raise error
    return done


def run_step(step: Callable[[], None], on_error: Callable[[Exception], None]) -> bool:
    """Run one load step; a failure is handed over and the run goes on."""
    try:
        step()
        return True
    except Exception as error:
        on_error(error)
        return False
