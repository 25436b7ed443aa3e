"""Slowly changing dimensions as snapshot rewrites.

Plain Parquet knows no MERGE, so every operator returns the full next state.
``incoming`` holds one row per key (see :func:`starling.operators.keys.first_per_key`).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import all_of, is_changed
from starling.operators.keys import dense_keys, first_per_key, max_key

BEGIN, END = "begin_tijd", "eind_tijd"


def current(history: DataFrame) -> DataFrame:
    """Open versions."""
    return history.filter(F.col(END).isNull())


def current_by_max(history: DataFrame, key: Sequence[str], sk: str) -> DataFrame:
    """Latest version per key where versions carry no validity: the one with the highest surrogate key."""
    return first_per_key(history, key, [F.col(sk).desc()])


def history_of(history: DataFrame, key: str, sk: str, value: str | None = None) -> DataFrame:
    """Versions in key order, of one business key or of all."""
    chosen = history if value is None else history.filter(F.col(key) == value)
    return chosen.orderBy(key, sk)


def classify(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], sk: str) -> DataFrame:
    """Incoming rows with ``actie``: insert, update or skip. Pass open versions for a type 2 dimension."""
    known = dim.select(key, sk, *[c for c in tracked if c != key])
    joined = incoming.alias("i").join(known.alias("d"), F.col(f"i.{key}") == F.col(f"d.{key}"), "left")
    action = (
        F.when(F.col(f"d.{sk}").isNull(), "insert")
        .when(is_changed("i", "d", tracked), "update")
        .otherwise("skip")
    )
    return joined.select("i.*", action.alias("actie"))


def count_actions(classified: DataFrame) -> DataFrame:
    """Rows per action in one row; actions that do not occur count 0."""
    count = lambda a: F.count(F.when(F.col("actie") == a, 1)).alias(f"aantal_{a}")
    return classified.agg(count("insert"), count("update"), count("skip"))


def insert_only(dim: DataFrame, incoming: DataFrame, key: str, sk: str) -> DataFrame:
    """New keys with fresh surrogate keys; known keys are never touched. Returns the rows to append."""
    fresh = incoming.join(dim.select(key), key, "left_anti")
    return dense_keys(fresh, [key], sk, max_key(dim, sk)).select(dim.columns)


def scd1_merge(dim: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], sk: str) -> DataFrame:
    """Type 1: overwrite tracked columns of known keys, add new keys, keep the rest.

    Writing equal values again changes nothing, so no row needs the change test here.
    """
    latest = incoming.select(key, *tracked).withColumn("_seen", F.lit(True))
    joined = dim.alias("d").join(latest.alias("i"), key, "left")
    pick = lambda c: F.when(F.col("_seen"), F.col(f"i.{c}")).otherwise(F.col(f"d.{c}")).alias(c)
    kept = joined.select([pick(c) if c in tracked else F.col(c) for c in dim.columns])
    return kept.unionByName(insert_only(dim, incoming, key, sk))


def _unlike(known: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str]) -> DataFrame:
    """Incoming rows for which no equal version is known: new keys and changed ones."""
    names = [key, *[c for c in tracked if c != key]]
    same = all_of([F.col(f"i.{c}").eqNullSafe(F.col(f"k.{c}")) for c in names])
    return incoming.alias("i").join(known.select(names).alias("k"), same, "left_anti")


def _moment(run_ts: datetime) -> Column:
    """A wall-clock time of the session's zone, whatever the zone of the driver process."""
    return F.lit(run_ts.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def scd2_initial(incoming: DataFrame, key: str, sk: str, run_ts: datetime) -> DataFrame:
    """Type 2, first load or full refresh: every row is an open version."""
    return _open(dense_keys(incoming, [key], sk), _moment(run_ts))


def _open(rows: DataFrame, begin: Column) -> DataFrame:
    return rows.withColumns({BEGIN: begin.cast("timestamp"), END: F.lit(None).cast("timestamp")})


def scd2_merge(
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    run_ts: datetime,
    close_missing: bool = False,
) -> DataFrame:
    """Type 2: close changed versions at ``run_ts`` and open their successors from it.

    Closed versions bypass both joins, so a key with a very long history is
    never gathered; the joins see one open row per key.
    """
    ended = history.filter(F.col(END).isNotNull())
    return ended.unionByName(scd2_step(current(history), incoming, key, tracked, sk, run_ts, max_key(history, sk), close_missing))


def scd2_step(
    open_rows: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    sk: str,
    run_ts: datetime,
    start: Column | int,
    close_missing: bool = False,
) -> DataFrame:
    """What a type 2 merge makes of the open versions: those it closes, those that stay, and new ones.

    ``start`` is the highest key given out so far, in closed versions too; these are not read.
    """
    latest = incoming.select(key, *[c for c in tracked if c != key]).withColumn("_seen", F.lit(True))
    joined = open_rows.alias("d").join(latest.alias("i"), F.col(f"d.{key}") == F.col(f"i.{key}"), "left")
    closing = F.col("_seen") & is_changed("d", "i", tracked)
    if close_missing:
        closing = closing | F.col("_seen").isNull()
    still = joined.select("d.*", F.when(closing, _moment(run_ts)).alias("_end"))
    marked = still.withColumn(END, F.col("_end")).drop("_end")
    opened = dense_keys(_unlike(open_rows, incoming, key, tracked), [key], sk, start)
    return marked.unionByName(_open(opened, _moment(run_ts)).select(open_rows.columns))


def scd2_append(history: DataFrame, incoming: DataFrame, key: str, tracked: Sequence[str], sk: str) -> DataFrame:
    """Type 2 without validity columns: the versions to append for new and changed keys."""
    latest = current_by_max(history, [key], sk)
    fresh = _unlike(latest, incoming, key, tracked)
    return dense_keys(fresh, [key], sk, max_key(history, sk)).select(history.columns)
