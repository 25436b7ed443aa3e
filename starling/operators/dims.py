"""Generated dimensions: dates and purchase periods."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.dates import as_day, day_key
from starling.operators.keys import max_key, ranked_keys


def observed_days(columns: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct days of several (table, column) pairs; bad dates are dropped."""
    days = [df.select(as_day(c, df.schema[c].dataType).alias("datum")) for df, c in columns]
    return reduce(DataFrame.unionByName, days).filter("datum IS NOT NULL").distinct()


def date_rows(days: DataFrame) -> DataFrame:
    d = F.col("datum")
    return days.select(
        day_key(d).alias("datum_key"),
        F.date_format(d, "yyyy-MM-dd").alias("datum"),
        F.dayofmonth(d).cast("long").alias("dag"),
        F.month(d).cast("long").alias("maand"),
        F.quarter(d).cast("long").alias("kwartaal"),
        F.year(d).cast("long").alias("jaar"),
    )


def date_dim(columns: Sequence[tuple[DataFrame, str]], existing: DataFrame) -> DataFrame:
    """Days not yet in the date dimension, one row per day."""
    return date_rows(observed_days(columns)).join(existing.select("datum_key"), "datum_key", "left_anti")


def period_dim(frames: Sequence[DataFrame], existing: DataFrame) -> DataFrame:
    """New (month, year) pairs, numbered after the highest existing key in calendar order."""
    pair = ["inkoopmaand", "inkoopjaar"]
    seen = reduce(DataFrame.unionByName, [f.select(*pair) for f in frames]).distinct()
    same = F.col("n.inkoopmaand").eqNullSafe(F.col("e.inkoopmaand")) & F.col("n.inkoopjaar").eqNullSafe(
        F.col("e.inkoopjaar")
    )
    fresh = seen.alias("n").join(existing.alias("e"), same, "left_anti")
    numbered = ranked_keys(fresh, ["inkoopjaar", "inkoopmaand"], "periode_key", max_key(existing, "periode_key"))
    return numbered.select("periode_key", *pair)
