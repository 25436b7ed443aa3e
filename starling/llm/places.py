"""Ranks of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starling.llm import text as T
from starling.session import fits_broadcast


def ranked(rows: DataFrame, group: str, order: list[str], keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``rows`` with ``place``, their rank within ``group`` from 0; no task holds a group.

    ``order`` must tell all rows apart; nulls come first. Rows are ranged over partitions and
    numbered in each; a partition's first place in a group is the sum of the counts before
    it. ``keep`` writes a table and reads it back, so that numbers are settled once.
    """
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = rows.repartitionByRange(T.partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    # the number's upper bits are the partition, its lower 33 bits the row in it
    dealt = keep(dealt.withColumn("_row", F.monotonically_increasing_id()))
    part = F.shiftright("_row", 33)
    counts = dealt.groupBy(F.col(group).alias("_g"), part.alias("_p")).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    firsts = keep(counts.select("_g", "_p", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    side = F.broadcast(firsts) if fits_broadcast(firsts, firsts) else firsts
    joined = dealt.join(side, F.col(group).eqNullSafe(F.col("_g")) & (part == F.col("_p")))
    return joined.withColumn("place", F.col("_row") - F.col("_first") + F.col("_before")).drop("_row", "_g", "_p", "_first", "_before")
