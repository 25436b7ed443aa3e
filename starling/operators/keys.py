"""Surrogate keys and first-row dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.functions.columns import business_key


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Keep the first row of each key in a stated, total order.

    Spark limits each input partition to one row per key before the shuffle
    (``WindowGroupLimit``), so a hot key costs at most one row per map task.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def max_key(df: DataFrame, sk: str) -> Column:
    """Highest key so far, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(sk), F.lit(0)).cast("long")).scalar()


def key_bucket(key: Sequence[str], digits: int = 3) -> Column:
    """Leading hex digits of the key's digest: even buckets of fixed number."""
    return F.substring(F.md5(business_key(*key)), 1, digits)


def dense_keys(
    df: DataFrame, key: Sequence[str], sk: str, start: Column | int = 0, digits: int = 3
) -> DataFrame:
    """Number rows ``start + 1 ...`` without gaps, in the order (digest bucket, key).

    ``key`` must be unique in ``df``. No window spans the whole input: rows are
    ranked inside 16^digits digest buckets and shifted by the running size of
    the buckets before, a table of at most 16^digits rows, which bounds both the
    one-partition running sum and the broadcast. ``df`` is read twice, the first
    time for its key columns only; stage it when it is costly to compute.
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4")
    bucketed = df.withColumn("_bucket", key_bucket(key, digits))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    first = F.lit(start) if isinstance(start, int) else start
    numbered = bucketed.withColumn("_local", local).join(F.broadcast(offsets), "_bucket")
    return numbered.withColumn(sk, (first + F.col("_offset") + F.col("_local")).cast("long")).drop(
        "_bucket", "_local", "_offset"
    )


def ranked_keys(df: DataFrame, order: Sequence[str], sk: str, start: Column | int = 0) -> DataFrame:
    """Number rows ``start + 1 ...`` in sort order, for tables bounded by the calendar (periods)."""
    first = F.lit(start) if isinstance(start, int) else start
    rank = F.row_number().over(Window.orderBy(*order))
    return df.withColumn(sk, (first + rank).cast("long"))
