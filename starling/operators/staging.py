"""Conforming several sources into staging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions.columns import col_of


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fit a source table to its target: unknown columns go, absent ones become typed NULLs."""
    known = set(df.columns)
    cast = lambda f: (F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name)
    return df.select([cast(f) for f in schema.fields])


def conform(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Project one source to shared names: ``{target: source column or expression}``."""
    return df.select([col_of(source).alias(target) for target, source in mapping.items()])


def union_branches(branches: Sequence[DataFrame], number: str | None = None) -> DataFrame:
    """UNION ALL by name; ``number`` adds the branch position, the precedence of its rows."""
    if number:
        branches = [b.withColumn(number, F.lit(i)) for i, b in enumerate(branches, 1)]
    return reduce(DataFrame.unionByName, branches)


def consolidate(sources: Sequence[DataFrame], existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows of several sources for one target, the first source winning on the key.

    A key already in the target or in an earlier source is left out. Rows that
    share a key inside one source all stay, and so do rows with a missing key.
    Each key is reduced to the least source that has it, and one anti join drops
    the rows of later ones; its left side may be split by adaptive execution.
    """
    names, branch = list(key), "_branch"
    rows = union_branches(sources, number=branch)
    have = existing.select(*names, F.lit(0).alias(branch)).unionByName(rows.select(*names, branch))
    least = have.groupBy(*names).agg(F.min(branch).alias("_least"))
    later = reduce(Column.__and__, [rows[k] == least[k] for k in names]) & (rows[branch] > least["_least"])
    return rows.join(least, later, "left_anti").drop(branch)


def reconcile(counts: DataFrame) -> DataFrame:
    """Compare loaded with delivered rows.

    Needs ``aantal_bron``, ``aantal_doel_voor`` and ``aantal_doel_na``; adds
    ``aantal_verwerkt`` and an OK/WARNING status.
    """
    done = F.col("aantal_doel_na") - F.col("aantal_doel_voor")
    return counts.withColumn("aantal_verwerkt", done).withColumn(
        "status", F.when(done == F.col("aantal_bron"), "OK").otherwise("WARNING")
    )


def load_counts(target: str, source: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """One row of counts for :func:`reconcile`, each side counted by an aggregate of its own."""
    side = lambda df, c: df.agg(F.count("*").alias(c)).scalar().alias(c)
    one = source.sparkSession.range(1)
    return one.select(
        F.lit(target).alias("doel_tabel"),
        side(source, "aantal_bron"),
        side(before, "aantal_doel_voor"),
        side(after, "aantal_doel_na"),
    )
