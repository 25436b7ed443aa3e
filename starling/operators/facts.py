"""Fact loading: key lookup, rejects, incremental rows, measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import all_of, any_null
from starling.functions.dates import duration_seconds
from starling.session import fits_broadcast


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str | Sequence[str],
    sk: str,
    dim_key: str | Sequence[str] = "business_key",
    null_safe: bool = False,
) -> DataFrame:
    """Add the surrogate key of a dimension; no match gives NULL.

    No broadcast hint: the optimizer broadcasts the two pruned dimension
    columns when their size allows it, and otherwise shuffles, where adaptive
    execution splits a hot key on the fact side.
    """
    left = [fact_key] if isinstance(fact_key, str) else list(fact_key)
    right = [dim_key] if isinstance(dim_key, str) else list(dim_key)
    slim = dim.select(sk, *[F.col(c).alias(f"_dim_{c}") for c in right])
    match = lambda a, b: F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b)
    on = all_of([match(a, f"_dim_{b}") for a, b in zip(left, right)])
    return fact.join(slim, on, "left").drop(*[f"_dim_{c}" for c in right])


def reject_missing(fact: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows with every required key; the others are counted by :func:`rejects`."""
    return fact.na.drop(subset=list(required))


def rejects(fact: DataFrame, required: Sequence[str]) -> DataFrame:
    return fact.filter(any_null(required))


def integer_keys(fact: DataFrame, names: Sequence[str]) -> DataFrame:
    return fact.withColumns({c: F.col(c).cast("long") for c in names})


def new_rows(
    fact: DataFrame, existing: DataFrame, grain: Sequence[str], batch: DataFrame | None = None
) -> DataFrame:
    """Rows whose grain columns are not in the fact table yet.

    ``batch`` is the stored table the rows come from. When its keys are few, they
    are sent to the history, which then needs no shuffle: only the keys both
    sides hold remain for the anti join.
    """
    known = existing.select(*grain)
    if batch is not None and fits_broadcast(fact.select(*grain), batch):
        known = known.join(F.broadcast(fact.select(*grain)), list(grain), "left_semi")
    return fact.join(known, list(grain), "left_anti")


def known_dates(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows whose date key exists in the date dimension."""
    return fact.join(dates.select("datum_key"), "datum_key", "left_semi")


def sales_measures(fact: DataFrame) -> DataFrame:
    return fact.withColumn("omzet", F.col("verkoopprijs") * F.col("aantal"))


def purchase_measures(fact: DataFrame) -> DataFrame:
    return fact.withColumn("inkoopwaarde", F.col("inkoopprijs") * F.col("aantal"))


def maintenance_measures(fact: DataFrame) -> DataFrame:
    """Duration in hours from the start and end times, and its cost at the copied wage."""
    hours = duration_seconds("starttijd", "eindtijd") / F.lit(3600.0)
    return fact.withColumn("duur", hours).withColumn("kosten", F.col("duur") * F.col("uurloon"))
