"""Sales, purchase and maintenance facts over the sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import business_key
from starling.functions.dates import day_key
from starling.operators.dims import period_dim
from starling.operators.facts import integer_keys, lookup, reject_missing
from starling.operators.scd import current
from starling.plans.tables import LINE_ID, Tables
from starling.session import BROADCAST_BYTES, broadcast_if_small, fits_broadcast, stage

GRAIN = ["source_id", *LINE_ID]
SALES_KEYS = ["klant_key", "monteur_key", "product_key", "filiaal_key", "datum_key"]
PURCHASE_KEYS = ["product_key", "periode_key", "lev_key"]
MAINTENANCE_KEYS = ["product_key", "monteur_key", "filiaal_key"]


def _source() -> Column:
    return F.when(F.col("l_linestatus") == "O", 1).otherwise(2).cast("long").alias("source_id")


def _lines(t: Tables, *columns: Column) -> DataFrame:
    """Lines of both systems. They share one table, so the system is a column and not a second scan."""
    kind = F.when(F.col("l_linestatus") == "O", "fiets").otherwise("accessoire")
    return t.lineitem.select(
        _source(), *LINE_ID, business_key(kind, "l_partkey").alias("product_bk"), F.col("l_quantity").cast("long").alias("aantal"), *columns,
    )


def _people(t: Tables, named: bool = False) -> DataFrame:
    """Workers with the keys of themselves and their branch, and their business keys if wanted.

    Keys are looked up on these rows and not on the facts, which then need one
    join in place of two per dimension.
    """
    monteur = t.monteur().select(
        F.col("monteurnr"), "uurloon", "woonplaats", F.col("business_key").alias("monteur_bk")
    )
    filiaal = t.filiaal().select("adres", F.col("business_key").alias("filiaal_bk"))
    working = monteur.join(filiaal, F.col("woonplaats") == F.col("adres")).drop("woonplaats", "adres")
    found = lookup(working, current(t.dim_monteur()), "monteur_bk", "monteur_key")
    found = lookup(found, t.dim_filiaal(), "filiaal_bk", "filiaal_key")
    # numbers only: their size follows from the row count
    return broadcast_if_small(found if named else found.drop("monteur_bk", "filiaal_bk"), t.supplier)


def _buyers(t: Tables) -> DataFrame:
    klant = t.customer.select(
        F.col("c_custkey").alias("o_custkey"), business_key("c_name", t.birth_date()).alias("klant_bk")
    )
    return broadcast_if_small(lookup(klant, t.dim_klant(), "klant_bk", "klant_key").drop("klant_bk"), t.customer)


def _products(t: Tables) -> DataFrame:
    """The product dimension, two rows per part."""
    return broadcast_if_small(t.dim_product(), t.part.select("p_partkey"), BROADCAST_BYTES // 2)


def sales_with_keys(t: Tables) -> DataFrame:
    """All sales with looked-up keys, missing ones still NULL."""
    lines = _lines(t, (F.col("l_extendedprice") / F.col("l_quantity")).alias("verkoopprijs"))
    heads = t.orders.select("o_orderkey", "o_custkey", day_key("o_orderdate").alias("datum_key"))
    # customers meet the orders first: fewer rows move than with the lines
    bought = heads.join(_buyers(t), "o_custkey").drop("o_custkey")
    # beyond that, tables of the fewer orders take a part of the memory that sorting the lines does; hot keys are split all the same
    bought = F.broadcast(bought) if fits_broadcast(bought, t.orders) else bought.hint("shuffle_hash")
    joined = (
        lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
        .join(_people(t).drop("uurloon"), F.col("l_suppkey") == F.col("monteurnr")).drop("monteurnr")
    )
    return lookup(joined, _products(t), "product_bk", "product_key")


def fact_sales(t: Tables, required: list[str] = SALES_KEYS) -> DataFrame:
    kept = reject_missing(sales_with_keys(t), required)
    return integer_keys(kept, ["source_id", *SALES_KEYS]).select(*GRAIN, *SALES_KEYS, "verkoopprijs", "aantal")


def periods(t: Tables) -> DataFrame:
    """Stored periods and the new ones."""
    return t.stored_periods().unionByName(period_dim([t.months()], t.stored_periods()))


def _goods(t: Tables) -> DataFrame:
    """Price and product key of every part in either system, looked up on the parts and not line by line."""
    kinds = F.explode(F.array(*[F.struct(F.lit(n).cast("long").alias("source_id"), F.lit(k).alias("kind")) for n, k in ((1, "fiets"), (2, "accessoire"))]))
    both = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_retailprice").alias("inkoopprijs"), kinds.alias("s"))
    named = both.select("l_partkey", "inkoopprijs", "s.source_id", business_key("s.kind", "l_partkey").alias("product_bk"))
    keyed = lookup(named, t.dim_product(), "product_bk", "product_key").drop("product_bk")
    return broadcast_if_small(keyed, t.part.select("p_partkey"), BROADCAST_BYTES // 2)


def purchases_with_keys(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        _source(), *LINE_ID, F.col("l_quantity").cast("long").alias("aantal"),
        F.month("l_shipdate").cast("long").alias("inkoopmaand"), F.year("l_shipdate").cast("long").alias("inkoopjaar"),
    )
    makers = t.supplier.select(
        F.col("s_suppkey").alias("l_suppkey"), business_key("s_name", "s_nationkey").alias("lev_bk")
    )
    makers = broadcast_if_small(lookup(makers, t.dim_leverancier(), "lev_bk", "lev_key").drop("lev_bk"), t.supplier)
    bought = lines.join(_goods(t), ["source_id", "l_partkey"]).join(makers, "l_suppkey")
    pair = ["inkoopmaand", "inkoopjaar"]
    # one row per month: stored, so that its numbering is not repeated in the lookup
    return lookup(bought, F.broadcast(stage(periods(t))), pair, "periode_key", dim_key=pair, null_safe=True)


def fact_purchase(t: Tables) -> DataFrame:
    kept = reject_missing(purchases_with_keys(t), PURCHASE_KEYS)
    return integer_keys(kept, ["source_id", *PURCHASE_KEYS]).select(
        *GRAIN, *PURCHASE_KEYS, "aantal", "inkoopprijs"
    )


def maintenance_with_keys(t: Tables, named: bool = False) -> DataFrame:
    """Events as workshop visits; the wage is copied at load time."""
    end = F.col("ts") + F.make_dt_interval(secs=F.floor("value"))
    visits = t.events.select(
        F.col("event_id").alias("onderhoudnr"),
        F.col("user_id").alias("monteurnr"),
        F.date_format("ts", "yyyy-MM-dd").alias("datum"),
        F.date_format("ts", "HH:mm:ss").alias("starttijd"),
        F.date_format(end, "HH:mm:ss").alias("eindtijd"),
        business_key(F.lit("fiets"), "user_id").alias("product_bk"),
    )
    return lookup(visits.join(_people(t, named), "monteurnr"), _products(t), "product_bk", "product_key")


def fact_maintenance(t: Tables) -> DataFrame:
    kept = reject_missing(maintenance_with_keys(t), MAINTENANCE_KEYS)
    return integer_keys(kept, MAINTENANCE_KEYS).select(
        "onderhoudnr", *MAINTENANCE_KEYS, "datum", "starttijd", "eindtijd", "uurloon"
    )
