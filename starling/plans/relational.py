"""The thirty relational questions over the sample tables.

The not-unique side of a semi, anti or outer join is reduced to distinct rows
first: adaptive execution cannot split a hot key on that side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.columns import flag_contains
from starling.functions.dates import years_since
from starling.plans.tables import Tables

QUESTIONS: dict[str, Callable[[Tables], DataFrame]] = {}


def question(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUESTIONS[f"q_{fn.__name__}"] = fn
    return fn


def second_address() -> Column:
    """Segment where the balance is not negative, unknown otherwise."""
    return F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))


@question
def e01(t: Tables) -> DataFrame:
    price = F.col("p_retailprice")
    return t.part.filter((price > 920) & (price < 950)).select("p_partkey", "p_retailprice")


@question
def e02(t: Tables) -> DataFrame:
    return t.part.filter((F.col("p_size") < 10) | (F.col("p_size") > 40)).select("p_partkey", "p_size")


@question
def e03(t: Tables) -> DataFrame:
    return t.nation.filter("n_regionkey = 2").select("n_name").orderBy("n_name")


@question
def e04(t: Tables) -> DataFrame:
    return t.orders.filter("o_totalprice > 440000").select("o_orderdate").distinct()


@question
def e05(t: Tables) -> DataFrame:
    known = second_address().isNotNull() & F.nullif(F.col("c_nationkey"), F.lit(0)).isNotNull()
    return t.customer.filter(known).select("c_name", "c_nationkey")


@question
def e06(t: Tables) -> DataFrame:
    return t.nation.filter(F.col("n_regionkey").isin(1, 2)).select("n_name").orderBy("n_name")


@question
def e07(t: Tables) -> DataFrame:
    second = F.nullif(F.col("p_type"), F.lit("PROMO"))
    return t.part.filter(F.col("p_name").startswith("b") & second.isNotNull()).select("p_name", "p_type", "p_brand")


@question
def e08(t: Tables) -> DataFrame:
    return t.lineitem.filter("l_returnflag = 'R'").agg(F.sum("l_quantity").alias("total_returned"))


@question
def e09(t: Tables) -> DataFrame:
    homes = t.supplier.select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    return t.nation.join(homes, "n_nationkey", "left_semi").agg(F.countDistinct("n_regionkey").alias("regions"))


@question
def e10(t: Tables) -> DataFrame:
    margin = F.col("p_size") / 100
    return t.part.agg(
        F.min(margin).alias("lowest"), F.max(margin).alias("highest"), F.round(F.avg(margin), 2).alias("average")
    )


@question
def e11(t: Tables) -> DataFrame:
    return t.customer.agg(F.count(F.when(second_address().isNull(), 1)).alias("without_second_address"))


@question
def e12(t: Tables) -> DataFrame:
    sold = t.lineitem.select("l_partkey", (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_sale_price"))
    discounted = sold.join(t.part, F.col("l_partkey") == F.col("p_partkey")).filter(
        F.col("unit_sale_price") < 1.5 * F.col("p_retailprice")
    )
    return discounted.agg(F.round(F.avg("p_retailprice"), 6).alias("average_cost"))


@question
def e13(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("employees"))


@question
def e14(t: Tables) -> DataFrame:
    limit = t.customer.agg(F.count("*") / 25).scalar()
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("employees"))
    return per_nation.filter(F.col("employees") > limit)


@question
def e15(t: Tables) -> DataFrame:
    home = t.nation.filter("n_name = 'NATION_7'")
    return t.customer.join(home, F.col("c_nationkey") == F.col("n_nationkey")).select("c_name", "c_mktsegment")


@question
def e16(t: Tables) -> DataFrame:
    homes = t.nation.join(t.region.filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    return t.supplier.join(homes, F.col("s_nationkey") == F.col("n_nationkey")).select("s_name")


@question
def e17(t: Tables) -> DataFrame:
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    buyers = t.customer.filter("c_mktsegment = 'MACHINERY'").join(urgent, "c_custkey", "left_semi")
    places = buyers.select("c_nationkey", "c_mktsegment").distinct()
    return places.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_mktsegment")


@question
def e18(t: Tables) -> DataFrame:
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp"))
    dates = recent.select("o_custkey", "o_orderdate").distinct()
    managers = t.customer.filter(F.col("c_mktsegment").contains("H"))
    return managers.join(dates, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_mktsegment", "o_orderdate"
    ).distinct()


@question
def e19(t: Tables) -> DataFrame:
    large = t.lineitem.filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return t.part.join(large, "p_partkey", "left_semi").select("p_name", "p_type").distinct()


@question
def e20(t: Tables) -> DataFrame:
    price = F.nullif(F.col("l_extendedprice"), F.lit(0.0))
    sale = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cheap = t.lineitem.filter((F.col("l_extendedprice") - sale) / price > 0.095)
    parts = cheap.select(F.col("l_partkey").alias("p_partkey")).distinct()
    return t.part.join(parts, "p_partkey", "left_semi").select("p_name").distinct()


@question
def e21(t: Tables) -> DataFrame:
    back = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
    shares = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        (back / F.nullif(F.sum("l_quantity"), F.lit(0.0))).alias("share")
    )
    mostly = shares.filter("share > 0.9")
    return t.orders.join(mostly, "o_orderkey", "left_semi").select("o_orderpriority").distinct()


@question
def e22(t: Tables) -> DataFrame:
    return t.part.groupBy("p_type").agg(F.count("*").alias("products"))


@question
def e23(t: Tables) -> DataFrame:
    per_key = t.customer.groupBy("c_nationkey").agg(F.count("*").alias("sites"))
    return per_key.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "sites")


@question
def e24(t: Tables) -> DataFrame:
    # decimal sums do not depend on the order of addition
    price = F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
    sold = t.lineitem.groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("quantity"), price.alias("price"), F.count("*").alias("n")
    )
    economy = t.part.filter("p_type = 'ECONOMY'").join(sold, F.col("p_partkey") == F.col("l_partkey"))
    per_name = economy.groupBy("p_name").agg(
        F.sum("quantity").alias("total_quantity"),
        (F.sum("price").cast("double") / F.sum("n")).alias("average_price"),
    )
    return per_name.orderBy("total_quantity", "p_name")


@question
def e25(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    per_region = t.nation.join(customers, "n_nationkey", "left_semi").groupBy("n_regionkey").agg(
        F.count("*").alias("klanten")
    )
    sellers = t.nation.select("n_regionkey", F.col("n_name").alias("verkoper"))
    named = per_region.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).drop("r_regionkey")
    return named.join(sellers, "n_regionkey").select("r_name", "verkoper", "klanten")


@question
def e26(t: Tables) -> DataFrame:
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp"))
    sellers = recent.select(F.col("o_custkey").alias("c_custkey")).distinct()
    return t.customer.join(sellers, "c_custkey", "left_anti").select("c_name", "c_mktsegment")


@question
def e27(t: Tables) -> DataFrame:
    below = t.part.filter(F.col("p_size") < t.part.agg(F.avg("p_size")).scalar())
    number = below.agg(F.count("*").cast("double").alias("waarde"))
    mean = below.agg(F.round(F.avg("p_size"), 6).alias("waarde"))
    return number.union(mean).distinct()


@question
def e28(t: Tables) -> DataFrame:
    returned = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t.orders.filter("o_totalprice > 400000").join(returned, "o_orderkey", "left_anti").select("o_orderkey")


@question
def e29(t: Tables) -> DataFrame:
    return t.customer.select("c_name", flag_contains("c_mktsegment", "MA").alias("manager"))


@question
def e30(t: Tables) -> DataFrame:
    term = F.when(years_since("o_orderdate", 2001) < 3, "kort in dienst").otherwise("lang in dienst")
    return t.orders.select("o_orderkey", term.alias("dienst"))
