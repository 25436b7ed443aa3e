"""The sample tables, and the staging and dimension tables derived from them.

Two sales systems serve overlapping market segments; stored dimension states
are earlier versions of the same tables, told apart by attribute predicates.
Every derived frame reads its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions.columns import business_key
from starling.operators.staging import union_branches
from starling.session import stage
from starling.sources.files import read_table

# fixed values: segments served by either system, validity moments, time of the load
FIRST_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE")
ONLY_FIRST_SEGMENTS = ("AUTOMOBILE", "BUILDING")  # the second system has all others, so no customer is without one
STORED_SEGMENTS = ("AUTOMOBILE", "BUILDING", "MACHINERY")
FIRST_BEGIN, SECOND_BEGIN = "2019-01-01 00:00:00", "2020-01-01 00:00:00"

# the columns that identify a line; order and line number alone do not
LINE_ID = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class Tables:
    """Sample tables as attributes, derived frames as methods."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = read_table(self.spark, self.folder, name)
        return self._read[name]

    # staging

    def klant(self, served: Column, town: str) -> DataFrame:
        balance = F.col("c_acctbal")
        return self.customer.filter(served).select(
            F.col("c_custkey").alias("klantnr"),
            F.col("c_name").alias("naam"),
            F.concat(F.lit(town), text("c_nationkey")).alias("woonplaats"),
            F.col("c_mktsegment").alias("adres"),
            F.when(balance >= 5000, "V").when(balance >= 0, "M").alias("geslacht"),
            self.birth_date().alias("geboortedatum"),
        )

    def birth_date(self) -> Column:
        return F.when(F.col("c_acctbal") >= 0, F.concat(text(F.col("c_nationkey") + 1950), F.lit("-01-01")))

    def klant_sources(self) -> list[DataFrame]:
        only_first = F.coalesce(F.col("c_mktsegment").isin(*ONLY_FIRST_SEGMENTS), F.lit(False))
        return [self.klant(F.col("c_mktsegment").isin(*FIRST_SEGMENTS), "City "), self.klant(~only_first, "Town ")]

    def klant_branches(self) -> DataFrame:
        first, second = self.klant_sources()
        both = [first.withColumn("source_id", F.lit(1)), second.withColumn("source_id", F.lit(2))]
        return union_branches(both).withColumn("business_key", business_key("naam", "geboortedatum"))

    def leverancier_sources(self) -> list[DataFrame]:
        suppliers = self.supplier.select(
            F.col("s_suppkey").alias("leveranciernr"), F.col("s_name").alias("naam"),
            F.concat(F.lit("Street "), text("s_nationkey")).alias("adres"),
            F.concat(F.lit("City "), text("s_nationkey")).alias("woonplaats"),
        )
        makers = self.part.select(
            F.col("p_partkey").alias("fabrikantnr"), F.col("p_brand").alias("naam"),
            F.col("p_type").alias("adres"), F.col("p_name").alias("plaats"),
        )
        return [suppliers, makers]

    def monteur(self) -> DataFrame:
        return self.supplier.join(self.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").alias("monteurnr"), F.col("s_name").alias("naam"),
            F.col("n_name").alias("woonplaats"), F.col("s_acctbal").alias("uurloon"),
            F.col("n_regionkey").alias("regio"), business_key("s_name", "n_name").alias("business_key"),
        )

    def filiaal(self) -> DataFrame:
        return self.nation.join(self.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("filiaalnr"), F.concat(F.lit("Branch "), "n_name").alias("naam"),
            F.col("n_name").alias("adres"), F.col("r_name").alias("provincie"),
            business_key("n_name").alias("business_key"),
        )

    # stored dimension states

    def stored_klant(self) -> DataFrame:
        """Klant as an earlier load left it: other segments, old towns for high balances."""
        balance = F.col("c_acctbal")
        town = F.when(balance > 8000, "Old ").when(F.col("c_mktsegment") == "MACHINERY", "Town ").otherwise("City ")
        return self.customer.filter(F.col("c_mktsegment").isin(*STORED_SEGMENTS)).select(
            (F.col("c_custkey") + 1).alias("klant_key"),
            business_key("c_name", self.birth_date()).alias("business_key"),
            F.col("c_custkey").alias("klantnr"),
            F.col("c_name").alias("naam"),
            F.concat(town, text("c_nationkey")).alias("woonplaats"),
            F.col("c_mktsegment").alias("adres"),
        )

    def stored_monteur(self) -> DataFrame:
        """Monteur history: region 0 unknown yet, some wages since changed, some versions already closed."""
        known = self.monteur().filter("regio <> 0")
        wage = F.col("uurloon")
        named = lambda key, pay, begin, end: [
            key.cast("long").alias("monteur_key"), "business_key", "monteurnr", "naam", "woonplaats",
            pay.alias("uurloon"), F.lit(begin).cast("timestamp").alias("begin_tijd"),
            F.lit(end).cast("timestamp").alias("eind_tijd"),
        ]
        number = F.col("monteurnr") * 2
        old_wage = F.when(wage > 5000, wage - 100).otherwise(wage)
        open_rows = known.select(*named(number + 2, old_wage, SECOND_BEGIN, None))
        closed = known.filter(wage < 2000).select(*named(number + 1, wage - 50, FIRST_BEGIN, SECOND_BEGIN))
        return open_rows.unionByName(closed)

    # published dimensions for the fact loads; some members are left out so that lookups miss

    def dim_klant(self) -> DataFrame:
        return self.customer.select(
            (F.col("c_custkey") + 1).alias("klant_key"),
            business_key("c_name", self.birth_date()).alias("business_key"),
        )

    def dim_product(self) -> DataFrame:
        kinds = F.explode(F.array(F.lit("fiets"), F.lit("accessoire"))).alias("product_type")
        both = self.part.select("p_partkey", kinds)
        offset = F.when(F.col("product_type") == "fiets", 1).otherwise(2)
        return both.select(
            (F.col("p_partkey") * 2 + offset).alias("product_key"),
            business_key("product_type", "p_partkey").alias("business_key"),
        )

    def dim_monteur(self) -> DataFrame:
        ended = F.when(F.col("uurloon") < 0, F.lit(SECOND_BEGIN).cast("timestamp"))
        return self.monteur().select(
            (F.col("monteurnr") + 1).alias("monteur_key"), "business_key", ended.alias("eind_tijd")
        )

    def dim_filiaal(self) -> DataFrame:
        return self.filiaal().select((F.col("filiaalnr") + 1).cast("long").alias("filiaal_key"), "business_key")

    def dim_leverancier(self) -> DataFrame:
        return self.supplier.filter("s_acctbal >= 0").select(
            (F.col("s_suppkey") + 1).alias("lev_key"), business_key("s_name", "s_nationkey").alias("business_key")
        )

    def months(self) -> DataFrame:
        """Distinct months of shipping: a few rows, taken from the lines once."""
        if "_months" not in self._read:
            self._read["_months"] = stage(self.lineitem.select(
                F.month("l_shipdate").cast("long").alias("inkoopmaand"), F.year("l_shipdate").cast("long").alias("inkoopjaar")
            ).distinct())
        return self._read["_months"]

    def stored_periods(self) -> DataFrame:
        return self.months().filter("inkoopjaar = 1995").select(F.col("inkoopmaand").alias("periode_key"), "inkoopmaand", "inkoopjaar")

    def empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], T._parse_datatype_string(schema))
