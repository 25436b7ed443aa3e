"""Run log: collected during a run, written and read back as CSV."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.sources.files import numbered_lines

# fixed values: column order of the three log formats
STAGING_COLUMNS = (
    "run_id timestamp laag stap bron_database bron_tabel doel_tabel actie aantal_bron "
    "aantal_doel_voor aantal_verwerkt aantal_doel_na status melding"
).split()
WAREHOUSE_COLUMNS = (
    "run_id timestamp laag stap tabel actie aantal_sdm aantal_dwh_voor aantal_insert "
    "aantal_update aantal_skipped aantal_error aantal_dwh_na status melding"
).split()
NOTEBOOK_COLUMNS = "timestamp stap tabel actie aantal status melding".split()


def log_schema(columns: list[str]) -> T.StructType:
    kind = lambda c: T.LongType() if c.startswith("aantal") else T.StringType()
    return T.StructType([T.StructField(c, kind(c)) for c in columns])


class RunLog:
    """One row per logged step; the driver holds counters and messages only."""

    def __init__(self, layer: str, columns: list[str], run_ts: datetime):
        self.layer = layer
        self.columns = columns
        self.run_ts = run_ts
        self.run_id = run_ts.strftime("%Y%m%d_%H%M%S")
        self.rows: list[dict[str, object]] = []

    def add(self, stap: str, status: str = "OK", melding: str = "", **values: object) -> None:
        row = {c: 0 if c.startswith("aantal") else "" for c in self.columns}
        row.update(run_id=self.run_id, laag=self.layer, timestamp=self.run_ts.strftime("%Y-%m-%d %H:%M:%S"))
        row.update(values, stap=stap, status=status, melding=melding)
        self.rows.append({c: row[c] for c in self.columns})

    def sort_since(self, start: int, column: str, order: list[str]) -> None:
        """Put the rows of steps that ran side by side into a fixed order."""
        place = {value: i for i, value in enumerate(order)}
        self.rows[start:] = sorted(self.rows[start:], key=lambda r: place.get(r[column], -1))

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [tuple(r[c] for c in self.columns) for r in self.rows]
        return spark.createDataFrame(rows, log_schema(self.columns))

    def write(self, spark: SparkSession, path: str) -> None:
        """Append the run to a CSV folder; the log of one run fits in one file."""
        self.frame(spark).coalesce(1).write.mode("append").csv(path, header=True, quote='"', escape='"')


def read_log(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read log CSVs with multi-line messages; header rows in the middle are left out."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.csv(path, schema=text, header=True, multiLine=True, quote='"', escape='"', enforceSchema=True)
    data = raw.filter(F.col(columns[0]) != columns[0])
    return data.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in log_schema(columns)])


LAYOUTS = (STAGING_COLUMNS, WAREHOUSE_COLUMNS, NOTEBOOK_COLUMNS)


def read_mixed_logs(spark: SparkSession, path: str) -> DataFrame:
    """Records of log files of any layout, headers anywhere: each record takes its columns from the last header above it.

    ``file, line`` (where the record begins), ``layout`` (its number of columns) and the columns of all
    layouts, null where a layout has none. A record goes on over line feeds inside quotes: it begins where the
    quotes of the lines before it are paired. Records above any header are left out. The lines of one file are put in
    order in one task: a file is the log of few runs.
    """
    lines = numbered_lines(spark, path)
    above = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    begins = F.coalesce(F.sum(quotes).over(above), F.lit(0)) % 2 == 0
    marked = lines.withColumn("begins", begins)
    header = F.lit(None).cast("int")
    for number, layout in enumerate(LAYOUTS):
        header = F.when(F.col("text") == ",".join(layout), number).otherwise(header)
    marked = marked.withColumn("header", F.when(F.col("begins"), header))
    marked = marked.select(
        "file", "line", "text", "header", F.max(F.when(F.col("begins"), F.col("line"))).over(upto).alias("record"),
        F.last("header", ignorenulls=True).over(upto).alias("layout"),
    )
    body = marked.filter("header IS NULL AND layout IS NOT NULL")
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda x: x["text"])
    records = body.groupBy("file", "record", "layout").agg(F.array_join(pieces, "\n").alias("text")).filter("text <> ''")
    every = list(dict.fromkeys(c for layout in LAYOUTS for c in layout))
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    out = records
    for number, layout in enumerate(LAYOUTS):
        fields = ", ".join(f"`{c}` string" for c in layout)
        out = out.withColumn(f"row{number}", F.when(F.col("layout") == number, F.from_csv("text", fields, options)))
    kinds = {f.name: f.dataType for f in log_schema(every).fields}
    value = lambda c: F.coalesce(*[F.col(f"row{n}.`{c}`") for n, layout in enumerate(LAYOUTS) if c in layout]).try_cast(kinds[c]).alias(c)
    size = F.element_at(F.array(*[F.lit(len(x)) for x in LAYOUTS]), F.col("layout") + 1)
    return out.select("file", F.col("record").alias("line"), size.alias("layout"), *[value(c) for c in every])
