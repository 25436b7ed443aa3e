"""File system questions and table scans."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# of the tables that loads and steps write: fewer bytes than the default for little more work
CODEC = "zstd"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _fs(spark, path)
    return fs.exists(hadoop_path)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names below a folder; empty when the folder is absent."""
    hadoop_path, fs = _fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def delete(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _fs(spark, path)
    fs.delete(hadoop_path, True)


def create_new(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file with its whole content; false, and nothing done, if there is one of that name.

    On a local disk a finished file is linked to the name, which fails if the name is taken. Elsewhere
    the file system's own create-without-overwrite decides, and a reader may meet the file before its end.
    """
    hadoop_path, fs = _fs(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    nio, data = spark._jvm.java.nio.file, content.encode()
    if fs.getScheme() == "file":
        target = nio.Path.of(fs.makeQualified(hadoop_path).toUri())
        draft = nio.Files.createTempFile(target.getParent(), ".draft", None, spark.sparkContext._gateway.new_array(nio.attribute.FileAttribute, 0))
        try:
            nio.Files.write(draft, data, spark.sparkContext._gateway.new_array(nio.OpenOption, 0))
            nio.Files.createLink(target, draft)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            nio.Files.deleteIfExists(draft)
    try:
        out = fs.create(hadoop_path, False)
    except Py4JJavaError as error:
        if fs.exists(hadoop_path):
            return False
        raise error
    out.write(data)
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    hadoop_path, fs = _fs(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def read_table(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def read_sheet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A spreadsheet saved as CSV with a header row; the types are given, never guessed."""
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, quote='"', escape='"')


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line, text`` of text files: every line with its number in its file, from 1.

    A split knows where in the file it begins; its lines are numbered in place, and shifted by the
    counts of the splits before it, a table of one row per split.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("text"),
    )
    counts = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    found = lines.join(starts, ["file", "block"])
    return found.select("file", (F.col("id") - F.col("first") + F.col("before") + 1).alias("line"), "text")


def read_sheet_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows of a sheet saved as CSV, and the rejected lines ``file, line, text``.

    A line is rejected if it has another number of fields than the header or a field that does not
    fit its type. One record is one line here; use :func:`read_sheet` where quoted fields hold line feeds.
    """
    reject = "_rejected"
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": reject, "quote": '"', "escape": '"'}
    body = numbered_lines(spark, path).filter((F.col("line") > 1) & (F.trim("text") != ""))
    parsed = body.select("file", "line", "text", F.from_csv("text", f"{names}, `{reject}` string", options).alias("row"))
    good = parsed.filter(f"row.`{reject}` IS NULL").select("file", "line", *[F.col(f"row.`{f.name}`") for f in schema.fields])
    return good, parsed.filter(f"row.`{reject}` IS NOT NULL").select("file", "line", "text")


def table_names(spark: SparkSession, folder: str) -> list[str]:
    return [n.removesuffix(".parquet") for n in list_names(spark, folder) if n.endswith(".parquet")]


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table; 0 when it is absent."""
    return spark.read.parquet(path).count() if exists(spark, path) else 0


def columns_of(df: DataFrame) -> DataFrame:
    """Name, type and number of filled rows of every column, in one pass."""
    cells = [
        F.struct(F.lit(i).alias("positie"), F.lit(f.name).alias("kolom"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.count(f.name).alias("gevuld"))
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def select_constants(df: DataFrame, **constants: tuple[object, str]) -> DataFrame:
    """Add literal columns as ``name=(value, type)``; the type keeps NULLs from spoiling a union."""
    return df.withColumns({c: F.lit(v).cast(t) for c, (v, t) in constants.items()})
