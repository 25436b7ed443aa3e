"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.sources import files

# Values every session needs for right results or for skewed data; sizes of
# shuffles and scans are left to the cluster's own defaults.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def get_session(app: str = "starling", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors reach")
    folder = tempfile.mkdtemp(prefix="starling-")
    context.setCheckpointDir(folder)
    return folder


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# largest join side sent to every executor, as rows times a generous row width
BROADCAST_BYTES = 64 * 2**20


def _bytes_of(column: Column, kind: T.DataType) -> Column:
    """Measured size of a value of any width."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(column) + 16
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType)):
        fields = len(kind.elementType.fields) if isinstance(kind.elementType, T.StructType) else 1
        if fields == 1 or not any(isinstance(f.dataType, (T.StringType, T.ArrayType)) for f in kind.elementType.fields):
            return F.size(column) * (8 * fields + 16) + 16
    # text form: longer than the value itself for numbers, names and marks included
    return 2 * F.octet_length(F.to_json(F.struct(column))) + 16


def measured_bytes(df: DataFrame) -> int:
    """Rows times 8 bytes per column of fixed width, plus the summed sizes of all others; one pass."""
    varying = [f for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))]
    if not varying:
        return df.count() * 8 * len(df.columns)  # a stored table's count comes from its file footers
    sizes = sum((F.coalesce(_bytes_of(F.col(f"`{f.name}`"), f.dataType), F.lit(16)) for f in varying), F.lit(8 * (len(df.columns) - len(varying))))
    return df.agg(F.sum(sizes.cast("long"))).first()[0] or 0


def fits_broadcast(df: DataFrame, base: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df``, of at most one row per row of the stored table ``base``, stays below ``max_bytes``.

    Columns that ``base`` stores are measured there; if ``df`` has others of varying width, ``df`` is measured.
    """
    stored = set(base.columns)
    inherited = all(c in stored for c in df.columns)
    fixed = all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) for f in df.schema.fields)
    if fixed:
        return base.count() * 8 * len(df.columns) <= max_bytes
    return measured_bytes(base.select(*(f"`{c}`" for c in df.columns)) if inherited else df) <= max_bytes


def broadcast_if_small(df: DataFrame, base: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a join side that has at most one row per row of ``base``, if that bounds its size.

    Joins inflate the optimizer's own estimate, which would shuffle the facts
    for a side of a few rows. Above the bound the side stays without hint and is
    shuffled, where a hot key gets split.
    """
    return F.broadcast(df) if fits_broadcast(df, base, max_bytes) else df


# rows of a join side that may pass through the driver where the optimizer wants it, and of one made of numbers only
SENT_ROWS, SENT_NUMBERS = 100_000, 500_000


def sent_if_few(df: DataFrame, rows: int) -> DataFrame:
    """A join side of at most ``rows`` rows: left to the optimizer when few, never broadcast when many.

    The optimizer goes by the size of compressed files, which say little of the rows they hold, and a load
    of many joins would send most of its dimensions through the driver. Joins of sorted sides get hot keys split.
    """
    return df if rows <= SENT_ROWS else df.hint("merge")


def broadcast_if_few(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a join side of at most ``rows`` rows of numbers when these are few, never when they are many."""
    return F.broadcast(df) if rows <= SENT_NUMBERS else df.hint("merge")


def stage(df: DataFrame, spread: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the
    optimizer true file sizes for what follows. ``spread`` names a column to
    hash small tables by, so that heavy work on few rows uses all cores.
    """
    spark = df.sparkSession
    staged = _written(df)
    cores = spark.sparkContext.defaultParallelism
    if spread and estimated_bytes(staged) < cores * 16 * 2**20:
        staged = _written(staged.repartition(cores, spread))
    return staged


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Staging for work that ends inside the block; its folder is removed afterwards."""
    folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
    try:
        yield lambda df: _written(df, folder)
    finally:
        files.delete(spark, folder)


def _written(df: DataFrame, folder: str | None = None) -> DataFrame:
    path = f"{folder or shared_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", files.CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
