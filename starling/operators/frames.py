"""Frame manipulation with explicit row ids in place of positions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions.columns import is_numeric


def side_by_side(frames: Sequence[DataFrame], row_id: str) -> DataFrame:
    """Put frames next to each other by row id; a row absent from one side gets NULLs."""
    return reduce(lambda a, b: a.join(b, row_id, "full_outer"), frames)


def append_row(df: DataFrame, **values: object) -> DataFrame:
    """Add one row; columns not given are NULL."""
    row = [values.get(c) for c in df.columns]
    return df.unionByName(df.sparkSession.createDataFrame([row], T.StructType(
        [T.StructField(f.name, f.dataType) for f in df.schema.fields]
    )))


def add_listed(df: DataFrame, row_id: str, name: str, values: dict[object, object], dtype: str) -> DataFrame:
    """Add a column from a literal ``{row id: value}`` listing."""
    schema = T.StructType([df.schema[row_id], T.StructField(name, T._parse_datatype_string(dtype))])
    return df.join(df.sparkSession.createDataFrame(list(values.items()), schema), row_id, "left")


def drop_rows(df: DataFrame, row_id: str, ids: Sequence[object]) -> DataFrame:
    return df.filter(~F.col(row_id).isin(list(ids)))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]


def other_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not is_numeric(f.dataType)]
