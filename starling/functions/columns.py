"""Keys, change tests and value rules as plain column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(names: Sequence[str]) -> list[Column]:
    """Columns as doubles ``x0, x1, ...``: names that feature assemblers accept."""
    return [named(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]


def business_key(*parts: str | Column) -> Column:
    """Natural attributes joined by ``_``; a missing part reads ``None``, so a key is never NULL."""
    texts = [F.coalesce(col_of(p).cast("string"), F.lit("None")) for p in parts]
    return F.concat_ws("_", *texts)


def source_key(prefix: str, number: str | Column) -> Column:
    """Source-qualified key; NULL number gives a NULL key."""
    return F.concat(F.lit(prefix), col_of(number).cast("string"))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def is_changed(left: str, right: str, tracked: Sequence[str]) -> Column:
    """True when any tracked column differs between two aliases; typed and null-safe."""
    return any_of([~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in tracked])


def any_null(names: Sequence[str]) -> Column:
    return any_of([F.col(c).isNull() for c in names])


def map_values(c: str | Column, mapping: Mapping[object, object]) -> Column:
    """Literal value mapping; a value outside the mapping gives NULL."""
    column = col_of(c)
    out = F.lit(None)
    for key, value in reversed(list(mapping.items())):
        out = F.when(column == F.lit(key), F.lit(value)).otherwise(out)
    return out


def replace_value(c: str | Column, old: object, new: object) -> Column:
    column = col_of(c)
    return F.when(column == F.lit(old), F.lit(new)).otherwise(column)


def full_name(first: str | Column, last: str | Column) -> Column:
    """First and last name with a space; NULL when either part is missing."""
    return F.concat(col_of(first), F.lit(" "), col_of(last))


def to_number(c: str | Column) -> Column:
    """Text to double; text that is no number gives NULL."""
    return col_of(c).try_cast("double")


def flag_contains(c: str | Column, word: str, yes: str = "Ja", no: str = "Nee") -> Column:
    return F.when(F.contains(col_of(c), F.lit(word)), yes).otherwise(no)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)
