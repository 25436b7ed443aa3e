"""Column expressions over long arrays and texts whose cost grows with their length, not its square."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 64  # elements summed at once
PIECE = 256  # code points of a piece of text
LEVELS = 3  # CHUNK ** (LEVELS + 1) elements, before cost grows faster than they do


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it, inside lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def before(values: Column, op: Callable[[Column, Column], Column], zero: Column) -> Column:
    """For each element the ``op`` (associative) of all elements before it, ``zero`` for the first."""

    def plain(v: Column) -> Column:
        return F.transform(v, lambda _, i: F.aggregate(F.slice(v, F.lit(1), i), zero, op))

    def level(v: Column, depth: int) -> Column:
        if not depth:
            return plain(v)
        number = F.greatest(F.floor((F.size(v) - 1) / CHUNK), F.lit(0)).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), number), lambda k: F.slice(v, k * CHUNK + 1, F.lit(CHUNK)))

        def joined(cs: Column) -> Column:
            sums = F.transform(cs, lambda c: F.aggregate(c, zero, op))
            bases = let(sums, lambda s: level(s, depth - 1))
            return F.flatten(F.zip_with(cs, bases, lambda c, b: F.transform(c, lambda _, j: op(b, F.aggregate(F.slice(c, F.lit(1), j), zero, op)))))

        return let(chunks, joined)

    return let(values, lambda v: F.when(F.size(v) <= CHUNK, plain(v)).otherwise(level(v, LEVELS)))


def sums_before(values: Column) -> Column:
    return before(values, lambda a, b: a + b, F.lit(0))


def pieces_of(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, for ``cut``."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(pieces: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of a text in pieces; reads no more than them and two pieces."""
    first = F.floor(start / PIECE).cast("int")
    number = F.floor((end - 1) / PIECE).cast("int") - first + 1
    joined = F.array_join(F.slice(pieces, first + 1, number), "")
    return F.when(end > start, F.substring(joined, start % PIECE + 1, end - start)).otherwise(F.lit(""))
