"""Merkle manifest of a dataset, its levels kept as strings of hexadecimal digests.

A row's digest (leaf) covers its columns; leaves of one source stand in the order of their
ids. Every ``ARITY`` neighbours become their digest until one is left, the source's
subroot; the subroots, in the order of the source names, become the root the same way.

Leaves are dealt into aligned blocks of ``BLOCK`` places. A block holds each of its levels
as one string, digests side by side, so a parent is the digest of a fixed-width substring
and the siblings of a node are the substrings that flank it. The roots of the blocks are the
nodes of the next round of blocks, until every source fits one block. No block is larger
than ``BLOCK`` digests, whatever share of the rows one source or one id holds: places come
from a range partitioning by (source, id, leaf, row number), counts per partition and
source, and their running sums.

Order: null sources and null ids first, then sources by UTF-8 bytes and ids ascending; rows
with equal ids by their leaf; equal rows in any order, which changes no result. A null
column enters a leaf as ``-``. Empty and very long texts are values like others. Columns
beyond the five are ignored. An empty table gives no rows. The proof of a lone row is the
digest of the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T
from starling.llm.places import ranked
from starling.session import fits_broadcast, scratch

ARITY = 3
LEVELS = 5  # of a full block
BLOCK = ARITY**LEVELS
HEX = 64
PATH_BYTES = 64 * (ARITY - 1) * HEX  # no path is longer: 64 levels are more rows than a table can hold
BROADCAST_BYTES = 32 * 2**20
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(**changed: Column) -> Column:
    """Digest of a row: each column as its length in bytes, a colon and its value."""
    parts = []
    for name in COLUMNS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _digest(level: Column, start: Column, width: Column | int) -> Column:
    """The digests of a level that begin at a place."""
    return F.substring(level, (start * HEX + 1).cast("int"), F.lit(width * HEX) if isinstance(width, int) else (width * HEX).cast("int"))


def _parents(level: Column) -> Column:
    """The level above: digests of every ``ARITY`` neighbours."""
    runs = F.ceil(F.length(level) / (HEX * ARITY)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(_digest(level, i * ARITY, ARITY).cast("binary"), 256)), "")


def blocks(nodes: DataFrame, group: str, payload: list[str]) -> DataFrame:
    """Blocks of ``nodes(group, place, digest, payload)``: ``group, block, members, levels, top``.

    ``members`` are (place, payload) in order. A block climbs ``LEVELS`` levels, or until one
    digest is left where its group has no other block.
    """
    block = F.floor(F.col("place") / BLOCK).cast("long")
    member = F.struct((F.col("place") % BLOCK).cast("int").alias("place"), "digest", *payload)
    out = nodes.groupBy(F.col(group), block.alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    sizes = nodes.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_size"))
    out = out.join(F.broadcast(sizes) if fits_broadcast(sizes, sizes) else sizes, F.col(group).eqNullSafe(F.col("_g"))).drop("_g")
    out = out.withColumn("l0", F.array_join(F.transform("members", lambda m: m.digest), ""))
    for n in range(1, LEVELS + 1):
        below = F.col(f"l{n - 1}")
        done = (F.col("_size") <= BLOCK) & (F.length(below) <= HEX)
        out = out.withColumn(f"l{n}", F.when(~done & below.isNotNull(), _parents(below)))
    levels = [F.col(f"l{n}") for n in range(LEVELS + 1)]
    return out.select(
        group, "block", "_size", "members", F.array(*levels).alias("levels"), F.coalesce(*reversed(levels)).alias("top")
    )


def _climb(place: Column, levels: Column) -> Column:
    """What flanks the node at ``place`` and its ancestors: (left, right) for each level that has parents."""

    def flanks(level: Column, n: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(ARITY), n)).cast("int")
        run = (at - at % ARITY).cast("int")
        # a substring beyond the level's end is empty
        return F.struct(_digest(level, run, at - run).alias("left"), _digest(level, at + 1, run + ARITY - 1 - at).alias("right"))

    below = F.filter(levels, lambda level, n: F.get(levels, n + 1).isNotNull())
    return F.transform(below, flanks)


def climb(nodes: DataFrame, group: str, payload: list[str], keep) -> tuple[DataFrame, DataFrame]:
    """Reduce ``nodes(group, place, digest, payload)`` of every group to one digest.

    Returns ``(group, digest)`` and, for each node, ``(group, digest, payload, path)``: the flanks
    met on the way from the node to the digest of its group.
    """
    rounds = [keep(blocks(nodes, group, payload))]
    while rounds[-1].agg(F.max("block")).first()[0]:
        above = rounds[-1].select(group, F.col("block").alias("place"), F.col("top").alias("digest"), F.col("block").alias("child"))
        rounds.append(keep(blocks(above, group, ["child"])))
    tops = rounds[-1].select(group, F.col("top").alias("digest"))
    paths = None
    for n, held in reversed(list(enumerate(rounds))):
        names = ["digest", *payload] if n == 0 else ["child"]
        part = held.select(group, "block", F.explode("members").alias("m"), "levels")
        own = _climb(F.col("m.place"), F.col("levels"))
        if paths is None:
            part = part.select(group, *(F.col(f"m.{c}").alias(c) for c in names), own.alias("path"))
        else:
            up = paths.select(F.col(group).alias("_g"), F.col("child").alias("_b"), F.col("path").alias("_up"))
            up = F.broadcast(up) if held.count() * PATH_BYTES <= BROADCAST_BYTES else up
            part = part.join(up, F.col(group).eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b")))
            part = part.select(group, *(F.col(f"m.{c}").alias(c) for c in names), F.concat(own, "_up").alias("path"))
        paths = part
    return tops, paths


def folded(digest: Column, path: Column) -> Column:
    """The root that a node's digest and what flanks its way give."""
    return F.aggregate(path, digest, lambda h, s: F.sha2(F.concat(s.left, h, s.right).cast("binary"), 256))


def manifest(docs: DataFrame, tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """``doc_id, source, leaf, subroot, root, proof, folded_root`` for every row.

    ``proof`` holds the digests that flank the way to the root, left to right, level by level.
    ``folded_root`` is the root they give for the row as it stands after the replacements
    ``tampered`` (by column name) where ``where`` holds.
    """
    with scratch(docs.sparkSession) as keep:
        leaves = docs.select(
            "doc_id", "source", leaf_of().alias("leaf"),
            (F.when(where, leaf_of(**tampered)) if tampered else F.lit(None).cast("string")).alias("changed"),
        )
        leaves = keep(leaves.withColumn("number", F.monotonically_increasing_id()))
        placed = ranked(leaves, "source", ["doc_id", "leaf", "number"], keep)
        nodes = placed.select("source", "place", F.col("leaf").alias("digest"), "doc_id", "changed")
        subroots, paths = climb(nodes, "source", ["doc_id", "changed"], keep)
        tops = ranked(subroots.withColumn("all", F.lit(0)), "all", ["source"], keep)
        roots, upper = climb(tops, "all", ["source"], keep)
        roots = keep(roots.select("all", F.col("digest").alias("root")))
        upper = upper.join(F.broadcast(roots), "all").select(  # one row
            F.col("source").alias("_s"), F.col("digest").alias("subroot"), "root", F.col("path").alias("_up")
        )
        upper = keep(upper)
        side = F.broadcast(upper) if upper.count() * PATH_BYTES <= BROADCAST_BYTES else upper
        rows = paths.join(side, F.col("source").eqNullSafe(F.col("_s")))
        rows = rows.select("doc_id", "source", F.col("digest").alias("leaf"), "changed", "subroot", "root", F.concat("path", "_up").alias("path"))
        proof = F.array_join(F.transform("path", lambda s: F.concat(s.left, s.right)), "")
        out = rows.select(
            "doc_id", "source", "leaf", "subroot", "root", proof.alias("proof"),
            folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root"),
        )
        return T.staged(out, "manifest")
