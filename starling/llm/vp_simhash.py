"""SimHash near-duplicates through vantage-point trees.

Cut 64 bits into ``bits + 2`` blocks: two fingerprints that differ in at most ``bits`` bits agree
in two blocks at least. So each distinct fingerprint is filed once under every two of its
blocks (15 times at 4 bits, about 21 exact bits each), and linked pairs share a bucket. In a
bucket a vantage-point tree over the Hamming distance of whole fingerprints is grown: a node
sends a fingerprint to its near or far side by its distance from a vantage point, and a query
goes, by the triangle inequality, to both sides where it lies within ``bits`` of the border.
Every linked pair is compared somewhere, so the links are exact.

Buckets are dealt out to shards of a stated size by their hash. A bucket that would fill more
than one shard is cut by the upper levels of its own tree, its fingerprints at home in one
shard and visitors of the shards whose border they overlap. Which buckets these are, and
their vantage points, come from a bounded sample of fingerprints (``Config.sample``): it decides
the balance of the shards and nothing else.

A shard never lists its pairs: it returns a spanning forest of its links, and dense groups
are joined to few pivots first. Exact copies share one fingerprint and cost one row. Nodes of
the links are ordered by the smallest document id of their fingerprint, so a component's
root names it.

Empty and null texts have fingerprint zero and link like any other. Null ids never name a
component unless it has no other. Repeated rows stay, an empty table gives an empty result,
other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from starling.llm import text as T
from starling.llm.components import components
from starling.llm.text import quoted, unused
from starling.session import broadcast_if_small, scratch

BITS, SEED = 64, 42
SMALL = 32  # fingerprints of a bucket that are compared without a tree


@dataclass(frozen=True)
class Config:
    shingle: int = 4
    bits: int = 4
    shard: int = 131_072  # filed fingerprints aimed at per shard
    sample: int = 16_384  # fingerprints that name the hot buckets and cut them
    leaf: int = 1 << 15  # pairs that a leaf compares outright


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """64-bit SimHash of each text; ASCII letters lower-cased, every shingle counts as often as it occurs."""
    digest, hashes, counts = xxhash.xxh64_intdigest, [], np.zeros(len(texts), dtype=np.int64)
    for i, t in enumerate(texts):
        words = t.lower().split()
        if not words:
            continue
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        n = max(1, len(words) - shingle + 1)
        last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
        hashes.append(np.array([digest(line[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())], dtype=np.uint64))
        counts[i] = n
    out = np.zeros(len(texts), dtype=np.uint64)
    if hashes:
        full = np.flatnonzero(counts)
        bits = np.unpackbits(np.concatenate(hashes).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        at = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
        ones = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > counts[full][:, None], axis=1).reshape(-1).view(">u8").astype(np.uint64)
    return out


def fingerprint_udf(shingle: int):
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            texts = [(t or "").encode() for t in column]
            parts = [fingerprints(texts[i:j], shingle) for i, j in T.slices(texts)]
            yield pd.Series(np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64))

    return run


# buckets


def pairs_of_blocks(bits: int) -> list[tuple[np.uint64, int]]:
    """A mask and a number for every two of ``bits + 2`` nearly equal blocks."""
    edges = [round(i * BITS / (bits + 2)) for i in range(bits + 3)]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    return [(np.uint64(a | b), n) for n, (a, b) in enumerate(itertools.combinations(masks, 2))]


def buckets(prints: np.ndarray, mask: np.uint64, number: int) -> np.ndarray:
    """The bucket of each fingerprint for one pair of blocks; that two buckets collide costs time only."""
    return T.mixed((prints & mask) + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64))


# the tree


def _split(values: np.ndarray, others: np.ndarray, bits: int, least: float) -> tuple[np.uint64, int] | None:
    """The vantage point and border that leave the fewest pairs; none if not below ``least`` of all."""
    best, found = least * len(values) * len(others), None
    for vantage in dict.fromkeys(values[[0, len(values) // 3, 2 * len(values) // 3, -1]].tolist()):
        inner, outer = (np.bitwise_count(x ^ np.uint64(vantage)) for x in (values, others))
        near, visit = (np.cumsum(np.bincount(x, minlength=BITS + 2 * bits + 2)) for x in (inner, outer))
        border = np.arange(BITS)
        before = np.where(border >= bits, visit[np.maximum(border - bits, 0)], 0)  # at most border - bits away
        pairs = near[border] * visit[border + bits] + (len(values) - near[border]) * (len(others) - before)
        at = int(pairs.argmin())
        if pairs[at] < best and 0 < near[at] < len(values):
            best, found = pairs[at], (np.uint64(vantage), at)
    return found


def grow(values: np.ndarray, bits: int, size: float):
    """Nested (vantage, border, near, far) down to ``size`` sampled values; a leaf is None."""
    found = _split(values, values, bits, 0.8) if len(values) > size else None
    if not found:
        return None
    vantage, border = found
    near = np.bitwise_count(values ^ vantage) <= border
    return vantage, border, grow(values[near], bits, size), grow(values[~near], bits, size)


def route(tree, values: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Leaf number, indices that must be there, and whether each is at home there."""
    stack, leaves = [(tree, np.arange(len(values)), np.ones(len(values), dtype=bool))], 0
    while stack:
        node, rows, home = stack.pop()
        if node is None:
            yield leaves, rows, home
            leaves += 1
            continue
        vantage, border, near, far = node
        distance = np.bitwise_count(values[rows] ^ vantage).astype(np.int64)
        for side, reach, own in ((near, distance <= border + bits, distance <= border), (far, distance > border - bits, distance > border)):
            stack.append((side, rows[reach], home[reach] & own[reach]))


def leaves(tree) -> int:
    return 1 if tree is None else leaves(tree[2]) + leaves(tree[3])


class Shards:
    """Where filed fingerprints go: a bucket's shard by its hash, a hot bucket's by its own tree."""

    def __init__(self, sample: np.ndarray, total: int, config: Config):
        self.bits, self.pairs = config.bits, pairs_of_blocks(config.bits)
        self.count = max(1, math.ceil(total * len(self.pairs) / config.shard))
        self.hot: dict[int, tuple[object, int]] = {}  # bucket: its tree and the number of its first shard
        drawn, following = config.shard * len(sample) / max(1, total), self.count
        for mask, number in self.pairs if total > config.shard else ():
            keys = buckets(sample, mask, number)
            found, counts = np.unique(keys, return_counts=True)
            for key in found[counts > max(1.0, drawn)].tolist():
                tree = grow(sample[keys == np.uint64(key)], config.bits, max(16.0, drawn))
                self.hot[key] = (tree, following)
                following += leaves(tree)
        self.hot_keys = np.array(sorted(self.hot), dtype=np.uint64)

    def of(self, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Shards, buckets, indices and whether at home, for all pairs of blocks."""
        for mask, number in self.pairs:
            keys = buckets(prints, mask, number)
            hot = np.isin(keys, self.hot_keys)
            rows = np.flatnonzero(~hot)
            yield (keys[rows] % np.uint64(self.count)).astype(np.int64), keys[rows], rows, np.ones(len(rows), dtype=bool)
            for key in np.unique(keys[hot]).tolist():
                members = np.flatnonzero(keys == np.uint64(key))
                tree, first = self.hot[key]
                for leaf, inside, home in route(tree, prints[members], self.bits):
                    rows = members[inside]
                    yield np.full(len(rows), first + leaf), keys[rows], rows, home


class Forest:
    """Union of indices, by arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.waiting.append((a, b))
        self.size += len(a)
        if self.size > 1 << 20:
            self.settle()

    def settle(self) -> np.ndarray:
        if self.waiting:
            a, b = (np.concatenate(x) for x in zip(*self.waiting))
            self.waiting, self.size = [], 0
            while True:
                ra, rb = self.root[a], self.root[b]
                apart = ra != rb
                if not apart.any():
                    break
                a, b = a[apart], b[apart]
                np.minimum.at(self.root, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
                while not np.array_equal(up := self.root[self.root], self.root):
                    self.root = up
        return self.root


def compare_bucket(prints: np.ndarray, home: np.ndarray, own: np.ndarray, forest: Forest, bits: int, leaf: int) -> None:
    """Add a spanning set of the links that touch a home fingerprint, among the indices ``own`` of one bucket."""

    def compare(points: np.ndarray, others: np.ndarray) -> None:
        step = max(1, (1 << 21) // max(1, len(others)))
        for i in range(0, len(points), step):
            part = points[i : i + step]
            x, y = np.nonzero(np.bitwise_count(prints[part][:, None] ^ prints[others][None, :]) <= bits)
            keep = part[x] != others[y]
            forest.add(part[x][keep], others[y][keep])

    def compare_dense(points: np.ndarray, others: np.ndarray) -> None:
        # a few pivots join most of a dense group; pairs inside the largest group need no look
        for pivot in points[:: max(1, len(points) // 32)]:
            near = others[np.bitwise_count(prints[others] ^ prints[pivot]) <= bits]
            forest.add(near, np.full(len(near), pivot))
        root = forest.settle()
        groups, counts = np.unique(root[others], return_counts=True)
        largest = groups[counts.argmax()]
        inside, around = root[points] == largest, root[others] == largest
        compare(points[~inside], others)
        compare(points[inside], others[~around])

    stack = [(own[home[own]], own)]
    while stack:
        points, others = stack.pop()
        if not len(points):
            continue
        found = _split(prints[points], prints[others], bits, 0.75) if len(points) * len(others) > leaf else None
        if found:
            vantage, border = found
            inner, outer = (np.bitwise_count(prints[x] ^ vantage).astype(np.int64) for x in (points, others))
            stack.append((points[inner <= border], others[outer <= border + bits]))
            stack.append((points[inner > border], others[outer > border - bits]))
        elif len(points) * len(others) > 1 << 22:
            compare_dense(points, others)
        else:
            compare(points, others)


def linked(prints: np.ndarray, keys: np.ndarray, home: np.ndarray, bits: int, leaf: int) -> np.ndarray:
    """Root index of each filed fingerprint in a spanning forest of the links inside buckets."""
    forest, order = Forest(len(prints)), np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    starts = np.concatenate(([0], cuts)).astype(np.int64)
    sizes = np.diff(np.concatenate((starts, [len(order)])))
    for n in np.flatnonzero(sizes > SMALL):
        compare_bucket(prints, home, order[starts[n] : starts[n] + sizes[n]], forest, bits, leaf)
    # small buckets, all at once: each fingerprint with the one that stands d places on in its bucket
    left = np.repeat(np.where(sizes <= SMALL, sizes, 0), sizes) - (np.arange(len(order)) - np.repeat(starts, sizes))
    at = np.arange(len(order))
    for d in range(1, SMALL):
        at = at[left[at] > d]
        if not len(at):
            break
        a, b = order[at], order[at + d]
        near = (np.bitwise_count(prints[a] ^ prints[b]) <= bits) & (home[a] | home[b])
        forest.add(a[near], b[near])
    return forest.settle()


# the operator


def links(distinct: DataFrame, config: Config = Config()) -> DataFrame:
    """``(a, b)``: a spanning set of the links between the rows of ``distinct(fp, least)``, a written table.

    Both are structs of (has no id, smallest id, fingerprint).
    """
    if config.bits + 2 > BITS:
        raise ValueError(f"at most {BITS - 2} bits")
    total = distinct.count()
    # fingerprints whose hash is small enough: about Config.sample of them, whatever their number
    drawn = distinct.filter(F.xxhash64("fp") / 2.0**63 <= min(1.0, 2 * config.sample / max(1, total) - 1)).select("fp").collect()
    shards = Shards(np.array(sorted(r["fp"] for r in drawn), dtype=np.int64).view(np.uint64), total, config)
    key = distinct.schema["least"].dataType.simpleString()
    names = ["shard", "bucket", "home", "fp", "least"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for shard, keys, rows, home in shards.of(prints.view(np.uint64)):
                if len(rows):
                    least = batch.column(1).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(keys.view(np.int64)), pa.array(home), pa.array(prints[rows]), least], names=names)

    def search(shard: pa.Table) -> pa.Table:
        prints = shard.column("fp").to_numpy()
        root = linked(prints.view(np.uint64), shard.column("bucket").to_numpy(), shard.column("home").to_numpy(), config.bits, config.leaf)
        joined = np.flatnonzero((root != np.arange(len(root))) & (prints != prints[root]))
        least = shard.column("least")
        return pa.table({
            "a_least": least.take(pa.array(joined)), "a_fp": prints[joined], "b_least": least.take(pa.array(root[joined])), "b_fp": prints[root[joined]],
        })

    dealt = distinct.select("fp", "least").mapInArrow(deal, f"shard long, bucket long, home boolean, fp long, least {key}")
    found = dealt.groupBy("shard").applyInArrow(search, f"a_least {key}, a_fp long, b_least {key}, b_fp long")
    node = lambda x: F.struct(F.col(f"{x}_least").isNull().alias("none"), F.col(f"{x}_least").alias("least"), F.col(f"{x}_fp").alias("fp")).alias(x)
    return found.select(node("a"), node("b"))


def classes(prints: DataFrame, keep, config: Config = Config()) -> DataFrame:
    """``(fp, root, component_id)`` for each fingerprint of ``prints(doc_id, fp)``; ``root`` is a fingerprint."""
    owners = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(owners, config), keep)
    roots = roots.select(F.col("node.fp").alias("fp"), F.col("root.fp").alias("root"), F.col("root.least").alias("first"))
    rooted = owners.join(roots, "fp", "left")
    return keep(rooted.select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("first")).alias("component_id")
    ))


def near_duplicates(documents: DataFrame, config: Config = Config()) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    with scratch(documents.sparkSession) as keep:
        prints = keep(documents.select("doc_id", fingerprint_udf(config.shingle)(T.text_or_empty()).alias("fp")))
        found = prints.join(classes(prints, keep, config), "fp")
        return T.staged(found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"), "classes")


def one_of_each(documents: DataFrame, config: Config = Config()) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest id, a null id last.

    Rows of the group that share this id are told apart by digests of their text and of all their columns; of
    rows equal in all of them one stays.
    """
    # columns of map type cannot be hashed; rows that differ in such a column alone count as equal
    hashed = [f.name for f in documents.schema.fields if not isinstance(f.dataType, MapType)]
    digest = lambda of: F.xxhash64(*(of[quoted(c)] for c in hashed))
    with scratch(documents.sparkSession) as keep:
        prints = keep(documents.select(
            "doc_id", fingerprint_udf(config.shingle)(T.text_or_empty()).alias("fp"),
            F.xxhash64(T.text_or_empty()).alias("text_key"), digest(documents).alias("row_key"),
        ))
        member = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_key", "row_key")
        grouped = prints.join(classes(prints, keep, config), "fp").groupBy("root").agg(F.min(member).alias("first"))
        chosen = T.staged(grouped.select(F.col("first.doc_id").alias("id"), F.col("first.row_key").alias("key")), "chosen")
        again = prints.groupBy("doc_id", "row_key").count().filter("count > 1").limit(1).count()
    chosen = chosen.select(*(F.col(c).alias(unused(c, documents)) for c in chosen.columns))
    one, key = (chosen[c] for c in chosen.columns)
    same = documents["doc_id"].eqNullSafe(one) & (digest(documents) == key)
    kept = documents.join(broadcast_if_small(chosen, chosen), same, "left_semi")
    # only a table that repeats whole rows has to move its texts
    return kept.dropDuplicates(hashed) if again else kept
