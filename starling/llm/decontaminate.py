"""Benchmark decontamination: SimHash of item-sized windows, found through Hamming blocks.

A window of a document has as many word shingles as a benchmark item. It is a leak of the
item when their 64-bit SimHashes differ in at most ``radius`` bits and the similarity of
their shingles, weighted by how often each occurs, reaches ``similarity``. The hash is cut
into ``blocks`` blocks: by the pigeonhole principle a window within the radius differs from
the item in at most ``radius // blocks`` bits of one block at least. The smaller side, items
or windows, is filed under every value so near each of its blocks, and a join on (size,
block, value) finds every such window. With 4 blocks of 16 bits and a radius of 15 that is
3 bits, 697 values a block, and about 4 % of unrelated pairs.

Windows are fingerprinted only where the last check can still pass. A similarity of s over
m shingles on either side needs 2ms / (1 + s) shared ones, so every window that holds that
many shingles of the item is looked at, wherever it begins, and no other: no leak is lost
by it. A passage has few more such windows than it has shingles to spare.

DataFrame functions only. Words are runs of letters and digits, lower-cased; a document with
fewer words than a shingle is one shingle of all its words. Items with fewer words than a
shingle cannot be told from ordinary phrases and match nothing, as do null and empty
texts. Equal items are one item with the smallest id; in the list of leaks rows that share a
document id, a null one included, are one document. ``clean`` decides rows with a null id by their text.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T
from starling.session import broadcast_if_small, scratch

BITS = 64


@dataclass(frozen=True)
class Config:
    shingle: int = 5
    similarity: float = 0.8
    radius: int = 15
    blocks: int = 4


def words_of(text: str = "text") -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, in order; of all words if there are fewer; none without words."""
    count = F.size(words)
    whole = F.transform(
        F.sequence(F.lit(1), F.greatest(count - size + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, size))
    )
    return F.when(count > 0, whole).otherwise(F.array().cast("array<long>"))


def simhash(hashes: str) -> Column:
    """Bit b is set when more than half of the hashes have it set."""
    return F.expr(
        f"aggregate(sequence(0, {BITS - 1}), 0L, (f, b) -> f | if("
        f"2 * aggregate({hashes}, 0, (n, h) -> n + cast(shiftright(h, b) & 1L as int)) > size({hashes}), shiftleft(1L, b), 0L))"
    )


def blocks_of(fingerprint: str, count: int, near: int = 0) -> Column:
    """``count`` nearly equal cuts of a fingerprint, each with its number; for each all values within ``near`` bits."""
    edges = [round(i * BITS / count) for i in range(count + 1)]
    cuts = []
    for number, (low, high) in enumerate(zip(edges, edges[1:])):
        value = F.expr(f"shiftrightunsigned({fingerprint}, {low}) & {(1 << (high - low)) - 1}L")
        flips = [sum(1 << b for b in bits) for n in range(near + 1) for bits in itertools.combinations(range(high - low), n)]
        values = F.transform(F.array(*map(F.lit, flips)).cast("array<long>"), lambda x: value.bitwiseXOR(x))
        cuts.append(F.transform(values, lambda v: F.struct(F.lit(number).alias("block"), v.alias("value"))))
    return F.flatten(F.array(*cuts))


def near_pairs(windows: DataFrame, items: DataFrame, config: Config, keep) -> DataFrame:
    """``m, print, item_id, distance`` of all pairs of written ``windows(m, print)`` and ``items(m, item_print, item_id)`` within the radius."""
    listed = items.select("m", "item_print").distinct()
    few_items, near = listed.count() <= windows.count(), config.radius // config.blocks
    cut = lambda frame, name, n: frame.withColumn("cut", F.explode(blocks_of(name, config.blocks, n))).select("m", name, "cut.block", "cut.value")
    left, right = cut(windows, "print", 0 if few_items else near), cut(listed, "item_print", near if few_items else 0)
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    # the planner does not see how many rows a fingerprint is filed as: never broadcast them on its word
    found = left.join(right.hint("merge"), ["m", "block", "value"]).withColumn("distance", distance).filter(F.col("distance") <= config.radius)
    found = found.select("m", "print", "item_print", "distance").distinct()
    return found.join(items.select("m", "item_print", "item_id"), ["m", "item_print"]).select("m", "print", "item_id", "distance")


def _weighted_overlap(window: str, item: str) -> Column:
    return F.expr(
        f"aggregate(array_distinct({item}), 0, (n, s) -> n + least("
        f"size(filter({window}, x -> x = s)), size(filter({item}, x -> x = s))))"
    )


def items_of(benchmark: DataFrame, config: Config) -> DataFrame:
    """One row per distinct item: ``item_id, hashes, m`` (number of shingles), ``item_print``."""
    words = words_of()
    items = benchmark.select("item_id", words.alias("words")).filter(F.size("words") >= config.shingle)
    items = items.groupBy("words").agg(F.min("item_id").alias("item_id"))
    items = items.select("item_id", shingles_of(F.col("words"), config.shingle).alias("hashes"))
    return items.select("item_id", "hashes", F.size("hashes").alias("m"), simhash("hashes").alias("item_print"))


def windows_of(keyed: DataFrame, items: DataFrame, config: Config, keep) -> DataFrame:
    """Windows of ``keyed(key, hashes)`` that hold enough shingles of some item: ``key, m, at, width``."""
    terms = keep(items.select("item_id", "m", F.explode(F.array_distinct("hashes")).alias("hash")))
    # the outer form: from the plain one the optimizer infers a filter that computes the hashes a second time
    spots = keyed.select("key", F.size("hashes").alias("total"), F.posexplode_outer("hashes").alias("pos", "hash"))
    hits = spots.join(broadcast_if_small(terms, terms), "hash")
    lists = hits.groupBy("key", "item_id", "m", "total").agg(F.array_sort(F.collect_set("pos")).alias("spots"))
    # 2ms / (1 + s) for equal sizes; a document shorter than the item is one window of its own size
    lists = lists.withColumn("width", F.least("m", "total"))
    share = config.similarity / (1 + config.similarity)
    lists = lists.withColumn("need", F.ceil(share * (F.col("m") + F.col("width")) - 1e-9).cast("int"))
    # positions of distinct hits bound the shared shingles from above
    lists = lists.filter(F.size("spots") >= F.col("need"))
    # starts whose first hit is spots[i]: from after the hit before it, and late enough to reach the last needed hit
    ranges = F.expr(
        "transform(sequence(0, size(spots) - need), i -> struct("
        "greatest(coalesce(get(spots, i - 1) + 1, 0), spots[i + need - 1] - width + 1) as low, least(spots[i], total - width) as high))"
    )
    lists = lists.select("key", "m", "width", F.filter(ranges, lambda r: r["low"] <= r["high"]).alias("ranges"))
    starts = F.flatten(F.transform("ranges", lambda r: F.sequence(r["low"], r["high"])))
    return lists.select("key", "m", "width", F.explode(starts).alias("at")).distinct()


def _key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("key"), F.md5(text).alias("check"))


def _leaks(documents: DataFrame, benchmark: DataFrame, config: Config, keep) -> DataFrame:
    """``doc_id, key, item_id, similarity, distance, at`` of every window that leaks an item."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = documents.select(_key(text).alias("key"), "doc_id", "text")
    # words first, as a column of their own: each is computed once per text
    split = keyed.select("doc_id", "key", words_of().alias("words"))
    prints = split.select("doc_id", "key", shingles_of(F.col("words"), config.shingle).alias("hashes"))
    items = keep(items_of(benchmark, config))
    windows = keep(windows_of(prints.select("key", "hashes"), items, config, keep))

    # texts that hold a window, read again
    wanted = keep(windows.groupBy("key").agg(F.collect_set(F.struct("m", "at", "width")).alias("windows")))
    texts = keyed.join(broadcast_if_small(wanted, wanted), "key")
    cut = texts.select("doc_id", "key", "windows", words_of().alias("words")).select(
        "doc_id", "key", "windows", shingles_of(F.col("words"), config.shingle).alias("all")
    )
    found = cut.select("doc_id", "key", "all", F.explode("windows").alias("w")).select(
        "doc_id", "key", F.col("w.m").alias("m"), F.col("w.at").alias("at"), F.expr("slice(all, w.at + 1, w.width)").alias("hashes")
    )
    found = keep(found.withColumn("print", simhash("hashes")))
    near = near_pairs(keep(found.select("m", "print").distinct()), items, config, keep)

    # exact check
    sides = keep(items.select("item_id", F.col("hashes").alias("item")))
    pairs = found.join(near, ["m", "print"]).join(broadcast_if_small(sides, sides, 16 << 20), "item_id")
    pairs = pairs.withColumn("shared", _weighted_overlap("hashes", "item"))
    pairs = pairs.withColumn("similarity", F.col("shared") / (F.size("hashes") + F.size("item") - F.col("shared")))
    return pairs.filter(F.col("similarity") >= config.similarity)


def leaks(documents: DataFrame, benchmark: DataFrame, config: Config = Config()) -> DataFrame:
    """One row per document and item it leaks: ``doc_id, item_id, similarity, distance, first_word, n_windows``.

    ``similarity`` is the best of the item's windows, ``distance`` the smallest of those,
    ``first_word`` the first of those.
    """
    with scratch(documents.sparkSession) as keep:
        best = F.struct((-F.col("similarity")).alias("s"), "distance", "at")
        found = _leaks(documents, benchmark, config, keep).groupBy("doc_id", "item_id").agg(F.min(best).alias("best"), F.count("*").alias("n_windows"))
        return T.staged(found.select(
            "doc_id", "item_id", (-F.col("best.s")).alias("similarity"), F.col("best.distance").cast("int").alias("distance"),
            F.col("best.at").alias("first_word"), "n_windows",
        ), "leaks")


def clean(documents: DataFrame, benchmark: DataFrame, config: Config = Config()) -> DataFrame:
    """The documents that leak no item. Rows that share an id are one document; a row with a null id is decided by its text."""
    with scratch(documents.sparkSession) as keep:
        found = T.staged(_leaks(documents, benchmark, config, keep).select("doc_id", "key.key", "key.check").distinct(), "leaky")
    side = lambda rows, *names: rows.select(*(F.col(c).alias(T.unused(c, documents)) for c in names)).distinct()
    ids = side(found.filter("doc_id is not null"), "doc_id")
    kept = documents.join(broadcast_if_small(ids, ids), documents["doc_id"] == ids[ids.columns[0]], "left_anti")
    texts = side(found.filter("doc_id is null"), "key", "check")
    if texts.isEmpty():
        return kept
    text = F.when(documents["doc_id"].isNull(), F.coalesce(documents["text"], F.lit("")))
    key, check = (texts[c] for c in texts.columns)
    # rows with an id have null keys here and match nothing
    same = (F.when(text.isNotNull(), F.xxhash64(text)) == key) & (F.md5(text) == check)
    return kept.join(broadcast_if_small(texts, texts), same, "left_anti")
