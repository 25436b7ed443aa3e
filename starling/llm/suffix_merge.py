"""Removal of byte strings that occur twice, by a merge sort of suffixes that knows common prefixes.

A byte goes when some string of ``length`` bytes that covers it also starts elsewhere, in
the same text or another. Every such string has an anchor, the smallest hash of the
``gram``-byte strings inside it, which depends on its bytes alone. So equal strings hold equal
anchors at the same place, and anchors whose gram occurs once lead nowhere.

At the other anchors the suffix to the right and the reversed prefix to the left are cut to
the bytes a string through the anchor can reach. Each task sorts them into runs and front-codes
them: the length shared with the one before, then the rest. Runs are exchanged by gram. A
loser tree merges them; it compares shared lengths first and bytes only beyond those, and
returns the shared length of neighbours in the merged order. A string reaching o bytes to
the left of its anchor occurs twice exactly if two anchors share at least o bytes to the left
and ``length - o`` to the right, which both orders tell by counting.

Exact copies of a text are found by a digest first: all of them go, and one of them stands
for all in the sort. Equal surroundings of an anchor in a task are one entry of its run.

A gram with more than ``Config.hot`` anchors would make one task of its own, so its strings
are dealt out further: the bytes around each such anchor that hold the strings anchored there
are counted by a 128-bit digest, and where those bytes occur once the digests of their single
strings are. Both are counted before they are shuffled, and nothing is dropped. What shares a
frequent passage's inside is then one row a task, and what differs at its border is spread.

Null text counts as empty, and a text shorter than ``length`` loses nothing. Repeated rows
are copies of each other. Null ids stay, other columns are ignored, and an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm import text as T
from starling.session import broadcast_if_small, scratch

BROADCAST_BYTES = 64 << 20
SLICE = 512 << 10  # bytes of text that anchors are sought in at once


@dataclass(frozen=True)
class Config:
    length: int = 200
    gram: int = 64
    entries: int = 40_000  # anchors aimed at per merging task
    run: int = 40_000  # anchors sorted at once in a task
    hot: int = 40_000  # anchors of one gram that still meet in a merging task

    @property
    def reach(self) -> int:
        return self.length - self.gram


# anchors


def anchored(texts: list[bytes], config: Config) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and anchor of every string of the joined texts, and the gram hash of every byte."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n, window = len(data), config.reach + 1
    if n < config.length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # bytes up to the end of the text
    places = np.arange(n - config.gram + 1)
    hashes = T.RollingHash(data).of(places, places + config.gram)
    padded = -(-(n + window) // window) * window
    keys = np.full(padded, np.iinfo(np.uint64).max, dtype=np.uint64)
    # the smaller hash wins, of equal ones the leftmost
    keys[: len(places)] = (hashes >> np.uint64(32) << np.uint64(32)) | places.astype(np.uint64)
    keys[: len(places)][left[: len(places)] < config.gram] = np.iinfo(np.uint64).max
    # least key of each window, from running minima of blocks in both directions
    blocks = keys.reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = np.flatnonzero(left >= config.length)
    least = np.minimum(behind[starts], ahead[starts + window - 1])
    return starts, (least & np.uint64(0xFFFFFFFF)).astype(np.int64), hashes


def anchors(texts: list[bytes], config: Config) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, place and gram hash of the anchors of some texts."""
    _, anchor, hashes = anchored(texts, config)
    chosen = np.zeros(len(hashes), dtype=bool)
    chosen[anchor] = True
    at = np.flatnonzero(chosen)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    docs = np.searchsorted(ends, at, side="right")
    return docs, at - (ends - sizes)[docs], hashes[at]


# front-coded runs


def shared(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that agree up to ``start``."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_coded(strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Shared lengths, whole lengths, and the bytes after the shared ones, of a sorted list."""
    prefix = np.zeros(len(strings), dtype=np.uint16)
    rests, before = [], b""
    for i, s in enumerate(strings):
        prefix[i] = h = shared(before, s, 0)
        rests.append(s[h:])
        before = s
    sizes = np.fromiter(map(len, strings), np.uint16, len(strings))
    return prefix.tobytes(), sizes.tobytes(), b"".join(rests)


def decoded(prefix: bytes, sizes: bytes, rests: bytes) -> tuple[list[bytes], list[int]]:
    strings, before, at = [], b"", 0
    lengths = np.frombuffer(prefix, np.uint16).tolist()
    for h, size in zip(lengths, np.frombuffer(sizes, np.uint16).tolist()):
        before = before[:h] + rests[at : at + size - h]
        at += size - h
        strings.append(before)
    return strings, lengths


def merged(runs: list[tuple[list[bytes], list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Run, index in it, and length shared with the one before, in sorted order of all runs.

    A loser tree. Each contestant carries the length it shares with the last string that left
    the tree: the longer shares more and is smaller; only equals are compared, from there on.
    """
    count = 1 << max(0, (len(runs) - 1).bit_length())
    strings = [r[0] for r in runs] + [[]] * (count - len(runs))
    lengths = [r[1] for r in runs]
    index = [0] * count
    current: list[bytes | None] = [s[0] if s else None for s in strings]
    prefix = [0] * count  # of each run's current string
    losers = [0] * count

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = current[a], current[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        h = shared(x, y, prefix[a])
        if h == len(x) or (h < len(y) and x[h] < y[h]):
            prefix[b] = h
            return a, b
        prefix[a] = h
        return b, a

    def seed(node: int) -> int:
        if node >= count:
            return node - count
        winner, losers[node] = play(seed(2 * node), seed(2 * node + 1))
        return winner

    winner = seed(1)
    while current[winner] is not None:
        yield winner, index[winner], prefix[winner]
        index[winner] = i = index[winner] + 1
        if i < len(strings[winner]):
            current[winner], prefix[winner] = strings[winner][i], lengths[winner][i]
        else:
            current[winner] = None
        node = (count + winner) >> 1
        while node:
            winner, losers[node] = play(winner, losers[node])
            node >>= 1


RUN = pa.schema([
    ("part", pa.int32()), ("right_prefix", pa.binary()), ("right_size", pa.binary()), ("right_rest", pa.binary()),
    ("left_order", pa.binary()), ("left_prefix", pa.binary()), ("left_size", pa.binary()), ("left_rest", pa.binary()),
    ("weight", pa.binary()), ("entry", pa.binary()), ("owner", pa.binary()), ("place", pa.binary()), ("keys", pa.list_(pa.string())),
])
RUN_TYPES = ", ".join(f"{f.name} {'int' if f.name == 'part' else 'array<string>' if f.name == 'keys' else 'binary'}" for f in RUN)


def sorted_run(part: int, found: list[tuple[bytes, bytes, str, int, bool]]) -> dict:
    """One run: anchors' surroundings in right order, their left order, and who has them.

    ``found`` holds right suffix, reversed left prefix, text key, place, and whether the text
    is one of several copies; those count but need no answer.
    """
    found.sort(key=lambda f: (f[0], f[1]))
    rights: list[bytes] = []
    lefts: list[bytes] = []
    weight: list[int] = []
    entry: list[int] = []
    owner: list[int] = []
    place: list[int] = []
    keys: dict[str, int] = {}
    for right, left, key, at, copied in found:
        if rights and rights[-1] == right and lefts[-1] == left:
            weight[-1] = 2
        else:
            rights.append(right)
            lefts.append(left)
            weight.append(1)
        if not copied:
            entry.append(len(rights) - 1)
            owner.append(keys.setdefault(key, len(keys)))
            place.append(at)
    order = sorted(range(len(lefts)), key=lefts.__getitem__)
    right_run, left_run = front_coded(rights), front_coded([lefts[i] for i in order])
    packed = lambda values, kind=np.int32: np.array(values, dtype=kind).tobytes()
    return dict(zip(RUN.names, [
        part, *right_run, packed(order), *left_run, packed(weight, np.uint8), packed(entry), packed(owner), packed(place), list(keys)
    ]))


def _ordered(runs: list[tuple[list[bytes], list[int]]], bases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entry numbers, shared lengths and whole lengths, in merged order."""
    total = sum(len(r[0]) for r in runs)
    entries, prefix, sizes = (np.zeros(total, np.int64) for _ in range(3))
    for i, (run, at, h) in enumerate(merged(runs)):
        entries[i], prefix[i], sizes[i] = bases[run] + at, h, len(runs[run][0][at])
    return entries, prefix, sizes


def repeated_strings(runs: list[dict], config: Config) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Per run: text keys, and ``(owner, start, end)`` rows of the byte ranges that occur twice."""
    counts = [len(r["weight"]) for r in runs]
    bases, total = np.cumsum([0, *counts])[:-1], sum(counts)
    weight = np.concatenate([np.frombuffer(r["weight"], np.uint8) for r in runs]).astype(np.int64)
    rights, right_prefix, right_size = _ordered([decoded(r["right_prefix"], r["right_size"], r["right_rest"]) for r in runs], bases)
    lefts, left_prefix, left_size = _ordered([decoded(r["left_prefix"], r["left_size"], r["left_rest"]) for r in runs], bases)
    # the left runs list entries in an order of their own
    orders = np.concatenate([np.frombuffer(r["left_order"], np.int32) + base for r, base in zip(runs, bases)])
    lefts = orders[lefts]
    right_reach, left_reach = np.zeros(total, np.int64), np.zeros(total, np.int64)
    right_reach[rights], left_reach[lefts] = right_size, left_size

    twice = np.zeros((total, config.reach + 2), dtype=bool)  # by bytes to the left; the last column stays false
    right_class, left_class = np.zeros(total, np.int64), np.zeros(total, np.int64)
    for o in range(config.reach + 1):
        right_class[rights] = np.cumsum(right_prefix < config.length - o)
        left_class[lefts] = np.cumsum(left_prefix < o)
        can = (right_reach >= config.length - o) & (left_reach >= o)
        for classes in (right_class, left_class):
            can &= np.bincount(classes, weights=weight * can, minlength=total + 1)[classes] >= 2
        at = np.flatnonzero(can)
        both = right_class[at] * (total + 1) + left_class[at]
        _, inverse = np.unique(both, return_inverse=True)
        twice[at, o] = np.bincount(inverse, weights=weight[at])[inverse] >= 2 if len(at) else False

    edges = np.diff(twice.astype(np.int8), axis=1, prepend=0)
    entry, low = np.nonzero(edges == 1)
    high = np.nonzero(edges == -1)[1] - 1
    first = np.searchsorted(entry, np.arange(total + 1))
    for r, base in zip(runs, bases):
        members = np.frombuffer(r["entry"], np.int32) + base
        owner, place = np.frombuffer(r["owner"], np.int32), np.frombuffer(r["place"], np.int32)
        number = first[members + 1] - first[members]
        row = np.repeat(np.arange(len(members)), number)
        at = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + first[members][row]
        yield r["keys"], owner[row], np.stack([place[row] - high[at], place[row] - low[at] + config.length], axis=1)


def _united(ranges: np.ndarray) -> np.ndarray:
    """Disjoint ranges that do not touch, in order."""
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.concatenate(([True], ranges[1:, 0] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ranges) - 1]))
    return np.stack([ranges[new, 0], reach[last]], axis=1)


# the operator


def _keyed(documents: DataFrame) -> DataFrame:
    text = T.text_or_empty()
    return documents.select("doc_id", F.md5(text).alias("key"), text.alias("text"))


def _copies(documents: DataFrame, config: Config) -> DataFrame:
    """Digest and smallest id of every long enough text that more than one row has."""
    long = _keyed(documents).filter(F.octet_length("text") >= config.length)
    found = long.groupBy("key").agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).filter("n > 1")
    return T.staged(found.select("key", "first"), "copies")


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _hot_ranges(texts: DataFrame, config: Config, keep) -> DataFrame:
    """``(key, start, end)``: repeated strings anchored at ``hot_places`` of ``texts(key, text, copied, hot_places)``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, copied, places in zip(*(batch.column(i) for i in range(4))):
                data = text.as_py().encode()
                starts, anchor, _ = anchored([data], config)
                own = np.isin(anchor, np.array(places.as_py(), dtype=np.int64))
                if not own.any():
                    continue
                starts, anchor = starts[own], anchor[own]
                # the strings of one anchor begin in a row
                first = np.flatnonzero(np.diff(anchor, prepend=-1))
                last = np.append(first[1:], len(anchor)) - 1
                begins, ends = starts[first].tolist(), (starts[last] + config.length).tolist()
                around = [data[a:b] for a, b in zip(begins, ends)]
                # equal bytes hold equal strings, wherever their anchor lies
                yield pa.RecordBatch.from_arrays([
                    pa.array([key.as_py()] * len(around), pa.string()), pa.array([copied.as_py()] * len(around), pa.bool_()),
                    pa.array(begins, pa.int64()),
                    pa.array([_digest(w) for w in around], pa.binary()), pa.array(around, pa.binary()),
                ], names=["key", "copied", "start", "whole", "around"])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for whole, n, around in zip(*(batch.column(i) for i in range(3))):
                data = around.as_py()
                number = len(data) - config.length + 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([_digest(data[i : i + config.length]) for i in range(number)], pa.binary()),
                    pa.array([whole.as_py()] * number, pa.binary()), pa.array([n.as_py()] * number, pa.int64()),
                    pa.array(range(number), pa.int64()),
                ], names=["string", "whole", "n", "at"])

    source = texts.select("key", "text", "copied", "hot_places")
    found = keep(source.mapInArrow(cut, "key string, copied boolean, start long, whole binary, around binary"))
    wholes = found.groupBy("whole").agg(F.count("*").alias("n"), F.any_value("around").alias("around"))
    single = keep(wholes.mapInArrow(strings, "string binary, whole binary, n long, at long"))
    # one that stands for several counts as often; equal strings inside one stretch are two places
    twice = single.groupBy("string").agg(F.sum("n").alias("n")).filter("n > 1").select("string")
    twice = keep(twice)
    # the strings of one anchor overlap: from the first that occurs twice to the last, all goes
    hits = single.join(broadcast_if_small(twice, twice), "string").groupBy("whole").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    hits = keep(hits)
    wanted = found.filter("not copied").select("key", "start", "whole").join(broadcast_if_small(hits, hits), "whole")
    low, high = F.col("start") + F.col("low"), F.col("start") + F.col("high") + config.length
    return wanted.select("key", low.alias("start"), high.alias("end"))


def repeated_ranges(documents: DataFrame, copies: DataFrame, config: Config = Config()) -> DataFrame:
    """``(key, ranges)``: disjoint byte ranges of the texts without copies that occur twice; staged."""
    with scratch(documents.sparkSession) as keep:
        return T.staged(_repeated_ranges(documents, copies, config, keep), "ranges")


def _repeated_ranges(documents: DataFrame, copies: DataFrame, config: Config, keep) -> DataFrame:
    spark = documents.sparkSession
    keyed = _keyed(documents).filter(F.octet_length("text") >= config.length)
    kept = keyed.join(broadcast_if_small(copies.withColumn("copied", F.lit(True)), copies), "key", "left")
    kept = kept.filter(F.col("copied").isNull() | F.col("doc_id").eqNullSafe(F.col("first")))
    kept = kept.select("key", "text", F.coalesce("copied", F.lit(False)).alias("copied"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), T.byte_texts(batch.column(1))
            for i, j in T.slices(texts, SLICE):
                docs, places, hashes = anchors(texts[i:j], config)
                offsets = pa.array(np.searchsorted(docs, np.arange(j - i + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (places.astype(np.int32), hashes.view(np.int64))]
                yield pa.RecordBatch.from_arrays([keys.slice(i, j - i), *lists], names=["key", "places", "hashes"])

    found = keep(kept.select("key", "text").mapInArrow(find, "key string, places array<int>, hashes array<long>"))
    often = found.select(F.explode("hashes").alias("hash")).groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
    often = keep(often.select("hash", (F.col("n") > config.hot).alias("hot")))
    spots = found.select("key", F.explode(F.arrays_zip("places", "hashes")).alias("a")).select("key", F.col("a.places").alias("place"), F.col("a.hashes").alias("hash"))
    spots = spots.join(broadcast_if_small(often, often), "hash").groupBy("key").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("place"))).alias("places"),
        F.collect_set(F.when(F.col("hot"), F.col("place"))).alias("hot_places"),
    )
    spots = keep(spots)
    sums = [F.coalesce(F.sum(F.size(c)), F.lit(0)) for c in ("places", "hot_places")]
    total, hot, texts = spots.agg(*sums, F.count("*")).first()
    parts = max(T.partitions(spark), -(-total // config.entries))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[bytes, bytes, str, int, bool]]] = {}
        size = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for part, entries in waiting.items():
                yield pa.RecordBatch.from_pylist([sorted_run(part, entries)], schema=RUN)
            waiting.clear()

        for batch in batches:
            for key, text, copied, places in zip(*(batch.column(i) for i in range(4))):
                key, data, copied = key.as_py(), text.as_py().encode(), copied.as_py()
                for at in places.as_py():
                    part = zlib.crc32(data[at : at + config.gram]) % parts
                    around = (data[at : at + config.length], data[max(0, at - config.reach) : at][::-1], key, at, copied)
                    waiting.setdefault(part, []).append(around)
                    size += 1
                if size >= config.run:
                    yield from emit()
                    size = 0
        yield from emit()

    def merge(_: tuple, table: pa.Table) -> pa.Table:
        keys, starts, ends = [], [], []
        for names, owner, ranges in repeated_strings(table.to_pylist(), config):
            keys += [names[i] for i in owner.tolist()]
            starts.append(ranges[:, 0])
            ends.append(ranges[:, 1])
        return pa.table({"key": pa.array(keys, pa.string()), "start": pa.array(np.concatenate(starts), pa.int64()), "end": pa.array(np.concatenate(ends), pa.int64())})

    small = (total + hot) * 4 + texts * 64 <= BROADCAST_BYTES
    side = F.broadcast(spots) if small else spots
    exchanged = kept.join(side, "key").select("key", "text", "copied", "places").mapInArrow(runs, RUN_TYPES)
    ranges = exchanged.repartition(parts, "part").groupBy("part").applyInArrow(merge, "key string, start long, end long")
    if hot:
        ranges = ranges.unionByName(_hot_ranges(kept.join(side, "key").filter(F.size("hot_places") > 0), config, keep))
    grouped = ranges.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            lists = [_united(np.array([(r["start"], r["end"]) for r in found.as_py()], dtype=np.int64)) for found in batch.column(1)]
            united = pa.array([[{"start": a, "end": b} for a, b in found.tolist()] for found in lists], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), united], names=["key", "ranges"])

    # strings through neighbouring anchors overlap: a text is left with few ranges
    return grouped.mapInArrow(unite, "key string, ranges array<struct<start:long,end:long>>")


def removed(documents: DataFrame, config: Config = Config(), with_bytes: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if wanted, the kept ``bytes`` of every row."""
    copies = _copies(documents, config)
    ranges = repeated_ranges(documents, copies, config)
    total, texts = ranges.agg(F.coalesce(F.sum(F.size("ranges")), F.lit(0)), F.count("*")).first()
    side = F.broadcast(ranges) if total * 24 + texts * 64 <= BROADCAST_BYTES else ranges
    marked = _keyed(documents).join(broadcast_if_small(copies.select("key", F.lit(True).alias("copied")), copies), "key", "left").join(side, "key", "left")

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["bytes"] if with_bytes else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, copied, ranges in zip(*(batch.column(i) for i in (1, 2, 3))):
                data = text.as_py().encode()
                gone = [{"start": 0, "end": len(data)}] if copied.is_valid else ranges.as_py() or []
                kept, at = [], 0
                for r in gone:
                    kept.append(data[at : r["start"]])
                    at = r["end"]
                rest = b"".join(kept) + data[at:] if gone else data
                rows.append((len(data), len(data) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), rest if with_bytes else None))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            arrays = [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))]
            yield pa.RecordBatch.from_arrays(arrays[: len(names)], names=names)

    source = marked.select("doc_id", "text", "copied", "ranges")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", bytes binary" * with_bytes)
