"""Texts as flat byte buffers inside a task, and the shared staging folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starling.session import shared_dir

# bytes of text that one vectorised pass works on; a longer text is a slice of its own
SLICE_BYTES = 2 << 20

# white space of the word pattern [^\x20\x09-\x0D]+
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_MIX = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it back; survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    """A column name that may hold dots."""
    return f"`{name.replace('`', '``')}`"


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, lengthened until no frame has a column of that name, whatever its case."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of an Arrow text column; null becomes empty."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of at most ``limit`` bytes in sum, or a single longer text."""
    return size_slices(map(len, texts), limit)


def size_slices(sizes: Iterable[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """The same from the sizes alone."""
    start = held = end = 0
    for size in sizes:
        if end > start and held + size > limit:
            yield start, end
            start, held = end, 0
        held += size + 1
        end += 1
    if start < end:
        yield start, end


def sliced(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most ``limit`` bytes of a text or binary column, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    for start, end in size_slices(sizes.tolist(), limit):
        yield batch.slice(start, end - start)


class Buffer:
    """Texts joined by line feeds, with the words of each: runs of bytes that ``space`` does not hold."""

    def __init__(self, texts: list[bytes], space: np.ndarray = SPACE):
        self.count = len(texts)
        self.bytes = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.doc_starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        self.space = space[self.bytes]
        edges = np.flatnonzero(self.space[1:] != self.space[:-1]) + 1
        if not self.space[0]:
            edges = np.concatenate(([0], edges))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.docs = np.searchsorted(self.doc_starts, self.starts, side="right") - 1

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        return np.add.reduceat(flags.astype(np.int64), self.doc_starts)


def _power(n: int, base: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE_BYTES + 4096)
        known = np.full(size, base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if size <= 4 * SLICE_BYTES:
            _powers[base] = known
    return known[:n]


class RollingHash:
    """64-bit polynomial hash of any byte range, after one pass over the buffer.

    Built texts can collide (modulo a power of two, some pairs of strings do for every base):
    where equality decides a result, compare the bytes, as ``equal_ranges`` does.
    """

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_MIX[data] * _power(len(data), _BASE), dtype=np.uint64, out=self.sums[1:])
        self.inverse = _power(len(data) + 1, _INVERSE)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit value."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def repeats(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def numbered(keys: np.ndarray) -> np.ndarray:
    """The number of each key among the distinct ones."""
    return np.unique(keys, return_inverse=True)[1].astype(np.int64).reshape(-1)


def equal_ranges(data: np.ndarray, rolling: RollingHash, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each byte range, the same for two ranges if and only if their bytes are equal.

    Hashes order the ranges; neighbours of one hash are then compared byte by byte. Should any
    differ, all ranges are told apart by their bytes themselves.
    """
    keys = rolling.of(starts, ends)
    order = np.argsort(keys, kind="stable")
    left, right = order[:-1], order[1:]
    same = keys[left] == keys[right]
    left, right = left[same], right[same]
    sizes = ends[left] - starts[left]
    alike = np.array_equal(sizes, ends[right] - starts[right])
    if alike:
        for i, j in _runs(sizes, SLICE_BYTES):
            offsets = np.arange(sizes[i:j].sum()) - np.repeat(np.cumsum(sizes[i:j]) - sizes[i:j], sizes[i:j])
            alike = alike and np.array_equal(
                data[np.repeat(starts[left[i:j]], sizes[i:j]) + offsets], data[np.repeat(starts[right[i:j]], sizes[i:j]) + offsets]
            )
    if alike:
        return numbered(keys)
    whole, known = data.tobytes(), {}
    return np.array([known.setdefault(whole[a:b], len(known)) for a, b in zip(starts.tolist(), ends.tolist())], dtype=np.int64)


def _runs(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum up to about ``limit``."""
    if len(sizes):
        part = (np.cumsum(sizes) - sizes) // limit
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(sizes)]
        yield from zip(cuts, cuts[1:])


def later_copies(keys: np.ndarray) -> np.ndarray:
    """True where an equal key stands at a smaller index."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] = ranked[1:] == ranked[:-1]
    return out
