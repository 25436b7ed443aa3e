"""Sum-of-squares online packing of token streams into sequences.

Every task packs the documents of its partition as they come. Whole multiples of the
sequence length become sequences of their own; what remains of a document goes to the fill
level that leaves the sum of squared counts of partially filled windows smallest, read from
an array of counts per level. When the partition ends, the emptiest windows are cut to top
up the fullest, and the last one is cut into powers of two, so that nothing is padded.

No row leaves its partition: there is no shuffle, and memory holds the open windows of one
task only. Sequence numbers carry the partition number in their upper bits. Null text is an
empty document of the end token alone; repeated rows are packed as often as they occur;
an empty table gives no pieces. Other input columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from starling.llm import text as T

PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ROWS = 20_000


@dataclass(frozen=True)
class Vocabulary:
    """One byte-pair vocabulary in two files: ranks for speed, and the full tokenizer for texts with special strings."""

    ranks: str
    tokenizer: str
    pattern: str
    special: str = "<|endoftext|>"

    def encoder(self) -> Callable[[str], list[int]]:
        import tiktoken

        with open(self.ranks, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        full = []

        def encode(text: str) -> list[int]:
            if self.special not in text:
                return fast.encode_ordinary(text)
            if not full:
                from tokenizers import Tokenizer

                full.append(Tokenizer.from_file(self.tokenizer))
            return full[0].encode(text, add_special_tokens=False).ids

        return encode


@dataclass
class Piece:
    doc: object
    start: int
    tokens: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, self.tokens, self.ids[:n]), Piece(self.doc, self.start + n, self.tokens, self.ids[n:])


@dataclass
class Packer:
    size: int
    counts: np.ndarray = field(init=False)
    open: dict[int, list[list[Piece]]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.counts = np.zeros(self.size + 1, dtype=np.int64)

    def level(self, n: int) -> int:
        """Fill level that takes ``n`` more with the smallest sum of squares; the fullest of equals."""
        before = self.counts[: self.size - n + 1]
        after = self.counts[n : self.size + 1]
        change = 2 * (after - before) + 2
        change[0] += 2 * before[0] - 1  # a new window leaves no level
        change[-1] -= 2 * after[-1] + 1  # a full window joins none
        change[1:][before[1:] == 0] = np.iinfo(np.int64).max
        return len(change) - 1 - int(change[::-1].argmin())

    def add(self, piece: Piece) -> list[Piece] | None:
        """Place a piece shorter than a sequence; returns a window that is now full."""
        n = len(piece.ids)
        at = self.level(n)
        window: list[Piece] = []
        if at:
            window = self.open[at].pop()
            self.counts[at] -= 1
        window.append(piece)
        if at + n == self.size:
            return window
        self.open.setdefault(at + n, []).append(window)
        self.counts[at + n] += 1
        return None

    def flush(self) -> Iterator[list[Piece]]:
        """Close all windows without padding."""
        windows = [(fill, w) for fill in sorted(self.open, reverse=True) for w in self.open[fill]]
        first, last = 0, len(windows) - 1
        while first < last:
            fill, window = windows[first]
            donor_fill, donor = windows[last]
            piece = donor.pop()
            if len(piece.ids) > self.size - fill:
                head, piece = piece.cut(len(piece.ids) - (self.size - fill))
                donor.append(head)
            window.append(piece)
            moved = len(piece.ids)
            windows[first], windows[last] = (fill + moved, window), (donor_fill - moved, donor)
            if not donor:
                last -= 1
            if fill + moved == self.size:
                yield window
                first += 1
        if first == last:
            yield from self.halved(*windows[first])

    def halved(self, fill: int, pieces: list[Piece]) -> Iterator[list[Piece]]:
        rest = pieces[::-1]
        while fill:
            want = 1 << (fill.bit_length() - 1)
            fill -= want
            window = []
            while want:
                piece = rest.pop()
                if len(piece.ids) > want:
                    piece, tail = piece.cut(want)
                    rest.append(tail)
                window.append(piece)
                want -= len(piece.ids)
            yield window


def packed(documents: Iterator[tuple[object, np.ndarray]], size: int) -> Iterator[list[Piece]]:
    """Windows of pieces, in the order in which they fill up."""
    packer = Packer(size)
    for doc, ids in documents:
        whole = len(ids) // size * size
        for at in range(0, whole, size):
            yield [Piece(doc, at, len(ids), ids[at : at + size])]
        if len(ids) > whole:
            full = packer.add(Piece(doc, whole, len(ids), ids[whole:].copy()))
            if full:
                yield full
    yield from packer.flush()


def pack(documents: DataFrame, vocabulary: Vocabulary, size: int = 1024, end: int = 0) -> DataFrame:
    """One row per piece: the document's ``doc_id``, what the piece is, and where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.encoder()
        base = TaskContext.get().partitionId() << 33
        kind: list[pa.DataType] = []

        def streams() -> Iterator[tuple[object, np.ndarray]]:
            for batch in batches:
                kind[:] = [batch.schema.field(0).type]
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield doc, np.array([*encode(text.as_py() or ""), end], dtype="<u4")

        def emit() -> pa.RecordBatch:
            docs, *numbers = zip(*rows)
            arrays = [pa.array(docs, kind[0]), *(pa.array(n, pa.int64()) for n in numbers)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(f.split()[0] for f in PIECES.split(", "))])

        rows: list[tuple] = []
        for number, window in enumerate(packed(streams(), size)):
            offset = 0
            for p in window:
                rows.append((p.doc, p.start, len(p.ids), zlib.crc32(p.ids.tobytes()), p.tokens, base | number, offset))
                offset += len(p.ids)
            if len(rows) >= ROWS:
                yield emit()
                rows.clear()
        if rows:
            yield emit()

    source = documents.select("doc_id", T.text_or_empty().alias("text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {PIECES}")
